"""Benchmark passages in documents, with a few edits allowed.

Texts are compared as lower-case words joined by single spaces. An item of n characters
may differ in ``k = int(budget * n)`` edits. It is cut into k + 1 pieces: k edits cannot
touch all of them, so one piece occurs unchanged. All pieces are searched at once; around
each hit the whole item is verified by bit-parallel edit distance.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from railpulse.sinks.tables import stored

#: Bytes of benchmark text that one search holds; a larger benchmark takes more searches.
BLOCK_BYTES = 8 << 20
BUDGET = 0.08
#: An item with fewer characters has to occur as it is, between word edges, and is no
#: reason to drop a document: it may be common wording.
LEAST_CHARS = 24

_NOT_WORD = re.compile(r"[\W_]+")
#: Scripts that set no spaces between words, so that a word may begin at any character.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
    "\U00020000-\U0003ffff]"
)


def normal(text: str | None) -> str:
    return _NOT_WORD.sub(" ", text.lower()).strip() if text else ""


def _edges(text: str, start: int, end: int) -> bool:
    """Whether a stretch of a normal text begins and ends where words do."""
    return all(
        at in (0, len(text)) or " " in (pair := text[at - 1 : at + 1]) or _UNSPACED.search(pair)
        for at in (start, end)
    )


def best_distance(pattern: str, text: str) -> int:
    """The least edit distance of the pattern to any stretch of the text."""
    if pattern in text:
        return 0
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        at[c] |= 1 << i
    up, down, score = full, 0, m
    best = m
    for c in text:
        eq = at.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(across | up))
        minus = up & across
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
            best = min(best, score)
        plus, minus = plus << 1 & full, minus << 1 & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
    return best


class Pieces:
    """A block of items, ready to be searched for in texts. Those with fewer than
    ``least_chars`` characters are found unchanged and between word edges only."""

    def __init__(self, items: list[tuple[int, str]], budget: float, least_chars: int = 0):
        self.least_chars = least_chars
        self.items = [
            (i, t, int(budget * len(t)) if len(t) >= least_chars else 0) for i, t in items
        ]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, text, k) in enumerate(self.items):
            cuts = [j * len(text) // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                where[text[a:b]].append((number, a))
        self.search = ahocorasick.Automaton()
        for piece, places in where.items():
            self.search.add_word(piece, (len(piece), places))
        self.search.make_automaton()

    def found(self, text: str) -> list[tuple[object, int]]:
        """(item id, distance) of every item within its budget in a normal text, in the
        order of the block."""
        windows: dict[int, list[list[int]]] = defaultdict(list)
        for end, (length, places) in self.search.iter(text) if len(self.search) else ():
            for number, offset in places:
                n, k = len(self.items[number][1]), self.items[number][2]
                start = end + 1 - length - offset
                if n < self.least_chars and not _edges(text, start, start + n):
                    continue
                a, b = max(0, start - k), start + n + k
                # Hits come by their end, so windows of one item come nearly sorted.
                known = windows[number]
                if known and a <= known[-1][1] and b >= known[-1][0]:
                    known[-1] = [min(a, known[-1][0]), max(b, known[-1][1])]
                else:
                    known.append([a, b])
        found = []
        for number, spans in sorted(windows.items()):
            item, pattern, k = self.items[number]
            best = min(best_distance(pattern, text[a:b]) for a, b in spans)
            if best <= k:
                found.append((item, best))
        return found


def _blocks(
    benchmark: DataFrame, item_id: str, item_text: str, least_chars: int, block_bytes: int
) -> Iterator[list[tuple[object, str]]]:
    """The items in normal form, in blocks of about ``block_bytes`` by hash, one at a time."""
    items = benchmark.select(
        F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        rows = items.where(block == number).toLocalIterator()
        normals = ((r.item_id, normal(r.text)) for r in rows)
        yield [(i, t) for i, t in normals if len(t) >= least_chars]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    budget: float = BUDGET,
    least_chars: int = LEAST_CHARS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, distance) for every row and item it contains within the budget.

    The benchmark is read in blocks of about ``block_bytes``, by hash of its items, so
    what is sent to the tasks is bounded whatever its size; every block meets every
    document. Documents are not shuffled. Null and empty texts contain nothing; items
    that are null or have no words are in no document; items shorter than ``least_chars``
    are reported where they occur unchanged between word edges; equal items are each
    reported; repeated documents give repeated rows; an empty table on either side
    gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kinds = (texts.schema["doc_id"].dataType, benchmark.schema[item_id].dataType)
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, distance int"
    item_kind = to_arrow_type(kinds[1])

    def search(block: list[tuple[object, str]]) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces = Pieces(sent.value, budget, least_chars)
            for batch in batches:
                rows, ids, far = [], [], []
                for row, t in enumerate(batch.column(1).to_pylist()):
                    for item, distance in pieces.found(normal(t)):
                        rows.append(row)
                        ids.append(item)
                        far.append(distance)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(ids, item_kind),
                        pa.array(far, pa.int32()),
                    ],
                    names=["doc_id", "item_id", "distance"],
                )

        return texts.mapInArrow(run, schema)

    whole, before = None, None
    for block in _blocks(benchmark, item_id, item_text, 1, block_bytes):
        if before is not None:  # more than one block: each is searched in turn
            before = stored(before, "leaks")
            whole = before if whole is None else whole.unionByName(before)
        before = search(block)
    return before if whole is None else whole.unionByName(before)


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    budget: float = BUDGET,
    least_chars: int = LEAST_CHARS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows that contain no benchmark item of ``least_chars`` characters or more, with
    all of their columns, in place."""
    at = docs.columns.index(text)
    for block in _blocks(benchmark, item_id, item_text, least_chars, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            pieces = Pieces(sent.value, budget)
            for batch in batches:
                clean = [not pieces.found(normal(t)) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
