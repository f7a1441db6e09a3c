"""Periodic runs of words: stretches that repeat the same words over and over.

Longest common extensions (LCE) of two word positions come from a difference cover: of
every ``MODULUS`` neighbouring positions only those in ``COVER`` have their suffixes
sorted. Any two positions reach two sorted ones after the same few words; those words are
compared one by one, and the rest is the least entry between the two in the array of
common prefixes of neighbours in sorted order, which a sparse table answers at once. The
same over the words turned round extends to the left.

Runs are enumerated on a harmonic grid: for every period q the positions 0, q, 2q, ... of
a document. A run of at least four periods holds three neighbouring grid positions whose
words equal those one period on; only there the two extensions are asked for. Documents
of a batch are searched together, each closed by a word of its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from railpulse.llm.words import as_bytes, word_blocks

#: Every difference of two numbers modulo 13 is that of two numbers of the cover.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Words of the documents that are searched together, and grid positions looked at together.
GROUP_WORDS, BLOCK_CELLS = 1 << 18, 1 << 20

_IN_COVER = np.isin(np.arange(MODULUS), COVER)
#: Least step from residues (i, j) to two of the cover.
_STEP = np.array(
    [
        [next(d for d in range(MODULUS) if _IN_COVER[(i + d) % MODULUS] and _IN_COVER[(j + d) % MODULUS]) for j in range(MODULUS)]
        for i in range(MODULUS)
    ]
)


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1).astype(np.int64)


class Extensions:
    """LCE over an array of words that ends in a word found nowhere else."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self._words = np.concatenate([words, np.full(MODULUS, -1, dtype=words.dtype)])
        at = np.flatnonzero(_IN_COVER[np.arange(n) % MODULUS])
        #: Place of a sampled position among the samples; positions past the end have the last.
        places = np.full(n + 1, len(at), dtype=np.int64)
        places[at] = np.arange(len(at))
        self._places = places

        # Names of the first MODULUS words, then of twice as many in every round.
        base = int(words.max(initial=0)) + 2
        held = max(1, int(62 // np.log2(base + 1)) - 1)  # words that fit beside a name
        names = _dense(self._words[at])
        for first in range(1, MODULUS, held):
            key = names
            for k in range(first, min(first + held, MODULUS)):
                if key.max(initial=0) >= (1 << 62) // base:
                    key = _dense(key)
                key = key * base + (self._words[np.minimum(at + k, n)] + 1)
            names = _dense(key)
        levels, step = [names], MODULUS
        while len(at) and names.max() + 1 < len(at):
            after = places[np.minimum(at + step, n)]
            beyond = np.append(names, -1)[after]
            names = _dense(names * (len(at) + 1) + beyond + 1)
            levels.append(names)
            step *= 2
        self._order = names
        by_order = np.argsort(names, kind="stable")

        # Common prefixes of neighbours in sorted order, by the names of every length.
        a, b = at[by_order[:-1]], at[by_order[1:]]
        common = np.zeros(len(a), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            level = np.append(levels[k], -1)
            x, y = places[np.minimum(a + common, n)], places[np.minimum(b + common, n)]
            same = (level[x] == level[y]) & (level[x] >= 0)
            common += np.where(same, MODULUS << k, 0)
        live = np.arange(len(a))
        for _ in range(MODULUS):  # what is left is shorter than the shortest name
            i, j = np.minimum(a[live] + common[live], n), np.minimum(b[live] + common[live], n)
            live = live[(self._words[i] == self._words[j]) & (self._words[i] >= 0)]
            common[live] += 1
        self._table = [common]
        width = 1
        while 2 * width <= len(common):
            last = self._table[-1]
            self._table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes from i and from j (another position) have in common."""
        step = _STEP[i % MODULUS, j % MODULUS]
        found = np.zeros(len(i), dtype=np.int64)
        live = np.arange(len(i))
        for d in range(MODULUS):  # words before the next sampled positions
            live = live[step[live] > d]
            live = live[self._words[i[live] + d] == self._words[j[live] + d]]
            found[live] += 1
        live = np.flatnonzero(found == step)
        if len(live):
            x = self._order[self._places[i[live] + step[live]]]
            y = self._order[self._places[j[live] + step[live]]]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.log2(high - low).astype(np.int64)
            for k in np.unique(level):
                on = level == k
                row = self._table[k]
                found[live[on]] += np.minimum(row[low[on]], row[high[on] - (1 << int(k))])
        return found


def _grid(lengths: np.ndarray, starts: np.ndarray, periods: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, period) of the harmonic grid, in blocks; four words one period apart
    from the position on lie in the document."""
    most = np.maximum((lengths - 1) // periods, 0)
    doc = np.repeat(np.arange(len(lengths)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    cells = (lengths[doc] - 1) // period - (periods - 1)
    ends = np.cumsum(cells)
    first = 0
    while first < len(doc):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + BLOCK_CELLS, side="right")))
        n, q = cells[first:last], period[first:last]
        q_of = np.repeat(q, n)
        k = np.arange(len(q_of)) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(starts[doc[first:last]], n) + k * q_of, q_of
        first = last


def _candidates(
    words: np.ndarray, lengths: np.ndarray, periods: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid cells whose word is found again one, two, ... ``periods`` periods on."""
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    for at, q in _grid(lengths, starts, periods):
        for k in range(periods):
            same = words[at + k * q] == words[at + (k + 1) * q]
            at, q = at[same], q[same]
        if len(at):
            yield at, q


def find_runs(
    words: np.ndarray, lengths: np.ndarray, *, least_words: int = 6, least_periods: int = 4
) -> np.ndarray:
    """Rows (start in ``words``, length, period) of all runs, by start, then period.

    ``words`` are the documents' word numbers one after the other, each document followed
    by a number found nowhere else; ``lengths`` their words without it. Only documents
    with a candidate on the grid are indexed.
    """
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    chosen = np.zeros(len(lengths), dtype=bool)
    for at, _ in _candidates(words, lengths, least_periods - 1):
        chosen[np.searchsorted(starts, at, side="right") - 1] = True
    if not chosen.any():
        return np.zeros((0, 3), dtype=np.int64)
    moved = starts[chosen]
    words, lengths = words[np.repeat(chosen, lengths + 1)], lengths[chosen]
    starts = np.cumsum(lengths + 1) - (lengths + 1)

    right = Extensions(words)
    # Turned round, a document is closed by the number before its first word, and position
    # i is len(words) - 2 - i.
    left = Extensions(np.append(words[::-1][1:], words[-1]))
    rows = np.zeros((0, 3), dtype=np.int64)
    for at, q in _candidates(words, lengths, least_periods - 1):
        forth = right.common(at, at + q)
        back = np.zeros(len(at), dtype=np.int64)
        before = at > 0
        i = len(words) - 1 - at[before]
        back[before] = left.common(i, i - q[before])
        length = back + forth + q
        fit = length >= np.maximum(least_words, least_periods * q)
        new = np.stack([at[fit] - back[fit], length[fit], q[fit]], axis=1)
        rows = _smallest_periods(np.concatenate([rows, new]))
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    doc = np.searchsorted(starts, rows[:, 0], side="right") - 1
    rows[:, 0] += moved[doc] - starts[doc]
    return rows


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """One row for each stretch. A stretch found for several periods is found for their
    greatest common divisor, the smallest of them."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[first]


def _numbers(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of the texts, each closed by a number of its own, and word counts."""
    known: dict[bytes, int] = defaultdict(count().__next__)
    number = known.__getitem__
    parts, lengths = [], []
    for text in texts:
        n = 0
        for block in word_blocks(text):
            parts.append(np.fromiter(map(number, block), np.int64, len(block)))
            n += len(block)
        parts.append(np.array([-1 - len(lengths)]))
        lengths.append(n)
    words = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    closing = words < 0
    words[closing] = len(known) - 1 - words[closing]
    return words, np.array(lengths, dtype=np.int64)


def _collapsed(text: bytes | None, keep: np.ndarray | None) -> bytes:
    """The kept words (all without ``keep``), joined by one space."""
    parts, done = [], 0
    for block in word_blocks(text):
        if keep is not None:
            kept = keep[done : done + len(block)]
            done += len(block)
            block = [block[i] for i in np.flatnonzero(kept).tolist()]
        if block:
            parts.append(b" ".join(block))
    return b" ".join(parts)


def _search(texts: list[bytes | None], least_words: int, least_periods: int):
    """(words, runs, collapsed text) of every text."""
    words, lengths = _numbers(texts)
    rows = find_runs(words, lengths, least_words=least_words, least_periods=least_periods)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    doc = np.searchsorted(starts, rows[:, 0], side="right") - 1
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    for d, text in enumerate(texts):
        runs = rows[cuts[d] : cuts[d + 1]] - [starts[d], 0, 0]
        keep = None
        if len(runs):
            edges = np.zeros(lengths[d] + 1, dtype=np.int64)
            np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
            np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
            keep = np.cumsum(edges)[:-1] == 0
        yield int(lengths[d]), runs, _collapsed(text, keep)


def _groups(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """Neighbouring texts of about ``GROUP_WORDS`` words; a longer text is alone."""
    group, size = [], 0
    for text in texts:
        n = len(text or b"") // 6
        if group and size + n > GROUP_WORDS:
            yield group
            group, size = [], 0
        group.append(text)
        size += n
    if group:
        yield group


SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def periodic_runs(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = 6,
    least_periods: int = 4,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every periodic run of words of each whole text.

    A run is a stretch of at least ``least_words`` words and ``least_periods`` (2 or more)
    times its smallest period that no neighbouring word extends; ``runs`` has (start word,
    length, period) by start, then period. ``collapsed`` is the text without the words that
    follow the first period of a run, joined by one space.

    One row per input row: repeated rows and rows without an id are searched like others;
    a null or empty text has no words, no runs and an empty collapsed text. Other columns
    are ignored, whatever their names. Nothing is shuffled; a task holds the words of one
    Arrow batch at most, and in the search of ``GROUP_WORDS`` words or one longer text,
    for which it takes some 250 bytes a word.
    """
    if least_periods < 2:
        raise ValueError("a run has two periods at least")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            done = 0
            for group in _groups(as_bytes(batch.column(1))):
                counts, runs, sizes, bodies = [], [], [0], []
                for n, rows, body in _search(group, least_words, least_periods):
                    counts.append(n)
                    runs.append(rows)
                    sizes.append(sizes[-1] + len(rows))
                    bodies.append(body)
                flat = np.concatenate(runs)
                items = pa.StructArray.from_arrays(
                    [pa.array(flat[:, k].copy()) for k in range(3)], fields=list(out)
                )
                ids = batch.column(0).slice(done, len(group))
                done += len(group)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), items),
                        pa.array(bodies, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    whole = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    return whole.mapInArrow(search, SCHEMA)
