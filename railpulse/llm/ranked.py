"""Ranked lexical search: the k best documents of every query, by best-first intervals.

An index of shards is written first. A shard holds some thousand documents, numbered by
id, and for each of its terms the posting list (document numbers and occurrences). To
search a shard, the impacts of the query terms' postings are computed and every posting
list gets a sparse table that tells the place of its greatest impact in any range.

A query keeps a queue of document intervals. An interval is bounded by the sum of its
terms' greatest impacts there, and the interval of highest bound comes first. It is split
at the document where one term has the greatest share of the bound; that document is
scored. Small intervals are scored as a whole. The search of a shard ends when no bound
can change the k best. The k best of every shard are merged.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railpulse.llm.words import as_bytes, term_blocks
from railpulse.sinks.tables import stored

#: Most documents and, beyond one document, words of a shard.
SHARD_DOCS, SHARD_WORDS = 1 << 13, 1 << 21
#: Query text that goes to the tasks at once.
BLOCK_BYTES = 1 << 23
#: Intervals of at most so many postings are scored as a whole.
LEAF_POSTINGS = 1 << 11

INDEX_SCHEMA = "shard string, term string, df bigint, total bigint, docs binary, counts binary"


class _ShardBuilder:
    """Gathers the terms of documents until a shard is full."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self._known: dict[bytes, int] = defaultdict(count().__next__)
        self._parts: list[np.ndarray] = []
        self.words = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        number, size = self._known.__getitem__, 0
        for block in term_blocks(text):
            part = np.fromiter(map(number, block), np.int64, len(block))
            self._parts.append((part << 16) | len(self.ids))
            size += len(block)
        if size:  # a document without terms is no document of the index
            self.ids.append(doc_id)
            self.sizes.append(size)
            self.words += size

    def rows(self, shard: str) -> Iterator[pa.RecordBatch]:
        """A row of the documents' ids and sizes, then one row for each term."""
        ids = np.array([0 if i is None else i for i in self.ids], dtype="<i8")
        known = np.array([i is not None for i in self.ids], dtype="<i8")
        yield _index_rows(
            shard,
            [None],
            np.array([len(ids)]),
            np.array([self.words]),
            [b"".join([ids.tobytes(), known.tobytes()])],
            [np.array(self.sizes, dtype="<i8").tobytes()],
        )
        keys, counts = np.unique(np.concatenate(self._parts), return_counts=True)
        docs, counts = (keys & 0xFFFF).astype("<u2"), counts.astype("<u4")
        terms = list(self._known)
        cuts = np.searchsorted(keys >> 16, np.arange(len(terms) + 1))
        for a in range(0, len(terms), 1 << 16):
            b = min(a + (1 << 16), len(terms))
            at = cuts[a : b + 1]
            held = counts[at[0] : at[-1]]
            yield _index_rows(
                shard,
                terms[a:b],
                np.diff(at),
                np.add.reduceat(held, at[:-1] - at[0], dtype=np.int64),
                _slices(docs[at[0] : at[-1]], at - at[0]),
                _slices(held, at - at[0]),
            )


def _slices(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary cells that hold the values between the cuts."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())]
    )


def _index_rows(shard, terms, df, total, docs, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard] * len(terms)),
            pa.array(terms, pa.binary()).cast(pa.string()),
            pa.array(df, pa.int64()),
            pa.array(total, pa.int64()),
            pa.array(docs, pa.binary()),
            pa.array(counts, pa.binary()),
        ],
        names=["shard", "term", "df", "total", "docs", "counts"],
    )


def build_index(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shard_docs: int = SHARD_DOCS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The posting lists of all terms, shard by shard, written to the shared folder.

    A shard holds at most ``shard_docs`` documents (65,536 or fewer) and ends with the
    document that brings it to ``shard_words`` words, so a shard, and the task that builds
    or searches it, stays the same size however many documents there are; a single text
    beyond that is a shard of its own size. Row with a null term: the ids of the shard's
    documents, whether each is not null, and their numbers of terms, as 64-bit integers;
    ``df`` is their number, ``total`` that of all terms. Other rows: ``df`` document
    numbers (16 bits, ascending) and occurrences (32 bits), ``total`` their sum.
    """
    if not 0 < shard_docs <= 1 << 16:
        raise ValueError("document numbers of a shard have 16 bits")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, shard, made = TaskContext.get().partitionId(), _ShardBuilder(), 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            for own, body in zip(ids, texts, strict=True):
                shard.add(own, body)
                if len(shard.ids) >= shard_docs or shard.words >= shard_words:
                    yield from shard.rows(f"{task}-{made}")
                    shard, made = _ShardBuilder(), made + 1
        if shard.ids:
            yield from shard.rows(f"{task}-{made}")

    whole = docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    return stored(whole.mapInArrow(build, INDEX_SCHEMA), "postings")


class Shard:
    """Impacts of query terms in one shard, with a sparse table for each posting list.

    The lists lie one after the other in one array, and so do their tables: a range never
    leaves its list.
    """

    def __init__(self, ids: np.ndarray, known: np.ndarray, order: np.ndarray, lists: list):
        """``lists`` has (term, document numbers, impacts); ``order`` the documents by id,
        ``ids`` and ``known`` in that order."""
        self.ids, self.known = ids, known
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.spans: dict[bytes, tuple[int, int]] = {}
        docs, impacts, done = [], [], 0
        for term, numbers, values in lists:
            at = place[numbers]
            by = np.argsort(at)
            docs.append(at[by])
            impacts.append(values[by])
            self.spans[term] = (done, done + len(by))
            done += len(by)
        self.docs = np.concatenate(docs) if docs else np.zeros(0, dtype=np.int64)
        self.impacts = np.concatenate(impacts) if impacts else np.zeros(0, dtype=np.int64)
        longest = max((b - a for a, b in self.spans.values()), default=0)
        #: Level j, place p: where the greatest impact of [p, p + 2^j) is.
        self.peaks = [np.arange(done, dtype=np.int32)]
        width = 1
        while 2 * width <= longest:
            last = self.peaks[-1]
            level = last.copy()
            right = last[width:]
            better = self.impacts[right] > self.impacts[last[: len(right)]]
            level[: len(right)][better] = right[better]
            self.peaks.append(level)
            width *= 2

    def _bound(self, low, high, weight):
        """(sum of greatest impacts, place of the greatest share) over the ranges."""
        some = np.flatnonzero(high > low)
        if not len(some):
            return 0, -1
        low, high, weight = low[some], high[some], weight[some]
        peak = np.empty(len(some), dtype=np.int64)
        level = np.frexp((high - low).astype(float))[1] - 1
        for j in np.unique(level).tolist():
            on = level == j
            a, b = self.peaks[j][low[on]], self.peaks[j][high[on] - (1 << j)]
            peak[on] = np.where(self.impacts[b] > self.impacts[a], b, a)
        share = self.impacts[peak] * weight
        return int(share.sum()), int(peak[np.argmax(share)])

    def best(self, terms: dict[bytes, int], k: int, leaf: int) -> list[tuple[int, int]]:
        """The k documents (number by id, score) of highest score above 0; equal scores go
        to the smaller number. ``terms`` tells how often the query has each term."""
        held = [(self.spans[t], n) for t, n in terms.items() if t in self.spans]
        if not held:
            return []
        low = np.array([a for (a, _), _ in held])
        high = np.array([b for (_, b), _ in held])
        weight = np.array([n for _, n in held], dtype=np.int64)
        top: list[tuple[int, int]] = []  # heap of (score, -document): the least first

        def offer(score: int, doc: int) -> None:
            if score > 0:
                if len(top) < k:
                    heapq.heappush(top, (score, -doc))
                else:
                    heapq.heappushpop(top, (score, -doc))

        ranges = []  # a queue of intervals, the highest bound first

        def push(low: np.ndarray, high: np.ndarray, first: int) -> None:
            bound, peak = self._bound(low, high, weight)
            if bound > 0:
                heapq.heappush(ranges, (-bound, first, peak, low, high))

        push(low, high, 0)
        while ranges:
            bound, first, peak, low, high = heapq.heappop(ranges)
            if len(top) == k and (-bound, -first) <= top[0]:
                if -bound < top[0][0]:
                    break  # no later interval has a higher bound
                continue  # ties only, and with greater numbers
            if int((high - low).sum()) <= leaf:
                size = high - low
                at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                docs = self.docs[at]
                base = int(docs.min())
                scores = np.zeros(int(docs.max()) - base + 1, dtype=np.int64)
                np.add.at(scores, docs - base, self.impacts[at] * np.repeat(weight, size))
                if len(top) == k:
                    chosen = np.flatnonzero(scores >= top[0][0])
                else:
                    chosen = np.flatnonzero(scores)
                if len(chosen) > k:
                    chosen = chosen[np.lexsort((chosen, -scores[chosen]))[:k]]
                for d in chosen.tolist():
                    offer(int(scores[d]), base + d)
                continue
            doc = int(self.docs[peak])
            cut = np.array(
                [a + int(np.searchsorted(self.docs[a:b], doc)) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            )
            here = cut < high
            here[here] = self.docs[cut[here]] == doc
            offer(int((self.impacts[cut[here]] * weight[here]).sum()), doc)
            push(low, cut, first)
            push(cut + here, high, doc + 1)
        return [(-d, s) for s, d in sorted(top, key=lambda x: (-x[0], -x[1]))]


def _blocks(queries: DataFrame, block_bytes: int) -> Iterator[list[Row]]:
    """The queries in blocks of about ``block_bytes`` of text."""
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        found = queries.where(own == b).collect()
        if found:
            yield found


def _searched(index: DataFrame, asked: dict, weights: dict, n_docs: int, n_words: int, k: int, leaf: int):
    """(query, doc_id, score) of every shard's k best documents for every query."""

    def search(rows: pa.Table) -> pa.Table:
        terms = as_bytes(rows["term"])
        docs, counts = rows["docs"].to_pylist(), rows["counts"].to_pylist()
        head = terms.index(None)
        both = np.frombuffer(docs[head], dtype="<i8").reshape(2, -1)
        order = np.lexsort((both[0], -both[1]))  # rows without an id come last
        sizes = np.frombuffer(counts[head], dtype="<i8")
        norm = 25 + 75 * sizes * n_docs // n_words
        lists = []
        for term, d, c in zip(terms, docs, counts, strict=True):
            if term is not None:
                numbers = np.frombuffer(d, dtype="<u2").astype(np.int64)
                tf = np.frombuffer(c, dtype="<u4").astype(np.int64)
                lists.append((term, numbers, weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm[numbers]))))
        shard = Shard(both[0][order], both[1][order], order, lists)
        out: dict[str, list] = {"query": [], "doc_id": [], "score": []}
        for query, wanted in asked.items():
            for doc, score in shard.best(wanted, k, leaf):
                out["query"].append(query)
                out["doc_id"].append(int(shard.ids[doc]) if shard.known[doc] else None)
                out["score"].append(score)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    spark = index.sparkSession
    listed = spark.createDataFrame([(None,), *((t.decode(),) for t in weights)], "wanted string")
    wanted = index.join(F.broadcast(listed), F.col("term").eqNullSafe(F.col("wanted")), "left_semi")
    return wanted.groupBy("shard").applyInArrow(search, "query bigint, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    *,
    k: int = 10,
    item_id: str = "item_id",
    query_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    leaf_postings: int = LEAF_POSTINGS,
    **index_options,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of every query.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. With N
    documents that have a term, L terms in all and df documents that hold a term, a term
    weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); a document of n terms, tf of them the
    query's, scores w * floor(10^9 tf / (1000 tf + 8 m)) with m = 25 + floor(75 n N / L),
    summed over the query's terms, repeats included. Scores above 0 are ranked from 1,
    equal ones by ascending doc_id, a null doc_id last.

    Every query row is searched by itself, so repeated queries give repeated results, and
    repeated documents rank side by side. Null and empty texts have no terms; a query
    without a known term gives no row, and so do empty tables. Other columns are ignored.

    The queries are taken in blocks of about ``block_bytes`` of text (a single longer
    query is a block), which with their terms' weights go to every task; the index is
    written once and read for every block. A task searches one shard at a time.
    """
    index = build_index(docs, **index_options)
    spark = docs.sparkSession
    n_docs, n_words = index.where("term is null").agg(F.sum("df"), F.sum("total")).first()
    asked_rows = queries.selectExpr(
        f"cast(`{item_id}` as bigint) as item_id", f"`{query_text}` as text"
    ).where("text is not null")
    parts = []
    for block in _blocks(asked_rows, block_bytes) if n_docs else ():
        terms = [
            Counter(t for b in term_blocks(row.text.encode()) for t in b) for row in block
        ]
        known = {t for c in terms for t in c}
        listed = spark.createDataFrame([(t.decode(),) for t in known] or [("",)], "term string")
        df = index.join(F.broadcast(listed), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
        weights = {
            r.term.encode(): math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
            for r in df.collect()  # at most the terms of the block
        }
        asked = {i: {t: n for t, n in c.items() if t in weights} for i, c in enumerate(terms)}
        found = _searched(index, asked, weights, n_docs, n_words, k, leaf_postings)
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(
            [(i, row.item_id) for i, row in enumerate(block)], "query bigint, item_id bigint"
        )
        parts.append(best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, parts)
