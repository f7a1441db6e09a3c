"""Exact top-k by inner product with MaxScore, over shards of vectors.

A query's terms are the dimensions. In a shard each term's contribution lies between a
floor and a ceiling, known from the least and greatest value of the dimension there. With
the k-th best score so far as the threshold, the terms of smallest spread that together
cannot lift a vector from its floors to the threshold are non-essential: essential terms
are summed for all vectors, the others are probed, widest first, only for vectors that can
still reach the threshold. The k best of every shard are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
#: Vectors of each of a query's widest terms that give the first threshold.
_SEEDS, _SEED_TERMS = 32, 4
_PROBED = 8  # terms probed between two prunings
_EXACT = float(1 << 53)


def quantized(vector: str | Column, *, scale: int = 256) -> Column:
    """floor(scale * x) of every component, null if the vector or a component is null or
    not finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    whole = F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    odd = F.exists(
        column,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    return F.when(column.isNotNull() & ~odd, whole)


class Shard:
    """Vectors of one shard with the bounds and the strongest postings of each term."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.columns = np.ascontiguousarray(self.rows.T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        by_value = np.argsort(self.columns, axis=1, kind="stable")
        self.lowest, self.highest = by_value[:, :_SEEDS], by_value[:, -_SEEDS:]

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors, without those of the query's own id;
        equal scores go to the smaller id."""
        a, b = query * self.low, query * self.high
        floor, ceiling = np.minimum(a, b), np.maximum(a, b)
        spread = ceiling - floor
        order = np.argsort(spread, kind="stable")
        other = self.ids != own
        seeds = np.unique(
            np.concatenate(
                [(self.highest if query[t] > 0 else self.lowest)[t] for t in order[-_SEED_TERMS:]]
            )
        )
        seeds = seeds[other[seeds]]
        threshold = -np.inf
        if len(seeds) >= k:
            threshold = np.partition(self.rows[seeds] @ query, -k)[-k]
        # A vector at its floors plus all non-essential spreads stays below the threshold.
        reach = floor.sum() + np.cumsum(spread[order])
        split = int(np.searchsorted(reach, threshold, side="left"))
        rest, essential = order[:split][::-1], order[split:]
        alive = np.flatnonzero(other)
        partial = np.zeros(len(self.ids))
        if len(essential):
            partial = query[essential] @ self.columns[essential]
        partial = partial[alive]
        left = float(ceiling[rest].sum())
        for i in range(0, len(rest) + 1, _PROBED):
            fit = partial + left >= threshold
            alive, partial = alive[fit], partial[fit]
            terms = rest[i : i + _PROBED]
            if len(terms):
                partial = partial + query[terms] @ self.columns[np.ix_(terms, alive)]
                left -= float(ceiling[terms].sum())
                if len(partial) > k:  # scores still to come are at least their floors
                    sure = partial + float(floor[rest[i + _PROBED :]].sum())
                    threshold = max(threshold, np.partition(sure, -k)[-k])
        top = np.lexsort((self.ids[alive], -partial))[:k]
        return self.ids[alive[top]], partial[top]


def _exact(ids: np.ndarray, rows: list, query: list, own: int, k: int):
    """The same with whole numbers of any size; scores beyond 64 bits are cut to them."""
    scores = [
        (-min(max(sum(map(int.__mul__, r, query)), -(1 << 63)), (1 << 63) - 1), i)
        for r, i in zip(rows, ids.tolist(), strict=True)
        if i != own
    ]
    scores = sorted(scores)[:k]
    return [i for _, i in scores], [-s for s, _ in scores]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.values.to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def top_k(
    vectors: DataFrame,
    *,
    k: int = 5,
    every: int = 50,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of highest inner product with each
    query, all if fewer; ties go to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates all rows but those
    of the query's id. Components are taken as ``floor(scale * x)``; vectors that are null,
    empty or hold null or non-finite components, and rows without an id, take no part;
    only vectors of the query's own length are compared with it. Repeated rows are
    repeated candidates and one query. An empty table gives no rows; other columns are
    ignored.

    Every block of at most about ``block_queries`` queries meets every shard of about
    ``shard_rows`` vectors in a task of its own, so tasks stay the same size as the table
    grows; a shard gives at most k rows per query to the merge.
    """
    whole = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"), quantized(vector, scale=scale).alias("v")
    ).where("id is not null and size(v) > 0")
    count = whole.count()
    shards = count // shard_rows + 1
    blocks = count // every // block_queries + 1

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = whole.select(
        "id",
        "v",
        F.size("v").alias("dims"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
    ).withColumn("block", each(blocks))
    asked = (
        whole.where(F.col("id") % every == 0)
        .select("id", "v", F.size("v").alias("dims"))
        .distinct()
        .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        .withColumn("shard", each(shards))
    )

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and rows.num_rows:
            q, x = _matrix(queries["v"]), _matrix(rows["v"])
            ids = rows["id"].to_numpy()
            most = float(np.abs(q.astype(float)).max()) * float(np.abs(x.astype(float)).max())
            small = most * q.shape[1] < _EXACT
            shard = Shard(ids, x.astype(float)) if small else None
            for own, query in zip(queries["id"].to_pylist(), q, strict=True):
                if small:
                    found, scores = shard.best(query.astype(float), own, k)
                else:
                    found, scores = _exact(ids, x.tolist(), query.tolist(), own, k)
                out["query_id"] += [own] * len(found)
                out["vec_id"] += [int(i) for i in found]
                out["score"] += [int(s) for s in scores]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    key = ("block", "shard", "dims")
    found = (
        asked.groupBy(*key)
        .cogroup(dealt.groupBy(*key))
        .applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
