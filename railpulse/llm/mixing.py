"""Mixing sources to target weights by systematic sampling.

Sources weigh 5, 2, 1 and so on in turn; their targets share all words by weight, none
above three times its source. Every document of a source is expected ``target / size of
the source`` times. The documents of a source are lined up by size, their expected copies
are summed up along the line, one random offset is added, and a document is taken once
per whole number its stretch of the sum crosses. Lined up by size, neighbours are alike,
so the words taken follow the target closely.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse.llm.words import WORD, free_name
from railpulse.sinks.tables import stored

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
#: Expected copies and offsets are multiples of 1 / GRID, so sums of them are exact.
GRID = 1 << 20
#: Random offsets tried per source; the one whose words come nearest the target is used.
OFFSETS = 32


def word_count(text: str | Column) -> Column:
    """Number of words; null has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with their place in an order, from 0, stored.

    Rows are dealt out by ranges and numbered inside each; only the number of rows of
    each range goes through the driver.
    """
    placed = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = sorted((r["_part"], r["n"]) for r in sizes)
    before = [0, *accumulate(n for _, n in sizes)]
    rows = [(p, b) for (p, _), b in zip(sizes, before, strict=False)]
    offsets = df.sparkSession.createDataFrame(rows, "_part bigint, _before bigint")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per range
        .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_before", "_at")
    )


def targets(
    totals: DataFrame, *, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """(source, size, weight, target) from (source, size).

    Sources weigh by their place in code point order, null last. All words are shared by
    weight; what lies above ``most`` times a source's size is shared again among the
    others, until none is above. Only sums reach the driver.
    """
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(
        F.array(*(F.lit(w).cast("bigint") for w in weights)),
        (F.col("_place") % len(weights) + 1).cast("int"),
    )
    ranked = stored(ranked.withColumn("weight", weight), "sources")
    total, weighing = ranked.agg(F.sum("size"), F.sum("weight")).first()
    rest, share = total or 0, weighing or 1
    while True:
        limited = F.lit(most) * F.col("size") * F.lit(share) < F.col("weight") * F.lit(float(rest))
        row = ranked.agg(
            F.sum(F.when(limited, F.col("size") * most).otherwise(0)),
            F.sum(F.when(~limited, F.col("weight")).otherwise(0)),
        ).first()
        now = ((total or 0) - (row[0] or 0), row[1] or 0)
        if now == (rest, share) or not now[1]:
            break
        rest, share = now
    part = F.col("weight") * F.lit(float(rest)) / F.lit(float(share))
    return ranked.select(
        "source",
        "size",
        "weight",
        F.least(part, (F.col("size") * most).cast("double")).alias("target"),
    )


def _offset(number: int, seed: str) -> Column:
    """The number-th random offset of a source."""
    text = F.concat(F.lit(f"{seed}:{number}:"), F.coalesce("source", F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 5), 16, 10).cast("double") / GRID


def mix(
    sized: DataFrame,
    *,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
    tie: str = "doc_id",
) -> DataFrame:
    """The rows of ``sized`` with ``source_size``, ``target`` and ``copies``.

    ``sized`` holds ``source``, ``size`` (words) and the column ``tie``, which orders
    rows of equal size; more columns are carried along. Rows equal in all three may swap
    copies. A row is taken at most ``most`` times. A source without words has target 0
    and is not taken; an empty table gives no rows. The result depends on the rows and
    ``seed`` only. A hot source is spread over many ranges, never put in one task.
    """
    line = numbered(
        sized, [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col(tie).asc()], "_n"
    )
    per_source = line.groupBy("source").agg(
        F.sum("size").alias("size"), F.min("_n").alias("_first")
    )
    per_source = stored(per_source, "sources")
    shares = targets(per_source.select("source", "size"), weights=weights, most=most)
    rate = F.when(F.col("_s.size") > 0, F.col("target") / F.col("_s.size")).otherwise(0.0)
    plan = stored(
        shares.alias("_s")
        .join(per_source.alias("_p"), F.expr("_s.source <=> _p.source"))
        .select(
            "_s.source",
            F.col("_s.size").alias("source_size"),
            "target",
            "_first",
            (F.floor(rate * GRID) / GRID).alias("_rate"),
        ),
        "plan",
    )
    placed = _joined(line, plan).withColumn("_k", (F.col("_n") - F.col("_first")).cast("double"))
    words = [
        F.sum(F.col("size") * _crossed(_offset(i, seed))).alias(f"w{i}") for i in range(OFFSETS)
    ]
    tried = placed.groupBy("source", "target").agg(*words)
    best = tried.select(
        "source",
        F.array_min(
            F.array(
                *(
                    F.struct(
                        F.abs(F.col(f"w{i}") - F.col("target")).alias("miss"),
                        F.lit(i).alias("number"),
                        _offset(i, seed).alias("offset"),
                    )
                    for i in range(OFFSETS)
                )
            )
        )["offset"].alias("_u"),
    )
    chosen = stored(_joined(plan, best), "offsets")
    return (
        _joined(line, chosen)
        .withColumn("_k", (F.col("_n") - F.col("_first")).cast("double"))
        .withColumn("copies", _crossed(F.col("_u")))
        .drop("_n", "_first", "_rate", "_k", "_u")
    )


def _crossed(offset: Column) -> Column:
    """Whole numbers between the sums before and after a row."""
    rate, k = F.col("_rate"), F.col("_k")
    return F.floor(offset + (k + 1) * rate) - F.floor(offset + k * rate)


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """Joined on the source, null included. A hot source's rows on the left are split by
    adaptive execution if the table of sources is too large to be sent around."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.expr("source <=> _source")).drop("_source")


def mixed(docs: DataFrame, *, source: str = "source", text: str = "text", **options) -> DataFrame:
    """The documents the mix takes, each as often as it is taken, with their own columns.

    Rows without a source are a source of their own; null and empty texts have size 0 and
    repeated rows are each placed for themselves. An empty table gives no rows.
    """
    row, many, copy = (free_name(n, docs) for n in ("row", "many", "copy"))
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    sized = kept.select(
        F.col(row).alias("own_row"), F.col(source).alias("source"), word_count(text).alias("size")
    )
    taken = (
        mix(sized, tie="own_row", **options)
        .where("copies > 0")
        .select(F.col("own_row").alias(row), F.sequence(F.lit(1), F.col("copies").cast("int")).alias(many))
    )
    return (
        kept.join(taken, row)
        .withColumn(copy, F.explode(many))
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )
