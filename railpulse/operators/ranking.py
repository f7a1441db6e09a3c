"""Top-k, keep-latest and full ranking."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railpulse.sinks.tables import stored


def _tie_breakers(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in df.columns if c not in skip]


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    *,
    within: Sequence[str] = (),
    position: str | None = None,
) -> DataFrame:
    """The first k rows, of the whole frame or of each group.

    Remaining ties fall to all columns in turn, so the rows chosen do not depend
    on partitioning. Over the whole frame every task keeps k rows. Within groups
    Spark limits each group before the shuffle, so a hot group reaches its reducer
    as k rows per map task.
    """
    ordering = [*order, *_tie_breakers(df, within)]
    if not within:
        top = df.orderBy(*ordering).limit(k)
        if position is None:
            return top
        # Only k rows are left, so one task numbers them.
        return top.withColumn(position, F.row_number().over(Window.orderBy(*ordering)))
    number = position or "_position"
    ranked = df.withColumn(
        number, F.row_number().over(Window.partitionBy(*within).orderBy(*ordering))
    ).where(F.col(number) <= k)
    return ranked if position else ranked.drop(number)


def keep_latest(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key: the highest version, remaining ties to the highest values.

    The per-group limit runs on the map side first, so even a key holding a large
    share of all rows shuffles one row per map task.
    """
    rest = [c for c in df.columns if c not in keys and c not in version]
    newest_first = [F.col(c).desc_nulls_last() for c in (*version, *rest)]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_age", number).where("_age = 1").drop("_age")


def rank_within(
    df: DataFrame, within: Sequence[str], measure: str, *, name: str = "rank_daily"
) -> DataFrame:
    """Add the descending competition rank of a measure within each group.

    A plain ``rank()`` sorts a whole group in one task. Here all rows are sorted by range,
    which cuts a large group over many tasks, and written once with their place in their
    partition. The rows of each partition are counted; the running sum of these counts, one
    number per partition, makes the places those of the whole table. A value's rank is then
    the first place of the value in the group less the first place of the group, plus 1.
    Both are least places, taken with partial aggregates. Only rows of equal group and value
    lie in one range, as they must, and adaptive execution splits them where they are joined
    with their rank. Rows with a null measure get no rank.
    """
    within = list(within)
    order = [*(F.col(c).asc_nulls_first() for c in within), F.col(measure).desc_nulls_last()]
    # Range bounds are found by a run of their own, so what the rows are made of is run first.
    # A row's id is the number of its partition, then its place there in 33 bits.
    ranged = stored(df, "unranked").repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_id", 33).cast("int")
    sizes = {r["part"]: r["count"] for r in kept.groupBy(part.alias("part")).count().collect()}
    before = [0, *accumulate(sizes.get(p, 0) for p in range(max(sizes, default=0)))]
    place = F.element_at(F.lit(before), part + 1) + F.col("_id").bitwiseAND((1 << 33) - 1)

    least = kept.groupBy(*within, measure).agg(F.min(place).alias("_first"))
    levels = stored(least, "levels")
    starts = levels.groupBy(*within).agg(F.min("_first").alias("_start"))
    rank = F.when(F.col(measure).isNotNull(), F.col("_first") - F.col("_start") + 1)
    ranks = _join_null_safe(levels, starts, within).select(*within, measure, rank.alias(name))
    return _join_null_safe(kept.drop("_id"), ranks, [*within, measure], how="left")


def _join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, how).drop(*(f"_r_{k}" for k in keys))
