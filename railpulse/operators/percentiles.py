"""Discrete percentiles of whole-number measures by counting.

A sketch or a sort per group is the slow part of an aggregation, and a hot group
makes it one task's work. Waits are whole seconds, so rows are first counted per
(group, value): a hash aggregation that combines on the map side and spreads a hot
group over its values. What is left per group is at most one row per distinct
second, and the percentile is read off the running count. The result is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS = "_rows"
_UP_TO = "_up_to"
_KNOWN = "_known"
_SUM = "_sum"
_PLACE = "_place_in_group"
#: Columns of :func:`stats_from_counts`.
N, MEAN, PERCENTILE = "_n", "_mean", "_percentile"


def count_values(
    df: DataFrame, keys: Sequence[str | Column], value: str, *extra: Column
) -> DataFrame:
    """Rows per (keys, value) in column ``_rows``, with further aggregates beside it."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(ROWS), *extra)


def stats_from_counts(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    share: float,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per group of :func:`count_values`: keys, :data:`N`, :data:`MEAN` and
    :data:`PERCENTILE`, the least value that the given share of known rows does not exceed,
    with further plain aggregates over the counts. Unknown values count in N alone.

    Groups are sorted once, for the running count; the aggregates read them in that order and
    a group's first row is kept. So a task holds its sorted rows and nothing else: an
    aggregation after the running count would hold all groups of the task twice more, in
    the hash tables of its two halves.
    """
    exact = Fraction(str(share))
    ascending = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    running = ascending.rowsBetween(Window.unboundedPreceding, 0)
    whole = ascending.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.col(ROWS))
    extra = extra or {}
    placed = counts.withColumns(
        {
            _UP_TO: F.sum(ROWS).over(running),
            _KNOWN: F.sum(known).over(whole),
            _PLACE: F.row_number().over(ascending),
        }
    )
    # In a step of their own, so that what they sum is made after the sort, not sorted.
    reached = F.col(_UP_TO) * exact.denominator >= F.col(_KNOWN) * exact.numerator
    parts = {
        N: F.sum(ROWS),
        _SUM: F.sum(F.col(value) * F.col(ROWS)),
        PERCENTILE: F.min(F.when(reached, F.col(value))),
        **{f"_x_{name}": part for name, part in extra.items()},
    }
    told = placed.withColumns({name: part.over(whole) for name, part in parts.items()})
    return told.where(F.col(_PLACE) == 1).select(
        *keys,
        N,
        F.try_divide(_SUM, _KNOWN).alias(MEAN),
        F.col(PERCENTILE).cast("bigint").alias(PERCENTILE),
        *(F.col(f"_x_{name}").alias(name) for name in extra),
    )


def percentile_of_histogram(histogram: Column, value: str, share: float) -> Column:
    """The same percentile from an array of (value, rows) structs, in which a value may come
    more than once; null without any."""
    exact = Fraction(str(share))
    total = F.aggregate(histogram, F.lit(0).cast("bigint"), lambda s, x: s + x[ROWS])

    def step(state: Column, x: Column) -> Column:
        up_to = state["up_to"] + x[ROWS]
        reached = state["found"].isNull() & (up_to * exact.denominator >= state["goal"])
        return F.struct(
            up_to.alias("up_to"),
            state["goal"].alias("goal"),
            F.when(reached, x[value].cast("bigint")).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(
        F.lit(0).cast("bigint").alias("up_to"),
        (total * exact.numerator).alias("goal"),
        F.lit(None).cast("bigint").alias("found"),
    )
    found = F.aggregate(F.array_sort(histogram), start, step, lambda s: s["found"])
    # Many groups hold one value, which is every percentile of theirs.
    only = F.get(histogram, F.lit(0))[value].cast("bigint")
    return F.when(F.size(histogram) < 2, only).otherwise(found)


def mean_from_counts(value: str, rows: str = ROWS) -> Column:
    """Aggregate: mean over rows with a known value, null without any."""
    known = F.when(F.col(value).isNotNull(), F.col(rows))
    return F.try_divide(F.sum(F.col(value) * F.col(rows)), F.sum(known))


def share_of_rows(part: Column) -> Column:
    """Aggregate: a count as a share of all rows of the group."""
    return F.try_divide(F.sum(part), F.sum(ROWS))
