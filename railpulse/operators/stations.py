"""Enriched arrival events and the daily station KPI."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.flags import arrival_phase, as_flag, at_least, one_of
from railpulse.functions.times import first_time
from railpulse.operators.percentiles import (
    MEAN,
    N,
    PERCENTILE,
    count_values,
    stats_from_counts,
)


def enrich_events(
    silver: DataFrame,
    *,
    long_wait_sec: int = S.LONG_WAIT_SEC,
    express: Sequence[str] = S.EXPRESS_STATUSES,
    late_hours: Sequence[int] = S.LATE_NIGHT_HOURS,
    null_wait: str = "zero",
) -> DataFrame:
    """Silver arrivals plus event time parts, wait, flags and phase. No shuffle.

    ``null_wait``: an unknown wait counts as ``"zero"`` seconds or stays null with
    ``"ignore"``, leaving it out of averages.
    """
    if null_wait not in ("zero", "ignore"):
        raise ValueError(f"null_wait must be 'zero' or 'ignore', not {null_wait!r}")
    wait = F.col("arrival_seconds").cast("bigint")
    resolved = silver.withColumns(
        {
            "event_dt": first_time("event_time", "recptn_dt", "snapshot_ts"),
            "wait_sec": F.coalesce(wait, F.lit(0)) if null_wait == "zero" else wait,
            "is_last_train": F.coalesce(F.col("is_last_train"), F.lit(False)),
            "arrival_status_code": F.coalesce(
                F.col("arrival_status_code").cast("bigint"), F.lit(S.UNKNOWN_STATUS_CODE)
            ),
        }
    )
    return resolved.withColumns(
        {
            "event_date": F.to_date("event_dt"),
            "event_hour": F.hour("event_dt"),
            "is_long_wait_5": at_least(F.col("wait_sec"), long_wait_sec),
            "is_last_train_flag": as_flag(F.col("is_last_train")),
            "is_express": one_of(F.col("train_status"), express),
            "arrival_phase": arrival_phase(F.col("arrival_status_code")),
            "is_late_night": one_of(F.hour("event_dt"), late_hours),
        }
    )


WAIT = "wait_sec"
_SUMMED = {"_long": "is_long_wait_5", "_express": "is_express", "_late": "is_late_night"}


def _last_train_counts() -> list[Column]:
    last = F.col("is_last_train")
    return [
        F.count_if(last).alias("_last_rows"),
        F.max(F.when(last, F.col("event_dt"))).alias("_last_dt"),
    ]


def _last_train_sums() -> dict[str, Column]:
    rows = F.col("_last_rows")
    return {
        "last_train_dt": F.max("_last_dt"),
        "_last_sum": F.sum(F.col(WAIT) * rows),
        "_last_known": F.sum(F.when(F.col(WAIT).isNotNull(), rows)),
    }


def _kpi(
    events: DataFrame,
    keys: Sequence[str],
    percentile: float,
    counted: Sequence[Column] = (),
    summed: Mapping[str, Column] | None = None,
    shown: Sequence[Column] = (),
) -> DataFrame:
    sums = [F.sum(flag).alias(name) for name, flag in _SUMMED.items()]
    counts = count_values(events, keys, WAIT, *sums, *counted)
    extra = {**{name: F.sum(name) for name in _SUMMED}, **(summed or {})}
    return stats_from_counts(counts, keys, WAIT, percentile, extra).select(
        *keys,
        F.col(N).alias("total_events"),
        F.col(MEAN).alias("avg_wait_sec"),
        F.col(PERCENTILE).alias("p95_wait_sec"),
        F.try_divide("_long", N).alias("long_wait_ratio_5"),
        F.try_divide("_express", N).alias("express_ratio"),
        F.col("_late").alias("late_night_events"),
        *shown,
    )


def station_kpi(
    events: DataFrame,
    *,
    keys: Sequence[str] = S.KPI_KEYS,
    percentile: float = S.KPI_PERCENTILE,
) -> DataFrame:
    """Daily KPI per station and line from one scan.

    Events are counted per (keys, wait) first, so a hot station shuffles as at most
    one row per distinct wait and map task. Last-train columns come from conditional
    aggregates, so a group with a null key keeps them.
    """
    shown = [
        F.col("last_train_dt"),
        F.try_divide("_last_sum", "_last_known").alias("last_train_wait_sec"),
    ]
    return _kpi(events, keys, percentile, _last_train_counts(), _last_train_sums(), shown)


def last_train_stats(events: DataFrame, *, keys: Sequence[str] = S.KPI_KEYS) -> DataFrame:
    """Last-train time and mean wait over last trains only."""
    return (
        events.where("is_last_train")
        .groupBy(*keys)
        .agg(
            F.max("event_dt").alias("last_train_dt"), F.avg(WAIT).alias("last_train_wait_sec")
        )
    )


def station_kpi_joined(
    events: DataFrame,
    *,
    keys: Sequence[str] = S.KPI_KEYS,
    percentile: float = S.KPI_PERCENTILE,
) -> DataFrame:
    """The KPI as a left join of two aggregates on the same keys.

    Both sides are already partitioned by the keys, so the join adds no shuffle.
    A null key never matches: such a group has no last-train values.
    """
    return _kpi(events, keys, percentile).join(
        last_train_stats(events, keys=keys), list(keys), "left"
    )


def join_stations(facts: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of facts with the station dimension.

    No forced broadcast: Spark broadcasts the dimension only while its measured
    size is under the session's threshold, and otherwise sort-merges with skewed
    fact partitions split at run time.
    """
    return facts.join(dimension, list(keys), "left")
