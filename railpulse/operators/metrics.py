"""Sliding arrival metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.flags import any_true, share_at_least
from railpulse.functions.times import (
    Window,
    first_time,
    floor_time,
    hour_part_columns,
    minute_key,
    wall_clock,
    window_ending_at,
)
from railpulse.operators.percentiles import (
    MEAN,
    N,
    PERCENTILE,
    ROWS,
    count_values,
    mean_from_counts,
    percentile_of_histogram,
    share_of_rows,
    stats_from_counts,
)

TIME_COLUMNS = ("event_time", "snapshot_ts")
WAIT = "arrival_seconds"
_LAST = "_last_train"


def with_event_time(arrivals: DataFrame, time_columns: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """Add ``event_ts``, the first known of the time columns."""
    return arrivals.withColumn("event_ts", first_time(*time_columns))


def metrics_in_one_pass(
    timed: DataFrame,
    *,
    minutes: int = S.WINDOW_MINUTES,
    slide: int = S.SLIDE_MINUTES,
    keys: Sequence[str] = S.METRIC_KEYS,
    min_n: int = S.MIN_SAMPLES,
    long_wait_sec: int = S.VERY_LONG_WAIT_SEC,
    percentile: float = S.METRIC_PERCENTILE,
    accuracy: int = S.METRIC_ACCURACY,
) -> DataFrame:
    """Metrics of every window in a single aggregation, the form a stream can run.

    Each event is repeated for the minutes/slide windows it falls in. The percentile
    is approximate, its rank off by at most rows / accuracy.
    """
    metrics = timed.groupBy(
        F.window("event_ts", f"{minutes} minutes", f"{slide} minutes").alias("window"), *keys
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(WAIT).alias("avg_eta_sec"),
        F.percentile_approx(WAIT, percentile, accuracy).cast("bigint").alias("p90_eta_sec"),
        share_at_least(F.col(WAIT), long_wait_sec).alias("long_ratio_10m"),
        any_true(F.col("is_last_train")).alias("last_train_seen"),
    )
    return _with_window_columns(
        metrics, F.col("window.start"), F.col("window.end"), keys, minutes, min_n
    )


def pane_counts(timed: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows per (keys, wait), of which one is the pane, and whether a last train is seen."""
    return count_values(
        timed.where(F.col("event_ts").isNotNull()),
        keys,
        WAIT,
        F.bool_or("is_last_train").alias(_LAST),
    )


def sliding_metrics(
    timed: DataFrame,
    *,
    minutes: int = S.WINDOW_MINUTES,
    slide: int = S.SLIDE_MINUTES,
    keys: Sequence[str] = S.METRIC_KEYS,
    min_n: int = S.MIN_SAMPLES,
    long_wait_sec: int = S.VERY_LONG_WAIT_SEC,
    percentile: float = S.METRIC_PERCENTILE,
) -> DataFrame:
    """Metrics of every window that holds an event, over a batch with ``event_ts``.

    Events are counted once per pane, the longest slot that divides both window and
    slide, and only pane counts are repeated for the windows over them. A window
    then holds a value once per pane at most, which the running count allows for.
    """
    pane = floor_time(F.col("event_ts"), math.gcd(minutes, slide))
    panes = pane_counts(timed, [pane.alias("_pane"), *keys])
    windows = F.window("_pane", f"{minutes} minutes", f"{slide} minutes")
    counts = panes.withColumn("_window", windows).withColumn("_end", F.col("_window.end"))
    metrics = _from_counts(counts, ["_end", *keys], long_wait_sec, percentile)
    length = F.expr(f"interval {minutes} minutes")
    return _with_window_columns(
        metrics, F.col("_end") - length, F.col("_end"), keys, minutes, min_n
    )


def metrics_of_histograms(
    panes: DataFrame,
    *,
    minutes: int = S.WINDOW_MINUTES,
    slide: int = S.SLIDE_MINUTES,
    keys: Sequence[str] = S.METRIC_KEYS,
    min_n: int = S.MIN_SAMPLES,
    long_wait_sec: int = S.VERY_LONG_WAIT_SEC,
    percentile: float = S.METRIC_PERCENTILE,
) -> DataFrame:
    """The same metrics from :func:`pane_counts` whose pane is a window column, by one more
    aggregation and no running count, so that a stream can do it.

    A window gathers the (second, rows) of its panes, at most one per pane and distinct
    second, and reads the percentile off them in order.
    """
    windows = F.window("_pane", f"{minutes} minutes", f"{slide} minutes").alias("window")
    known = F.when(F.col(WAIT).isNotNull(), F.struct(WAIT, ROWS))
    metrics = panes.groupBy(windows, *keys).agg(
        F.sum(ROWS).alias("n"),
        mean_from_counts(WAIT).alias("avg_eta_sec"),
        percentile_of_histogram(F.collect_list(known), WAIT, percentile).alias("p90_eta_sec"),
        share_of_rows(F.when(F.col(WAIT) >= long_wait_sec, F.col(ROWS)).otherwise(0)).alias(
            "long_ratio_10m"
        ),
        any_true(F.col(_LAST)).alias("last_train_seen"),
    )
    return _with_window_columns(
        metrics, F.col("window.start"), F.col("window.end"), keys, minutes, min_n
    )


def windows_over(panes: DataFrame, minutes: int, slide: int) -> DataFrame:
    """``window_end_ts`` of every window over the panes that start at ``_pane``."""
    windows = F.window("_pane", f"{minutes} minutes", f"{slide} minutes")
    return panes.select(windows.alias("_w")).select(F.col("_w.end").alias("window_end_ts"))


def window_ends(
    timed: DataFrame, *, minutes: int = S.WINDOW_MINUTES, slide: int = S.SLIDE_MINUTES
) -> DataFrame:
    """``window_end_ts`` of every window that holds an event, from distinct panes alone."""
    pane = floor_time(F.col("event_ts"), math.gcd(minutes, slide))
    panes = timed.where(F.col("event_ts").isNotNull()).select(pane.alias("_pane")).distinct()
    return windows_over(panes, minutes, slide).distinct()


def window_metrics(
    arrivals: DataFrame,
    as_of: datetime,
    *,
    minutes: int = S.WINDOW_MINUTES,
    slide: int = S.SLIDE_MINUTES,
    keys: Sequence[str] = S.METRIC_KEYS,
    min_n: int = S.MIN_SAMPLES,
    time_columns: Sequence[str] = TIME_COLUMNS,
    long_wait_sec: int = S.VERY_LONG_WAIT_SEC,
    percentile: float = S.METRIC_PERCENTILE,
) -> DataFrame:
    """Metrics of the newest complete window at ``as_of``.

    With a single time column the range filter is a plain comparison and reaches
    the file scan; a choice between two columns cannot.
    """
    window = window_ending_at(as_of, minutes=minutes, slide=slide)
    if len(time_columns) == 1:
        rows = arrivals.where(window.holds(F.col(time_columns[0])))
    else:
        timed = with_event_time(arrivals, time_columns)
        rows = timed.where(window.holds(F.col("event_ts")))
    counts = count_values(rows, keys, WAIT, F.bool_or("is_last_train").alias(_LAST))
    metrics = _from_counts(counts, list(keys), long_wait_sec, percentile)
    return _with_window_columns(
        metrics, wall_clock(window.start), wall_clock(window.end), keys, minutes, min_n
    )


def _from_counts(
    counts: DataFrame, group: Sequence[str], long_wait_sec: int, percentile: float
) -> DataFrame:
    extra = {
        "_long": F.sum(F.when(F.col(WAIT) >= long_wait_sec, F.col(ROWS)).otherwise(0)),
        _LAST: F.bool_or(_LAST),
    }
    return stats_from_counts(counts, group, WAIT, percentile, extra).select(
        *group,
        F.col(N).alias("n"),
        F.col(MEAN).alias("avg_eta_sec"),
        F.col(PERCENTILE).alias("p90_eta_sec"),
        F.try_divide("_long", N).alias("long_ratio_10m"),
        F.coalesce(_LAST, F.lit(False)).alias("last_train_seen"),
    )


def hours_of(window: Window, lateness_hours: int = 0) -> list[dict[str, int]]:
    """The hour partitions of :func:`hours_touching`, one by one."""
    hour = window.start.replace(minute=0, second=0, microsecond=0)
    hours = []
    while hour < window.end + timedelta(hours=lateness_hours):
        hours.append({"year": hour.year, "month": hour.month, "day": hour.day, "hour": hour.hour})
        hour += timedelta(hours=1)
    return hours


def hours_touching(window: Window, lateness_hours: int = 0) -> Column:
    """Predicate on hour partitions that may hold rows of a window, allowing for
    rows landed up to some hours after their event."""
    moment = F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0))
    span = F.expr(f"INTERVAL {lateness_hours} HOURS")
    from_hour = F.date_trunc("hour", wall_clock(window.start))
    return (moment >= from_hour) & (moment < wall_clock(window.end) + span)


def _with_window_columns(
    metrics: DataFrame,
    start: Column,
    end: Column,
    keys: Sequence[str],
    minutes: int,
    min_n: int,
) -> DataFrame:
    return metrics.select(
        *keys,
        "n",
        "avg_eta_sec",
        "p90_eta_sec",
        "long_ratio_10m",
        "last_train_seen",
        start.alias("window_start_ts"),
        end.alias("window_end_ts"),
        F.lit(minutes).alias("window_minutes"),
        F.lit(min_n).alias("min_n"),
        *(part.alias(name) for name, part in hour_part_columns(end).items()),
        minute_key(end).alias("window_end_ymdhm"),
    )
