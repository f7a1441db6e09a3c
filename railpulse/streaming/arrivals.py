"""Arrival metrics, deduplication and latest versions over a stream."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.operators.metrics import (
    TIME_COLUMNS,
    metrics_in_one_pass,
    metrics_of_histograms,
    pane_counts,
    with_event_time,
)


def timed_stream(
    arrivals: DataFrame,
    *,
    delay: str = "10 minutes",
    time_columns: Sequence[str] = TIME_COLUMNS,
    taken_at: str = "snapshot_ts",
    ahead: str = "5 minutes",
) -> DataFrame:
    """Arrivals with ``event_ts`` and a watermark on it.

    A source clock that runs ahead would move the watermark with it and shut out all
    rows until then. So a time more than ``ahead`` after the snapshot the row came in,
    column ``taken_at``, counts as the time of that snapshot.
    """
    timed = with_event_time(arrivals, time_columns)
    if taken_at in arrivals.columns:
        too_late = F.col("event_ts") > F.col(taken_at) + F.expr(f"interval {ahead}")
        timed = timed.withColumn(
            "event_ts", F.when(too_late, F.col(taken_at)).otherwise(F.col("event_ts"))
        )
    return timed.withWatermark("event_ts", delay)


def metrics_stream(
    arrivals: DataFrame,
    *,
    delay: str = "10 minutes",
    time_columns: Sequence[str] = TIME_COLUMNS,
    taken_at: str = "snapshot_ts",
    ahead: str = "5 minutes",
    exact: bool = True,
    **metric_args,
) -> DataFrame:
    """Sliding metrics with a lateness allowance; see :func:`timed_stream` for its options.

    In append mode a window is emitted once, whole, when the watermark passes its end, and
    its state is dropped. With ``exact`` two stateful aggregations follow each other: rows
    are counted per pane and whole second of wait, and the counts of a closed pane go into
    the histograms of the windows over it, from which the percentile is read exactly. State
    holds a number per (pane, group, second), never rows. Rows that come after their pane
    has closed are in no window; ``streaming.late`` finds them. Without ``exact`` one
    aggregation keeps a sketch per window, and rows are lost to closed windows only.
    """
    timed = timed_stream(
        arrivals, delay=delay, time_columns=time_columns, taken_at=taken_at, ahead=ahead
    )
    if not exact:
        return metrics_in_one_pass(timed, **metric_args)
    minutes = metric_args.get("minutes", S.WINDOW_MINUTES)
    slide = metric_args.get("slide", S.SLIDE_MINUTES)
    pane = F.window("event_ts", f"{math.gcd(minutes, slide)} minutes").alias("_pane")
    keys = metric_args.get("keys", S.METRIC_KEYS)
    return metrics_of_histograms(pane_counts(timed, [pane, *keys]), **metric_args)


def distinct_stream(
    rows: DataFrame, keys: Sequence[str], *, time: str, delay: str = "10 minutes"
) -> DataFrame:
    """First row of each key; a repeat within the delay is dropped. State for a key
    is kept only for the delay."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def latest_stream(
    rows: DataFrame,
    keys: Sequence[str],
    version: Sequence[str],
    *,
    time: str,
    quiet: str = "1 hour",
    delay: str = "10 minutes",
) -> DataFrame:
    """The latest version of each key, in whatever order versions come in.

    The state of a key holds its latest version so far: the highest ``version``, nulls
    lowest, remaining ties to the highest values of the other columns. It is emitted once,
    and dropped, when the watermark is ``quiet`` past the key's newest row by event time.
    A version whose event time is further away than that starts the key anew and is emitted
    later, so a sink that replaces by key ends with the newest. A null key is a key; rows
    without an event time are left out.
    """
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    # A null version ranks below all others in a maximum over structs.
    whole = F.struct(*version, *(c for c in rest if c not in version))
    latest = (
        rows.withWatermark(time, delay)
        .groupBy(F.session_window(time, quiet).alias("_quiet"), *keys)
        .agg(F.max(whole).alias("_row"))
    )
    return latest.select(*keys, *(F.col("_row")[c].alias(c) for c in rest))
