"""Delay alerts over window metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.flags import weighted_mean
from railpulse.functions.text import delay_line
from railpulse.functions.times import display_time, wall_clock
from railpulse.operators.ranking import top_k

#: Window ends made by one row of the spine of ``missing_windows``.
SPINE_BLOCK = 1000
WINDOW = ("window_start_ts", "window_end_ts")
TOP_COLUMNS = ("station_name", "line_id", "updn_line", "n", "long_ratio_10m", "p90_eta_sec")


def window_health(metrics: DataFrame) -> DataFrame:
    """One row per window: rows, groups and means weighted by group size.

    Unknown values give 0. Weighting by ``n`` makes the ratio the share over all
    rows of the window.
    """
    n = F.col("n")
    return metrics.groupBy(*WINDOW).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_n"),
        F.coalesce(weighted_mean(F.col("long_ratio_10m"), n), F.lit(0.0)).alias(
            "delay_ratio_10m_weighted"
        ),
        F.coalesce(weighted_mean(F.col("p90_eta_sec"), n), F.lit(0.0)).alias(
            "p90_eta_sec_weighted"
        ),
        F.count(F.lit(1)).alias("groups"),
    )


def delayed_stations(
    metrics: DataFrame, *, k: int = S.TOP_K, min_samples: int = S.MIN_SAMPLES
) -> DataFrame:
    """The k most delayed groups of each window among those with enough rows."""
    return top_k(
        metrics.where(F.col("n") >= min_samples).select(*WINDOW, *TOP_COLUMNS),
        k,
        [F.col("long_ratio_10m").desc_nulls_last(), F.col("n").desc()],
        within=WINDOW,
        position="position",
    )


def is_delayed(
    min_total: int = S.ALERT_MIN_TOTAL,
    ratio: float = S.ALERT_DELAY_RATIO,
    p90_sec: float = S.ALERT_P90_SEC,
):
    return (F.col("total_n") >= min_total) & (
        (F.col("delay_ratio_10m_weighted") >= ratio) | (F.col("p90_eta_sec_weighted") >= p90_sec)
    )


def delay_alerts(
    metrics: DataFrame,
    *,
    min_total: int = S.ALERT_MIN_TOTAL,
    ratio: float = S.ALERT_DELAY_RATIO,
    p90_sec: float = S.ALERT_P90_SEC,
    k: int = S.TOP_K,
    min_samples: int = S.MIN_SAMPLES,
) -> DataFrame:
    """One row per alerting window with its most delayed stations attached.

    The attached list holds at most k stations, so collecting it is bounded.
    """
    alerting = window_health(metrics).where(is_delayed(min_total, ratio, p90_sec))
    listed = (
        delayed_stations(metrics, k=k, min_samples=min_samples)
        .groupBy(*WINDOW)
        .agg(
            F.array_sort(F.collect_list(F.struct("position", *TOP_COLUMNS))).alias("top_stations")
        )
    )
    joined = alerting.join(listed, list(WINDOW), "left")
    lines = F.array_join(F.transform("top_stations", delay_line), "\n")
    return joined.withColumn(
        "alert_text",
        F.format_string(
            S.DELAY_TEXT_FORMAT,
            display_time(F.col("window_start_ts")),
            display_time(F.col("window_end_ts")),
            F.col("total_n").cast("string"),
            F.col("groups").cast("string"),
            F.col("delay_ratio_10m_weighted"),
            F.col("p90_eta_sec_weighted"),
            F.coalesce(lines, F.lit("")),
        ),
    )


def missing_windows(
    metrics: DataFrame,
    *,
    minutes: int = S.WINDOW_MINUTES,
    slide: int = S.SLIDE_MINUTES,
    first_end: datetime | None = None,
    last_end: datetime | None = None,
) -> DataFrame:
    """Windows without metrics between two window ends, by default the first and
    last present.

    Expected ends are counted from the first one in whole slides, whatever the slide
    and the zone. Their numbers are made in blocks, one block per row, so the spine
    spreads over tasks however long the range.
    """
    ends = metrics.select("window_end_ts").distinct()
    span = ends.agg(
        F.unix_micros(F.coalesce(wall_clock(first_end), F.min("window_end_ts"))).alias("lo"),
        F.unix_micros(F.coalesce(wall_clock(last_end), F.max("window_end_ts"))).alias("hi"),
    )
    step = slide * 60_000_000
    last = F.floor((F.col("hi") - F.col("lo")) / step)
    # A null or empty span has no numbers.
    blocks = span.where("lo <= hi").select(
        "lo", last.alias("last"), F.explode(F.sequence(F.lit(0), last, F.lit(SPINE_BLOCK))).alias("at")
    )
    expected = blocks.select(
        "lo", F.explode(F.sequence("at", F.least("last", F.col("at") + SPINE_BLOCK - 1))).alias("at")
    ).select(F.timestamp_micros(F.col("lo") + F.col("at") * step).alias("window_end_ts"))
    length = F.expr(f"interval {minutes} minutes")
    return expected.join(ends, "window_end_ts", "left_anti").select(
        (F.col("window_end_ts") - length).alias("window_start_ts"),
        "window_end_ts",
        F.format_string(
            S.EMPTY_TEXT_FORMAT,
            display_time(F.col("window_end_ts") - length),
            display_time(F.col("window_end_ts")),
        ).alias("alert_text"),
    )
