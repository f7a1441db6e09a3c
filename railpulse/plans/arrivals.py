"""The five-minute arrival run and the daily arrival run."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.times import day_part_columns, day_parts, window_ending_at
from railpulse.operators.alerts import delay_alerts
from railpulse.operators.metrics import hours_of, window_metrics
from railpulse.operators.silver import land_arrivals, silver_arrivals
from railpulse.operators.stations import enrich_events, station_kpi
from railpulse.plans.lake import Lake
from railpulse.plans.landing import land
from railpulse.sinks.tables import replace_partition
from railpulse.sources.envelopes import ARRIVALS
from railpulse.sources.listing import latest_partition
from railpulse.sources.tables import read_table

METRICS_SCHEMA = (
    "station_id bigint, station_name string, line_id bigint, updn_line string, n bigint, "
    "avg_eta_sec double, p90_eta_sec bigint, long_ratio_10m double, last_train_seen boolean, "
    "window_start_ts timestamp, window_end_ts timestamp, window_minutes int, min_n int, "
    "year int, month int, day int, hour int, window_end_ymdhm string"
)


def land_snapshot(
    documents: DataFrame, lake: Lake, snapshot: Column, *, rejects: str | None = None
) -> None:
    """Landed arrival documents into bronze, each parsed once.

    An error envelope stops the run before anything is committed; with a ``rejects`` root
    it is appended there with its reason, and the run goes on.
    """

    def bronze(rows: DataFrame) -> DataFrame:
        tagged = rows.withColumn("query_station_name", F.lit(S.WHOLE_NETWORK_QUERY))
        return land_arrivals(tagged, snapshot)

    land(
        documents,
        ARRIVALS,
        bronze,
        lake.bronze_arrivals,
        partition_by=(*S.ARRIVAL_PARTITION, "minute"),
        format=lake.format,
        rejects=rejects,
    )


def newest_hour(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Year, month, day and hour of the bronze hour written last."""
    row = latest_partition(spark, lake.bronze_arrivals).first()
    if row is None:
        raise FileNotFoundError(f"no bronze files under {lake.bronze_arrivals}")
    return {name: int(row[name]) for name in S.ARRIVAL_PARTITION}


def refresh_silver(
    spark: SparkSession, lake: Lake, hour: Mapping[str, int] | None = None
) -> dict[str, int]:
    """Rebuild one hour of silver from bronze, by default the newest."""
    hour = dict(hour or newest_hour(spark, lake))
    bronze = read_table(spark, lake.bronze_arrivals, format=lake.format, where=hour)
    replace_partition(
        silver_arrivals(bronze),
        lake.silver_arrivals,
        hour,
        partition_by=S.ARRIVAL_PARTITION,
        format=lake.format,
    )
    return hour


def refresh_metrics(
    spark: SparkSession, lake: Lake, as_of: datetime, *, lateness_hours: int = 1
) -> int:
    """Replace the metrics of the newest complete window; returns the groups written.

    Every hour partition touching the window is read, and those of the next
    ``lateness_hours``, since rows are filed by ingest hour. A window without rows
    is left as it was.
    """
    window = window_ending_at(as_of)
    silver = read_table(
        spark,
        lake.silver_arrivals,
        format=lake.format,
        where=hours_of(window, lateness_hours),
    )
    metrics = window_metrics(silver, as_of, time_columns=("event_time",))
    return replace_partition(
        metrics,
        lake.arrival_metrics,
        _window_partition(window.end),
        partition_by=S.METRIC_PARTITION,
        format=lake.format,
        skip_empty=True,
    )


def _window_partition(end: datetime) -> dict[str, object]:
    return {
        "year": end.year,
        "month": end.month,
        "day": end.day,
        "hour": end.hour,
        "window_end_ymdhm": f"{end:%Y%m%d%H%M}",
    }


def read_metrics(spark: SparkSession, lake: Lake, where=None) -> DataFrame:
    """Stored metrics. The declared schema keeps the window key text, which Spark
    would otherwise take for a number, and spares reading file footers."""
    return read_table(
        spark, lake.arrival_metrics, format=lake.format, schema=METRICS_SCHEMA, where=where
    )


def check_delays(spark: SparkSession, lake: Lake, as_of: datetime, **thresholds) -> DataFrame:
    """Alert row, or none, of the newest complete window."""
    stored = read_metrics(spark, lake, _window_partition(window_ending_at(as_of).end))
    return delay_alerts(stored, **thresholds)


def build_day(spark: SparkSession, lake: Lake, ymd: str) -> None:
    """Enriched events and station KPI of one day.

    The KPI reads the stored events back, and of them only the columns it needs.
    """
    day = day_parts(ymd)._asdict()
    silver = read_table(spark, lake.silver_arrivals, format=lake.format, where=day)
    replace_partition(
        enrich_events(silver),
        lake.arrival_events,
        day,
        partition_by=S.USAGE_PARTITION,
        format=lake.format,
    )
    events = read_table(spark, lake.arrival_events, format=lake.format, where=day)
    replace_partition(
        station_kpi(events).withColumns({name: F.lit(value) for name, value in day.items()}),
        lake.station_kpi,
        day,
        partition_by=S.USAGE_PARTITION,
        format=lake.format,
    )


def backfill_kpi(spark: SparkSession, lake: Lake, where: Column | None = None) -> DataFrame:
    """KPI of all days at once, with partition columns, for a historical rebuild."""
    silver = read_table(spark, lake.silver_arrivals, format=lake.format, where=where)
    return station_kpi(enrich_events(silver)).withColumns(day_part_columns(F.col("event_date")))
