"""The daily report run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.times import day_before, day_parts
from railpulse.operators.report import (
    REPORT_DAY,
    context_json,
    report_context,
)
from railpulse.plans.lake import Lake
from railpulse.sinks.messages import write_documents
from railpulse.sources.tables import read_if_present

KPI_SCHEMA = (
    "event_date date, line_id bigint, station_id bigint, station_name string, "
    "total_events bigint, avg_wait_sec double, p95_wait_sec bigint, long_wait_ratio_5 double, "
    "express_ratio double, late_night_events bigint, last_train_dt timestamp, "
    "last_train_wait_sec double, year int, month int, day int"
)
USAGE_SCHEMA = (
    "pasngYmd string, stnNm string, lineNm string, totalNope bigint, rideNope bigint, "
    "gffNope bigint, stnCd string, lineNo string, year int, month int, day int"
)


def _day_of(spark: SparkSession, lake: Lake, root: str, schema: str, ymd: str) -> DataFrame:
    frame, _ = read_if_present(
        spark,
        root,
        spark.createDataFrame([], schema).schema,
        format=lake.format,
        where=day_parts(ymd)._asdict(),
    )
    return frame


def build_context(
    spark: SparkSession,
    lake: Lake,
    ymd: str,
    *,
    usage_lag: int = S.USAGE_LAG_DAYS,
    arrival_lag: int = S.ARRIVAL_LAG_DAYS,
) -> DataFrame:
    """Report context of a day from the KPI of that day and the newest confirmed
    ridership: one row, or none without either. Only those two day partitions are read,
    and all their rows belong to this report: rows of the evening before that were
    ingested after midnight do not make, or replace, a report of their own day.
    """
    day = F.lit(date(*day_parts(ymd)))
    kpi_day = f"{day_before(ymd, arrival_lag):%Y%m%d}"
    usage_day = f"{day_before(ymd, usage_lag):%Y%m%d}"
    kpi = _day_of(spark, lake, lake.station_kpi, KPI_SCHEMA, kpi_day)
    usage = _day_of(spark, lake, lake.station_usage, USAGE_SCHEMA, usage_day)
    return report_context(kpi.withColumn(REPORT_DAY, day), usage.withColumn(REPORT_DAY, day))


def write_context(spark: SparkSession, lake: Lake, ymd: str, **lags) -> None:
    write_documents(context_json(build_context(spark, lake, ymd, **lags)), lake.report_context)
