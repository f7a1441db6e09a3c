"""The daily ridership run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.times import day_part_columns, day_parts, parse_day
from railpulse.operators.ridership import line_totals, station_totals
from railpulse.operators.silver import land_usage, silver_usage
from railpulse.plans.lake import Lake
from railpulse.plans.landing import land
from railpulse.sinks.tables import replace_partition
from railpulse.sources.envelopes import USAGE
from railpulse.sources.tables import read_if_present, read_table

SILVER_SCHEMA = (
    "use_ymd string, use_date date, reg_date date, line_name string, station_name string, "
    "ride_count bigint, alight_count bigint, total_count bigint, year int, month int, day int"
)


def land_pages(
    documents: DataFrame, lake: Lake, ingested: Column, *, rejects: str | None = None
) -> None:
    """Landed ridership pages into bronze, each parsed once; an error page stops the run
    or, with a ``rejects`` root, is appended there."""
    land(
        documents,
        USAGE,
        lambda rows: land_usage(rows, ingested),
        lake.bronze_usage,
        partition_by=S.USAGE_PARTITION,
        format=lake.format,
        rejects=rejects,
    )


def refresh_silver(spark: SparkSession, lake: Lake, ymd: str) -> int:
    """Replace one day of silver by the newest registrations in bronze."""
    day = day_parts(ymd)._asdict()
    bronze = read_table(spark, lake.bronze_usage, format=lake.format, where=day)
    return replace_partition(
        silver_usage(bronze, use_ymd=ymd),
        lake.silver_usage,
        day,
        partition_by=S.USAGE_PARTITION,
        format=lake.format,
    )


def build_day(spark: SparkSession, lake: Lake, ymd: str) -> bool:
    """Station and line totals of one day; False, writing nothing, without silver."""
    day = day_parts(ymd)._asdict()
    schema = spark.createDataFrame([], SILVER_SCHEMA).schema
    silver, present = read_if_present(
        spark, lake.silver_usage, schema, format=lake.format, where=day
    )
    if not present or silver.isEmpty():
        return False
    for build, root in ((station_totals, lake.station_usage), (line_totals, lake.line_usage)):
        totals = build(silver)
        replace_partition(
            totals.withColumns(day_part_columns(parse_day(F.col("pasngYmd")))),
            root,
            day,
            partition_by=S.USAGE_PARTITION,
            format=lake.format,
        )
    return True
