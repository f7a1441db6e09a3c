"""The station reference: one row per station and line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.columns import require_columns
from railpulse.sources.tables import read_table

SUBWAY_ID, STATION_ID, STATION_NAME, LINE_NAME = S.STATION_REFERENCE_COLUMNS


def read_station_reference(
    spark: SparkSession, path: str, *, format: str = "parquet", **read_args
) -> DataFrame:
    """The reference table, checked for its columns."""
    return require_columns(
        read_table(spark, path, format=format, **read_args), S.STATION_REFERENCE_COLUMNS
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct known values of a column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def station_names(reference: DataFrame) -> DataFrame:
    return distinct_values(reference, STATION_NAME)


def line_names(reference: DataFrame) -> DataFrame:
    return distinct_values(reference, LINE_NAME)


def station_dimension(reference: DataFrame) -> DataFrame:
    """Typed join keys: one row per (line_id, station_id), the least names kept."""
    keyed = reference.select(
        F.col(SUBWAY_ID).try_cast("bigint").alias("line_id"),
        F.col(STATION_ID).try_cast("bigint").alias("station_id"),
        F.struct(
            F.col(STATION_NAME).cast("string").alias("ref_station_name"),
            F.col(LINE_NAME).cast("string").alias("ref_line_name"),
        ).alias("names"),
    )
    return (
        keyed.groupBy("line_id", "station_id")
        .agg(F.min("names").alias("names"))
        .select("line_id", "station_id", "names.*")
    )
