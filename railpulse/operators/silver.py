"""Raw text tables to typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.columns import column_or_null, mapped_columns, stringify
from railpulse.functions.flags import yes_no_unknown, zero_if_null
from railpulse.functions.times import hour_part_columns, parse_day, parse_ts, run_key
from railpulse.operators.ranking import keep_latest


def land_arrivals(rows: DataFrame, snapshot: Column) -> DataFrame:
    """Bronze arrivals: text columns, the snapshot time, its run key and partition."""
    parts = {**hour_part_columns(snapshot), "minute": F.minute(snapshot)}
    return stringify(rows).withColumns(
        {"snapshot_ts": snapshot, "run_ts": run_key(snapshot), **parts}
    )


def land_usage(rows: DataFrame, ingested: Column) -> DataFrame:
    """Bronze ridership: text columns, ingest time, run key, partition by use day."""
    day = F.col(S.USAGE_DAY)
    parts = {
        "year": F.substring(day, 1, 4).try_cast("int"),
        "month": F.substring(day, 5, 2).try_cast("int"),
        "day": F.substring(day, 7, 2).try_cast("int"),
    }
    return stringify(rows).withColumns(
        {"ingested_at": ingested, S.USAGE_RUN: run_key(ingested), **parts}
    )


def silver_arrivals(
    bronze: DataFrame, *, partition: Sequence[str] = S.ARRIVAL_PARTITION
) -> DataFrame:
    """Typed arrivals with one resolved event time.

    One projection, no shuffle. Text that does not fit its type, and columns a
    drifting batch lacks, become nulls.
    """
    snapshot = column_or_null(bronze, "snapshot_ts", "timestamp")
    reception = parse_ts(column_or_null(bronze, S.RECEPTION_TIME, "string"))
    return bronze.select(
        snapshot.alias("snapshot_ts"),
        reception.alias("recptn_dt"),
        F.coalesce(reception, snapshot).alias("event_time"),
        *mapped_columns(bronze, S.ARRIVAL_MAPPING),
        yes_no_unknown(column_or_null(bronze, S.LAST_TRAIN_FLAG, "string")).alias("is_last_train"),
        *(column_or_null(bronze, p, "int").alias(p) for p in partition),
    )


def latest_usage(bronze: DataFrame) -> DataFrame:
    """Newest registration of each (day, station, line).

    Rows are sorted by these keys, the station first: a sort compares the first eight bytes
    at once, and these tell stations apart but hardly days, which are few.
    """
    version = [c for c in (S.USAGE_VERSION, S.USAGE_RUN) if c in bronze.columns]
    return keep_latest(bronze, (S.USAGE_STATION, S.USAGE_DAY, S.USAGE_LINE), version)


def silver_usage(
    bronze: DataFrame,
    *,
    use_ymd: str | None = None,
    deduplicate: bool = True,
    drop_negative: bool = True,
) -> DataFrame:
    """Typed ridership: latest version, unknown counts as 0, negative counts dropped.

    ``use_ymd`` overrides the day held in the rows, for a one-day run.
    """
    rows = latest_usage(bronze) if deduplicate else bronze
    day = F.lit(use_ymd) if use_ymd else column_or_null(rows, S.USAGE_DAY, "string")
    use_date = parse_day(day)
    boarded = zero_if_null(column_or_null(rows, S.USAGE_BOARDED, "bigint"))
    alighted = zero_if_null(column_or_null(rows, S.USAGE_ALIGHTED, "bigint"))
    typed = rows.select(
        day.alias("use_ymd"),
        use_date.alias("use_date"),
        parse_day(column_or_null(rows, S.USAGE_VERSION, "string")).alias("reg_date"),
        column_or_null(rows, S.USAGE_LINE, "string").alias("line_name"),
        column_or_null(rows, S.USAGE_STATION, "string").alias("station_name"),
        boarded.alias("ride_count"),
        alighted.alias("alight_count"),
        (boarded + alighted).alias("total_count"),
        F.year(use_date).alias("year"),
        F.month(use_date).alias("month"),
        F.dayofmonth(use_date).alias("day"),
    )
    return typed.where("ride_count >= 0 and alight_count >= 0") if drop_negative else typed
