"""The driver's tables reshaped as transit data, whole.

``events`` stands in for arrivals and ``lineitem`` for ridership.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.functions.times import hour_part_columns

EXPRESS = ("purchase",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _keyed(events: DataFrame) -> DataFrame:
    return events.withColumns({"k": _k(), "t": F.col("ts").cast("timestamp")})


def arrivals(events: DataFrame) -> DataFrame:
    """Typed arrivals; works on a batch or a stream of events."""
    k, user = F.col("k"), F.col("user_id")
    return _keyed(events).select(
        F.col("t").alias("snapshot_ts"),
        F.when(k % 10 != 0, F.col("t")).alias("recptn_dt"),
        F.col("t").alias("event_time"),
        user.alias("station_id"),
        F.concat(F.lit("ST"), user).alias("station_name"),
        (F.lit(1001) + user % 9).alias("line_id"),
        F.when(F.col("event_id") % 2 == 0, "up").otherwise("down").alias("updn_line"),
        F.col("event_type").alias("train_status"),
        F.when(k % 7 != 3, F.floor(F.col("value") * 10)).alias("arrival_seconds"),
        F.when(k % 11 != 0, (k % 7).cast("bigint")).alias("arrival_status_code"),
        F.when(k >= 95, True).when(k >= 5, False).alias("is_last_train"),
    )


def bronze_arrivals(events: DataFrame, *more: Column) -> DataFrame:
    """Raw text arrivals with three time formats, junk text and absent columns."""
    k, user, t, form = F.col("k"), F.col("user_id"), F.col("t"), F.col("event_id") % 4
    received = (
        F.when(k % 10 == 0, None)
        .when(form == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 1, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 2, F.date_format(t, "yyyyMMddHHmmss"))
        .otherwise("soon")
    )
    station = (
        F.when(k % 13 == 0, "x").when(k % 17 == 0, "1.7").otherwise(user.cast("string"))
    )
    return _keyed(events).select(
        received.alias("recptnDt"),
        station.alias("statnId"),
        F.concat(F.lit("ST"), user).alias("statnNm"),
        (F.lit(1001) + user % 9).cast("string").alias("subwayId"),
        F.when(F.col("event_id") % 2 == 0, "up").otherwise("down").alias("updnLine"),
        (user - 1).cast("string").alias("statnFid"),
        (user + 1).cast("string").alias("statnTid"),
        F.col("event_id").cast("string").alias("btrainNo"),
        F.col("event_type").alias("btrainSttus"),
        F.when(k % 7 == 3, "").otherwise(F.floor(F.col("value") * 10).cast("string")).alias("barvlDt"),
        F.when(k % 11 != 0, (k % 7).cast("string")).alias("arvlCd"),
        F.when(k >= 95, "1").when(k >= 5, "0").otherwise("2").alias("lstcarAt"),
        t.alias("snapshot_ts"),
        *(c.alias(n) for n, c in hour_part_columns(t).items()),
        *more,
    )


def bronze_usage(lineitem: DataFrame) -> DataFrame:
    """Raw text ridership with repeated registrations, unknown and negative counts."""
    day = F.date_add(
        F.lit("2024-01-01").cast("date"),
        F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")) % 30,
    )
    number = F.col("l_linenumber")
    boarded = (
        F.when((number == 7) & (F.col("l_tax") > 0.07), "-1")
        .when(F.col("l_quantity") % 25 == 0, None)
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    return lineitem.select(
        F.date_format(day, "yyyyMMdd").alias("USE_YMD"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("SBWY_ROUT_LN_NM"),
        F.concat(F.lit("ST"), F.col("l_suppkey")).alias("SBWY_STNS_NM"),
        boarded.alias("GTON_TNOPE"),
        number.cast("string").alias("GTOFF_TNOPE"),
        F.date_format(F.date_add(day, 3 + number % 3), "yyyyMMdd").alias("REG_YMD"),
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("run_ts"),
    )


def station_reference(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """One station per supplier, its nation standing in for the line name."""
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        (F.lit(1001) + F.col("s_suppkey") % 9).alias("SUBWAY_ID"),
        F.col("s_suppkey").alias("STATN_ID"),
        F.concat(F.lit("ST"), F.col("s_suppkey")).alias("STATN_NM"),
        F.col("n_name").alias("호선이름"),
    )


def pipeline_messages(events: DataFrame) -> DataFrame:
    """Every event as a keyed JSON message of its own event type."""
    day = F.date_format("ts", "yyyyMMdd")
    body = F.struct(
        F.col("event_type").alias("event"),
        F.lit("transit").alias("project"),
        day.alias("target_ymd"),
        F.struct(
            F.concat(F.lit("gold/arrival/dt="), day).alias("arrival"),
            F.concat(F.lit("gold/position/dt="), day).alias("position"),
        ).alias("gold"),
        F.col("event_id").cast("string").alias("run_id"),
    )
    return events.select(
        F.concat_ws(":", "event_type", day).alias("key"), F.to_json(body).alias("value")
    )


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Times without zone and doubles rounded, as the SQL side gives them."""
    def shown(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            column = F.round(column, digits)
        return column.alias(f.name)

    return df.select(*(shown(f) for f in df.schema.fields))
