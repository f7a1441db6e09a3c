"""Small-frame helpers for golden-row tests."""

from datetime import datetime

from pyspark.sql import functions as F


def at(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def rows(df, *columns):
    """Sorted tuples of a frame's columns, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


ARRIVAL_SCHEMA = (
    "event_time timestamp, snapshot_ts timestamp, recptn_dt timestamp, station_id bigint, "
    "station_name string, line_id bigint, updn_line string, train_status string, "
    "arrival_seconds bigint, arrival_status_code bigint, is_last_train boolean"
)


def arrivals(spark, *given):
    """Silver arrivals from dicts; times as text, the rest defaulted."""
    defaults = {
        "station_id": 1,
        "station_name": "A",
        "line_id": 1001,
        "updn_line": "up",
        "train_status": "일반",
        "arrival_seconds": None,
        "arrival_status_code": None,
        "is_last_train": None,
        "event_time": None,
        "snapshot_ts": None,
        "recptn_dt": None,
    }
    names = [f.split(" ")[0] for f in ARRIVAL_SCHEMA.split(", ")]

    def value(row, name):
        v = {**defaults, **row}[name]
        return at(v) if isinstance(v, str) and name in names[:3] else v

    data = [tuple(value(r, n) for n in names) for r in given]
    return spark.createDataFrame(data, ARRIVAL_SCHEMA)


def usage(spark, *given, schema=None):
    schema = schema or (
        "USE_YMD string, SBWY_STNS_NM string, SBWY_ROUT_LN_NM string, REG_YMD string, "
        "run_ts string, GTON_TNOPE string, GTOFF_TNOPE string"
    )
    return spark.createDataFrame(list(given), schema)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return plan_of(df).count("Exchange hashpartitioning")


def count_of(df) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]
