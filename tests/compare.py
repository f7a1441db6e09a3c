"""Runs registered queries against their SQL in DuckDB and compares the values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, db, sf_dir: str, name: str, build, sql: str) -> str | None:
    """None when equal, else what differs."""
    ours = build(spark, sf_dir)
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(ours.columns):
        return f"columns {sorted(ours.columns)} and {sorted(names)}"
    expected = _rows(names, result.fetchall())
    actual = _rows(ours.columns, ours.collect())
    if actual != expected:
        return (
            f"{sum(actual.values())} and {sum(expected.values())} rows; only ours "
            f"{list((actual - expected).items())[:2]}; only SQL {list((expected - actual).items())[:2]}"
        )
    types = dict(ours.dtypes)
    kinds = {d[0]: str(d[1]).upper() for d in result.description}
    odd = {n: (types[n], kinds[n]) for n in names if _kind(types[n]) != _kind(kinds[n])}
    return f"types {odd}" if odd else None


def _kind(name: str) -> str:
    name = name.lower()
    for kind, members in {
        "bigint": ("bigint", "hugeint"),
        "int": ("int", "integer"),
        "string": ("string", "varchar"),
        "double": ("double",),
        "bool": ("boolean", "bool"),
        "time": ("timestamp_ntz", "timestamp"),
    }.items():
        if name in members:
            return kind
    return name


if __name__ == "__main__":
    import __spark_entry__ as entry

    from railpulse.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "compare",
        zone="UTC",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql = database(sf_dir), entry.oracle_sql()
    for name in wanted:
        started = time.perf_counter()
        try:
            verdict = compare(spark, db, sf_dir, name, entry.queries()[name], sql[name])
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:36s} {time.perf_counter() - started:6.2f}s {verdict or 'ok'}", flush=True)
