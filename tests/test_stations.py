from datetime import date

import pytest

from railpulse.operators import stations as St
from tests.helpers import arrivals, at, plan_of, rows


def test_enriched_events(spark):
    df = arrivals(
        spark,
        {"event_time": "2024-01-01 22:00:00", "arrival_seconds": 300, "arrival_status_code": 1,
         "train_status": "급행", "is_last_train": True},
        {"recptn_dt": "2024-01-02 02:00:00", "arrival_seconds": 299, "arrival_status_code": 9},
        {"snapshot_ts": "2024-01-02 01:00:00", "train_status": None},
    )
    got = St.enrich_events(df)
    assert set(df.columns) < set(got.columns)
    assert rows(
        got, "event_date", "event_hour", "wait_sec", "is_long_wait_5", "is_last_train_flag",
        "is_express", "arrival_phase", "is_late_night", "arrival_status_code",
    ) == [
        (date(2024, 1, 1), 22, 300, 1, 1, 1, "at_platform", 1, 1),
        (date(2024, 1, 2), 1, 0, 0, 0, 0, "other", 1, -1),
        (date(2024, 1, 2), 2, 299, 0, 0, 0, "other", 0, 9),
    ]
    assert "Exchange" not in plan_of(got)
    ignoring = St.enrich_events(df, null_wait="ignore")
    assert ignoring.where("wait_sec is null").count() == 1
    with pytest.raises(ValueError):
        St.enrich_events(df, null_wait="drop")


def test_kpi_and_joined_form(spark):
    when = {"event_time": "2024-01-01 23:30:00"}
    df = St.enrich_events(
        arrivals(
            spark,
            {**when, "arrival_seconds": 100},
            {**when, "arrival_seconds": 400, "is_last_train": True},
            {"event_time": "2024-01-01 23:40:00", "is_last_train": True},
            {**when, "station_name": "B", "arrival_seconds": 10, "train_status": "ITX"},
            {**when, "station_name": None, "arrival_seconds": 20, "is_last_train": True},
        )
    )
    shown = (
        "station_name", "total_events", "avg_wait_sec", "p95_wait_sec", "long_wait_ratio_5",
        "express_ratio", "late_night_events", "last_train_dt", "last_train_wait_sec",
    )
    a = ("A", 3, 500 / 3, 400, 1 / 3, 0.0, 3, at("2024-01-01 23:40:00"), 200.0)
    b = ("B", 1, 10.0, 10, 0.0, 1.0, 1, None, None)
    unnamed = (None, 1, 20.0, 20, 0.0, 0.0, 1)
    assert rows(St.station_kpi(df), *shown) == [
        (*unnamed, at("2024-01-01 23:30:00"), 20.0), a, b,
    ]
    # In the join a null key never matches.
    assert rows(St.station_kpi_joined(df), *shown) == [(*unnamed, None, None), a, b]


def test_kpi_with_a_hot_station_equals_plain_sql(spark):
    df = St.enrich_events(
        spark.range(9000).selectExpr(
            "timestamp_seconds(1704067200 + id * 20) AS event_time",
            "cast(null as timestamp) recptn_dt", "cast(null as timestamp) snapshot_ts",
            "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 20 END AS station_id", "'s' AS station_name",
            "id % 2 AS line_id", "'일반' AS train_status",
            "CASE WHEN id % 9 = 0 THEN NULL ELSE cast(abs(hash(id)) % 1000 as bigint) END AS arrival_seconds",
            "cast(id % 6 as bigint) AS arrival_status_code", "id % 70 = 0 AS is_last_train",
        )
    )
    keys = "event_date, line_id, station_id, station_name"
    expected = spark.sql(
        f"""SELECT {keys}, count(*) total_events, avg(wait_sec) avg_wait_sec,
        percentile_disc(0.95) WITHIN GROUP (ORDER BY wait_sec) p95_wait_sec,
        avg(is_long_wait_5) long_wait_ratio_5, avg(is_express) express_ratio,
        sum(is_late_night) late_night_events, max(event_dt) FILTER (WHERE is_last_train) last_train_dt,
        avg(wait_sec) FILTER (WHERE is_last_train) last_train_wait_sec
        FROM {{e}} GROUP BY {keys}""",
        e=df,
    )
    names = expected.columns
    assert rows(St.station_kpi(df), *names) == rows(
        expected.selectExpr(*(f"cast({n} as bigint) {n}" if n == "p95_wait_sec" else n for n in names))
    )
    assert rows(St.station_kpi_joined(df)) == rows(St.station_kpi(df))


def test_dimension_join_is_not_forced(spark):
    facts = arrivals(spark, {"event_time": "2024-01-01 10:00:00"}, {"station_id": 5})
    dim = spark.createDataFrame([(1001, 1, "역")], "line_id bigint, station_id bigint, name string")
    joined = St.join_stations(facts, dim, ("line_id", "station_id"))
    assert rows(joined, "station_id", "name") == [(1, "역"), (5, None)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" in plan_of(St.join_stations(facts, dim, ("line_id", "station_id")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
