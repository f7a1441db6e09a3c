import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railpulse.functions.times import window_ending_at
from railpulse.operators import metrics as M
from tests.helpers import arrivals, at, plan_of, rows

SHOWN = ("station_name", "n", "avg_eta_sec", "p90_eta_sec", "long_ratio_10m", "last_train_seen")


def test_single_window_bounds_and_nulls(spark):
    df = arrivals(
        spark,
        {"event_time": "2024-01-01 09:49:59", "arrival_seconds": 1},
        {"event_time": "2024-01-01 09:50:00", "arrival_seconds": 600},
        {"event_time": "2024-01-01 10:04:59", "arrival_seconds": 100},
        {"event_time": "2024-01-01 10:05:00", "arrival_seconds": 1},
        {"snapshot_ts": "2024-01-01 10:00:00"},
        {"station_name": "B", "event_time": "2024-01-01 10:00:00", "is_last_train": True},
    )
    got = M.window_metrics(df, at("2024-01-01 10:07:00"))
    assert rows(got, *SHOWN) == [
        ("A", 3, 350.0, 600, 1 / 3, False),
        ("B", 1, None, None, 0.0, True),
    ]
    assert rows(got.select("window_start_ts", "window_end_ts", "window_end_ymdhm", "hour").distinct()) == [
        (at("2024-01-01 09:50:00"), at("2024-01-01 10:05:00"), "202401011005", 10)
    ]
    own_time = M.window_metrics(df, at("2024-01-01 10:07:00"), time_columns=("event_time",))
    assert rows(own_time, "station_name", "n") == [("A", 2), ("B", 1)]


def test_each_event_is_in_three_windows(spark):
    df = arrivals(
        spark,
        {"event_time": "2024-01-01 10:00:00", "arrival_seconds": 5},
        {"event_time": "2024-01-01 10:04:59", "arrival_seconds": 7},
        {},
    )
    got = M.sliding_metrics(M.with_event_time(df))
    assert rows(got, "window_end_ymdhm", "n", "p90_eta_sec") == [
        ("202401011005", 2, 7), ("202401011010", 2, 7), ("202401011015", 2, 7),
    ]


@pytest.mark.parametrize(("minutes", "slide"), [(15, 5), (10, 10), (15, 10), (60, 20)])
def test_panes_equal_repeated_rows(spark, minutes, slide):
    """Counts over panes against the plain aggregation of repeated rows, one station
    holding a third of all rows."""
    df = spark.range(6000).selectExpr(
        "timestamp_seconds(1704067200 + (hash(id) % 7200)) AS event_ts",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 40 END AS station_id",
        "cast(null as string) AS station_name",
        "id % 2 AS line_id",
        "'up' AS updn_line",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE cast(abs(hash(id, 1)) % 900 AS bigint) END AS arrival_seconds",
        "CASE WHEN id % 90 = 0 THEN true WHEN id % 2 = 0 THEN false END AS is_last_train",
    )
    size = {"minutes": minutes, "slide": slide}
    got = M.sliding_metrics(df, **size)
    plain = M.metrics_in_one_pass(df, accuracy=100000, **size)
    assert got.columns == plain.columns and got.dtypes == plain.dtypes
    assert rows(got) == rows(plain)


def test_single_window_equals_its_sliding_window(spark):
    df = spark.range(500).selectExpr(
        "timestamp_seconds(1704067200 + id * 7) AS event_time", "cast(null as timestamp) AS snapshot_ts",
        "id % 5 AS station_id", "'s' AS station_name", "1L AS line_id", "'up' AS updn_line",
        "id * 3 AS arrival_seconds", "id % 2 = 0 AS is_last_train",
    )
    one = M.window_metrics(df, at("2024-01-01 00:31:00"))
    all_of = M.sliding_metrics(M.with_event_time(df)).where("window_end_ymdhm = '202401010030'")
    assert rows(one) == rows(all_of) and one.count() == 5


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=1, max_size=40),
    st.sampled_from([0.5, 0.9, 0.95, 1.0]),
)
def test_percentile_property(spark, waits, share):
    df = arrivals(
        spark, *({"event_time": "2024-01-01 10:00:00", "arrival_seconds": w} for w in waits)
    )
    got = M.window_metrics(df, at("2024-01-01 10:05:00"), percentile=share).first()
    known = sorted(w for w in waits if w is not None)
    assert got.n == len(waits)
    if not known:
        assert got.p90_eta_sec is None and got.avg_eta_sec is None
        return
    assert got.avg_eta_sec == pytest.approx(statistics.fmean(known))
    below = [w for w in known if w <= got.p90_eta_sec]
    strictly = [w for w in known if w < got.p90_eta_sec]
    assert len(below) >= share * len(known) - 1e-9 and len(strictly) < share * len(known) + 1e-9


def test_hours_touching_a_window(spark):
    hours = spark.range(24).selectExpr("2024 year", "1 month", "1 day", "cast(id as int) hour")
    window = window_ending_at(at("2024-01-01 10:07:00"))
    touched = lambda w, late: [r[0] for r in hours.where(M.hours_touching(w, late)).select("hour").collect()]
    assert touched(window, 0) == [9, 10]
    assert touched(window, 1) == [9, 10, 11]
    assert touched(window_ending_at(at("2024-01-01 10:00:00")), 0) == [9]


def test_range_reaches_the_scan(spark, folder):
    df = arrivals(spark, {"event_time": "2024-01-01 10:00:00"})
    df.write.parquet(folder("t"))
    stored = spark.read.parquet(folder("t"))
    plan = plan_of(M.window_metrics(stored, at("2024-01-01 10:05:00"), time_columns=("event_time",)))
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan
    assert "train_status" not in plan


def test_no_group_table_is_held_beside_the_sorted_rows(spark):
    """What follows the running count reads its order: no aggregation comes after it."""
    from railpulse.operators.stations import enrich_events, station_kpi

    given = arrivals(
        spark,
        *({"event_time": "2024-01-05 10:01:00", "arrival_seconds": w, "is_last_train": w == 700} for w in (700, 700, 30)),
        {"event_time": "2024-01-05 10:02:00"},
        {"event_time": "2024-01-05 10:02:00", "station_id": None, "station_name": None},
    )
    sliding = M.sliding_metrics(M.with_event_time(given), minutes=5, slide=5)
    kpi = station_kpi(enrich_events(given, null_wait="ignore"))
    for df in (sliding, kpi):
        above = plan_of(df).split("Window [")[0]
        assert "Aggregate" not in above
    names = ("station_name", "n", "avg_eta_sec", "p90_eta_sec", "long_ratio_10m", "last_train_seen")
    assert rows(sliding, *names) == [
        (None, 1, None, None, 0.0, False),
        ("A", 4, 1430 / 3, 700, 0.5, True),
    ]
    names = ("station_name", "total_events", "avg_wait_sec", "p95_wait_sec", "last_train_dt", "last_train_wait_sec")
    assert rows(kpi, *names) == [
        (None, 1, None, None, None, None),
        ("A", 4, 1430 / 3, 700, at("2024-01-05 10:01:00"), 700.0),
    ]


def test_percentile_of_histograms_of_any_size(spark):
    from railpulse.operators.percentiles import percentile_of_histogram

    given = [(1, []), (2, [(7, 3)]), (3, [(9, 1), (7, 9)]), (4, [(9, 2), (7, 9)]), (5, [(7, 5), (9, 1), (7, 5)])]
    df = spark.createDataFrame(given, "n int, h array<struct<arrival_seconds: long, _rows: long>>")
    share = percentile_of_histogram(F.col("h"), "arrival_seconds", 0.9)
    assert str(share).index("CASE WHEN") < str(share).index("aggregate")  # one value is not walked
    assert rows(df.select("n", share.alias("p"))) == [(1, None), (2, 7), (3, 7), (4, 9), (5, 7)]
