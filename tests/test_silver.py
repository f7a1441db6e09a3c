from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.operators import ranking, silver
from tests.helpers import at, plan_of, rows, usage


def test_silver_arrivals(spark):
    bronze = spark.createDataFrame(
        [
            ("2024-01-01 10:00:00", at("2024-01-01 10:02:00"), "12", "x", "1", "300", "extra"),
            ("junk", at("2024-01-01 10:02:00"), "1.7", "1001", "0", "", "extra"),
            (None, None, None, None, "2", None, None),
        ],
        "recptnDt string, snapshot_ts timestamp, statnId string, subwayId string, "
        "lstcarAt string, barvlDt string, surplus string",
    ).withColumns({p: F.lit("01") for p in S.ARRIVAL_PARTITION})
    got = silver.silver_arrivals(bronze)
    assert len(got.columns) == 23
    assert dict(got.dtypes)["dest_station_id"] == "bigint"
    assert rows(
        got, "event_time", "station_id", "line_id", "is_last_train", "arrival_seconds", "hour"
    ) == [
        (None, None, None, None, None, 1),
        (at("2024-01-01 10:00:00"), 12, None, True, 300, 1),
        (at("2024-01-01 10:02:00"), None, 1001, False, None, 1),
    ]
    assert "Exchange" not in plan_of(got)


def test_keep_latest_versions_and_ties(spark):
    df = usage(
        spark,
        ("20240101", "A", "1", "20240104", "r1", "1", "1"),
        ("20240101", "A", "1", "20240105", "r1", "2", "1"),
        ("20240101", "A", "1", "20240105", "r2", "3", "1"),
        ("20240101", "B", "1", "20240104", "r1", "4", "1"),
        ("20240101", "B", "1", "20240104", "r1", "5", "1"),
        ("20240101", None, "1", "20240104", "r1", "6", "1"),
    )
    latest = silver.latest_usage(df)
    assert rows(latest, "SBWY_STNS_NM", "GTON_TNOPE") == [(None, "6"), ("A", "3"), ("B", "5")]
    assert rows(silver.latest_usage(latest)) == rows(latest)


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = plan_of(ranking.keep_latest(df, ["k"], ["v"]))
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "Final" in before and "Partial" in after


def test_silver_usage(spark):
    df = usage(
        spark,
        ("20240101", "A", "1", "20240104", "r", None, "5"),
        ("20240101", "B", "1", "20240104", "r", "-1", "5"),
        ("20240101", "C", "1", "bad", "r", "7", "x"),
    )
    got = silver.silver_usage(df)
    assert rows(got, "station_name", "ride_count", "alight_count", "total_count", "reg_date") == [
        ("A", 0, 5, 5, date(2024, 1, 4)),
        ("C", 7, 0, 7, None),
    ]
    assert rows(got.select("use_ymd", "use_date", "year", "month", "day").distinct()) == [
        ("20240101", date(2024, 1, 1), 2024, 1, 1)
    ]
    assert silver.silver_usage(df, drop_negative=False).count() == 3
    assert silver.silver_usage(df, use_ymd="20240202").first().use_date == date(2024, 2, 2)


def test_landing(spark):
    rows_in = spark.createDataFrame([("20240309", ("a",), 5)], "USE_YMD string, n struct<x:string>, c int")
    landed = silver.land_usage(rows_in, F.lit(at("2024-03-12 01:02:03")))
    assert landed.drop("ingested_at").first() == (
        "20240309", '{"x":"a"}', "5", "20240312T010203", 2024, 3, 9,
    )
    board = silver.land_arrivals(rows_in, F.lit(at("2024-03-12 01:02:03")))
    assert board.select("run_ts", "hour", "minute").first() == ("20240312T010203", 1, 2)


def test_top_k_orders_ties_by_all_columns(spark):
    df = spark.createDataFrame(
        [("a", "x", 5), ("a", "y", 5), ("a", "z", 4), ("b", "q", None), ("b", "p", 1)],
        "g string, n string, v int",
    )
    order = [F.col("v").desc_nulls_last()]
    assert rows(ranking.top_k(df, 2, order), "n") == [("x",), ("y",)]
    by_group = ranking.top_k(df, 1, order, within=["g"], position="p")
    assert rows(by_group, "g", "n", "p") == [("a", "x", 1), ("b", "p", 1)]
    numbered = ranking.top_k(df, 3, order, position="p")
    assert rows(numbered, "p", "n") == [(1, "x"), (2, "y"), (3, "z")]
    assert "TakeOrderedAndProject" in plan_of(ranking.top_k(df, 2, order))


def test_rank_within_equals_rank(spark):
    """Skewed, tied and null values against the plain window rank."""
    df = spark.range(4000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('g', id % 7) END AS g",
        "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 4 = 0 THEN 10 ELSE hash(id) % 500 END AS v",
        "id",
    )
    expected = df.where("v is not null").selectExpr(
        "id", "rank() OVER (PARTITION BY g ORDER BY v DESC) AS r"
    )
    got = ranking.rank_within(df, ["g"], "v", name="r")
    assert got.count() == 4000
    assert rows(got.where("v is not null").selectExpr("id", "r")) == rows(
        expected.selectExpr("id", "cast(r as bigint) r")
    )
    assert got.where("v is null and r is not null").isEmpty()


def test_rank_of_one_group_that_holds_all_rows(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = spark.range(3000).selectExpr("'all' AS g", "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 400 END AS v", "id")
        got = ranking.rank_within(df, ["g"], "v", name="r")
        expected = df.selectExpr("id", "cast(rank() OVER (PARTITION BY g ORDER BY v DESC) as bigint) AS r")
        assert rows(got.select("id", "r")) == rows(expected)
        plan = plan_of(got)
        assert plan.count("Exchange") - plan.count("BroadcastExchange") <= 4 and "Window" not in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert ranking.rank_within(df.limit(0), ["g"], "v").count() == 0
    whole = ranking.rank_within(df, [], "v", name="r").where("id in (3, 399, 400)")
    assert rows(whole.select("id", "v", "r")) == rows(df.selectExpr("id", "v", "cast(rank() OVER (ORDER BY v DESC) as bigint) AS r").where("id in (3, 399, 400)"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=15))
def test_keep_latest_property(spark, data):
    df = spark.createDataFrame(data, "k string, version int, v int")
    best = {}
    for k, version, v in data:
        best[k] = max(best.get(k, (-1, -1)), (version, v))
    assert rows(ranking.keep_latest(df, ["k"], ["version"])) == sorted((k, *b) for k, b in best.items())


def test_latest_usage_sorts_stations_first(spark):
    """A sort tells rows apart by the first eight bytes of its first column, where it can."""
    df = usage(
        spark,
        ("20240101", "A", "1", "20240104", "r1", "1", "1"),
        ("20240101", "A", "1", "20240105", "r1", "2", "1"),
        ("20240102", "A", "1", "20240105", "r1", "3", "1"),
        ("20240101", None, "1", None, "r1", "4", "1"),
        ("20240101", None, "1", "20240104", None, None, "1"),
    )
    latest = silver.latest_usage(df)
    assert rows(latest, "USE_YMD", "SBWY_STNS_NM", "GTON_TNOPE") == [
        ("20240101", None, None), ("20240101", "A", "2"), ("20240102", "A", "3")
    ]
    first = plan_of(latest).split("Sort [")[1]
    assert first.startswith("SBWY_STNS_NM")
