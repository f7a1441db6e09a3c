import pytest
from pyspark.sql import functions as F

from railpulse.operators import alerts as A
from tests.helpers import at, rows

SCHEMA = (
    "window_start_ts timestamp, window_end_ts timestamp, station_name string, line_id bigint, "
    "updn_line string, n bigint, long_ratio_10m double, p90_eta_sec bigint"
)


def metrics(spark, *given, hour=10):
    start, end = at(f"2024-01-01 {hour:02d}:00:00"), at(f"2024-01-01 {hour:02d}:15:00")
    return spark.createDataFrame([(start, end, s, 1, "up", n, r, p) for s, n, r, p in given], SCHEMA)


def alerts_of(spark, *given):
    return A.delay_alerts(metrics(spark, *given)).collect()


def test_thresholds(spark):
    assert not alerts_of(spark, ("A", 199, 1.0, 900))
    assert len(alerts_of(spark, ("A", 200, 0.25, 0))) == 1
    assert not alerts_of(spark, ("A", 200, 0.2499, 599))
    assert len(alerts_of(spark, ("A", 200, 0.0, 600))) == 1
    assert not alerts_of(spark)


def test_weights_and_null_p90(spark):
    health = A.window_health(metrics(spark, ("A", 100, 0.5, 1000), ("B", 300, 0.1, None))).first()
    assert (health.total_n, health.groups) == (400, 2)
    assert health.delay_ratio_10m_weighted == 0.2
    # The null p90 is missing above the line only.
    assert health.p90_eta_sec_weighted == 250.0
    assert A.window_health(metrics(spark, ("A", 5, 0.0, None))).first().p90_eta_sec_weighted == 0.0


def test_attached_stations(spark):
    given = [(f"S{i:02d}", 20 + i, 0.9 - i / 100, 700) for i in range(12)] + [("few", 19, 1.0, 999)]
    alert = alerts_of(spark, *given)[0]
    assert [s.station_name for s in alert.top_stations] == [f"S{i:02d}" for i in range(10)]
    assert "S00, line 1 up: 20 rows, 0.90 wait long, p90 700 s" in alert.alert_text
    assert "few" not in alert.alert_text
    # No station has enough rows: the alert stands without a list.
    bare = alerts_of(spark, *((f"x{i}", 10, 1.0, None) for i in range(20)))[0]
    assert bare.top_stations is None and bare.alert_text.endswith("Most delayed:\n")


def test_order_of_delayed_stations(spark):
    given = [("A", 20, 0.5, 1), ("B", 30, 0.5, 1), ("C", 20, 0.6, 1), ("D", 30, 0.5, 1)]
    got = A.delayed_stations(metrics(spark, *given), k=3)
    assert rows(got, "position", "station_name") == [(1, "C"), (2, "B"), (3, "D")]


def test_missing_windows(spark):
    both = metrics(spark, ("A", 1, 0.0, 1)).unionAll(metrics(spark, ("A", 1, 0.0, 1), hour=11))
    gaps = A.missing_windows(both, slide=15)
    assert rows(gaps, "window_end_ts") == [
        (at(f"2024-01-01 {t}:00"),) for t in ("10:30", "10:45", "11:00")
    ]
    assert rows(gaps, "window_start_ts")[0] == (at("2024-01-01 10:15:00"),)
    wide = A.missing_windows(
        both, slide=5, first_end=at("2023-12-31 23:55:00"), last_end=at("2024-01-01 00:10:00")
    )
    assert rows(wide, "window_end_ts") == [
        (at(t),) for t in ("2023-12-31 23:55:00", "2024-01-01 00:00:00", "2024-01-01 00:05:00", "2024-01-01 00:10:00")
    ]
    assert A.missing_windows(both.where("false")).isEmpty()


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul"])
@pytest.mark.parametrize("slide", [5, 7, 480, 2000])
def test_missing_windows_of_any_slide(spark, zone, slide):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        first = 1_704_067_200 // (slide * 60) * slide * 60
        ends = [first + i * slide * 60 for i in range(2500)]
        gaps = set(ends[3:5] + ends[1200:1201])
        present = spark.createDataFrame([(e,) for e in ends if e not in gaps], "s bigint").select(
            F.timestamp_seconds("s").alias("window_end_ts")
        )
        assert A.missing_windows(present.where("true"), slide=slide).count() == len(gaps)
        found = A.missing_windows(present, slide=slide, minutes=15)
        got = found.select(F.unix_seconds("window_end_ts"), "alert_text").collect()
        assert {r[0] for r in got} == gaps
        assert all(r.alert_text.startswith("No arrival metrics from 20") for r in got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
