import json
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from railpulse.plans import arrivals as A
from railpulse.plans import daily as D
from railpulse.plans import live as L
from railpulse.plans import ridership as R
from railpulse.plans.lake import Lake
from railpulse.session import shared_folder
from railpulse.sources.tables import read_table
from tests.helpers import at, rows


@pytest.fixture
def lake(folder):
    return Lake(folder("lake"))


def board(spark, *rows_in):
    doc = {"realtimeArrivalList": [
        {"recptnDt": t, "statnId": "1", "statnNm": "A", "subwayId": "1001", "updnLine": "up",
         "barvlDt": str(wait), "arvlCd": "1", "btrainSttus": "급행", "lstcarAt": last}
        for t, wait, last in rows_in
    ]}
    return spark.createDataFrame([(json.dumps(doc),)], "body string")


def test_arrival_chain(spark, lake):
    with pytest.raises(Exception):
        A.refresh_silver(spark, lake)
    A.land_snapshot(board(spark, ("2024-01-05 09:58:00", 700, "0"), ("2024-01-05 09:59:00", 100, "1")),
                    lake, F.lit(at("2024-01-05 09:59:30")))
    assert A.refresh_silver(spark, lake) == {"year": 2024, "month": 1, "day": 5, "hour": 9}
    A.land_snapshot(board(spark, ("2024-01-05 09:59:30", 650, "0"), ("2024-01-05 10:02:00", 50, "0")),
                    lake, F.lit(at("2024-01-05 10:04:30")))
    assert A.refresh_silver(spark, lake)["hour"] == 10
    as_of = at("2024-01-05 10:06:00")
    for _ in range(2):
        assert A.refresh_metrics(spark, lake, as_of) == 1
        stored = A.read_metrics(spark, lake)
        # The window crosses the hour, and one row was filed an hour after its event.
        assert rows(stored, "station_name", "n", "p90_eta_sec", "long_ratio_10m", "last_train_seen") == [
            ("A", 4, 700, 0.5, True)
        ]
    # A window without rows is left alone.
    assert A.refresh_metrics(spark, lake, at("2024-01-05 12:00:00")) == 0
    assert A.check_delays(spark, lake, as_of).isEmpty()
    raised = A.check_delays(spark, lake, as_of, min_total=4, min_samples=1).first()
    assert raised.total_n == 4 and raised.top_stations[0].station_name == "A"

    for _ in range(2):
        A.build_day(spark, lake, "20240105")
    assert read_table(spark, lake.arrival_events).count() == 4
    kpi = read_table(spark, lake.station_kpi)
    assert rows(kpi, "station_name", "total_events", "express_ratio", "last_train_dt") == [
        ("A", 4, 1.0, at("2024-01-05 09:59:00"))
    ]
    assert rows(A.backfill_kpi(spark, lake), "total_events", "year", "day") == [(4, 2024, 5)]


def test_error_board_stops_the_run(spark, lake):
    doc = spark.createDataFrame([('{"errorMessage":{"code":"E"}}',)], "body string")
    with pytest.raises(RuntimeError, match="E"):
        A.land_snapshot(doc, lake, F.lit(at("2024-01-05 10:00:00")))


def test_landing_with_errors_set_aside(spark, lake, folder):
    error = spark.createDataFrame([('{"errorMessage":{"code":"E"}}',)], "body string")
    documents = board(spark, ("2024-01-05 09:58:00", 700, "0")).union(error).union(
        board(spark, ("2024-01-05 09:59:00", 100, "1"))
    )
    at_nine = F.lit(at("2024-01-05 09:59:30"))
    with pytest.raises(RuntimeError, match="rejected: E"):
        A.land_snapshot(documents.repartition(3), lake, at_nine)
    with pytest.raises(AnalysisException):  # nothing of the batch was committed
        read_table(spark, lake.bronze_arrivals).count()
    A.land_snapshot(documents, lake, at_nine, rejects=folder("refused"))
    assert rows(read_table(spark, lake.bronze_arrivals), "barvlDt") == [("100",), ("700",)]
    assert rows(read_table(spark, folder("refused")), "body", "reason") == [('{"errorMessage":{"code":"E"}}', "E")]


def page(spark, *counts):
    row = [{"USE_YMD": "20240101", "SBWY_ROUT_LN_NM": "1", "SBWY_STNS_NM": "A", "GTON_TNOPE": on,
            "GTOFF_TNOPE": off, "REG_YMD": reg} for on, off, reg in counts]
    return spark.createDataFrame([(json.dumps({"CardSubwayStatsNew": {"row": row}}),)], "body string")


def test_ridership_chain_and_report(spark, lake):
    assert R.build_day(spark, lake, "20240101") is False
    R.land_pages(page(spark, (5, 6, "20240104")), lake, F.lit(at("2024-01-05 01:00:00")))
    R.land_pages(page(spark, (7, 8, "20240104")), lake, F.lit(at("2024-01-05 02:00:00")))
    assert R.refresh_silver(spark, lake, "20240101") == 1
    assert R.build_day(spark, lake, "20240101") is True
    assert rows(read_table(spark, lake.station_usage), "stnNm", "lineNm", "totalNope", "day") == [("A", "1", 15, 1)]
    assert rows(read_table(spark, lake.line_usage), "lineNm", "totalNope") == [("1", 15)]
    assert R.build_day(spark, lake, "20240102") is False

    # Report of the 5th: ridership of the 1st, no arrivals yet.
    D.write_context(spark, lake, "20240105")
    doc = json.loads(spark.read.text(lake.report_context).first().value)
    assert doc["usage"]["top_stations_by_total"] == [
        {"station_name": "A", "line_name": "1", "totalNope": 15, "rank_daily": None}
    ]
    assert doc["arrival"] == {"has_data": False}

    A.land_snapshot(board(spark, ("2024-01-05 22:00:00", 120, "1")), lake, F.lit(at("2024-01-05 22:00:30")))
    A.refresh_silver(spark, lake)
    A.build_day(spark, lake, "20240105")
    D.write_context(spark, lake, "20240105")
    doc = json.loads(spark.read.text(lake.report_context).first().value)
    assert doc["arrival"]["painful_stations"][0]["totalNope"] == 15
    assert doc["arrival"]["late_night_hotspots"][0]["late_night_events"] == 1
    assert D.build_context(spark, lake, "20230101").isEmpty()


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(root) and one != two


def test_live_chain_equals_batch_runs(spark, lake, folder):
    for minute, wait in ((0, 700), (6, 650), (13, 100), (50, 90)):
        A.land_snapshot(board(spark, (f"2024-01-05 09:{minute:02d}:00", wait, "0")), lake,
                        F.lit(at(f"2024-01-05 09:{minute:02d}:30")))
    delivered = []
    for _ in range(2):  # the second run finds nothing new
        L.watch_arrivals(
            spark, lake, folder("state"), lambda found: delivered.extend(found.collect()),
            every=None, min_total=2, min_samples=1,
        ).awaitTermination()
    live = rows(A.read_metrics(spark, lake), "window_end_ymdhm", "n", "p90_eta_sec")
    assert live[0] == ("202401050905", 1, 700) and ("202401050915", 3, 700) in live
    assert [a.total_n for a in delivered if a.window_end_ts == at("2024-01-05 09:15:00")] == [3]

    A.refresh_silver(spark, lake)
    A.refresh_metrics(spark, lake, at("2024-01-05 09:17:00"))
    again = rows(A.read_metrics(spark, lake), "window_end_ymdhm", "n", "p90_eta_sec")
    assert again == live


@pytest.fixture(params=["UTC", "America/New_York"])
def machine_zone(request, monkeypatch):
    """The clock zone of the driver's machine, which is not the session's."""
    monkeypatch.setenv("TZ", request.param)
    time.tzset()
    yield
    monkeypatch.undo()
    time.tzset()


@pytest.mark.parametrize("zone", ["Asia/Seoul", "UTC"])
def test_window_bounds_are_of_the_session_zone(spark, lake, zone, machine_zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        snapshot = F.lit("2024-01-05 10:04:30").cast("timestamp")
        A.land_snapshot(board(spark, ("2024-01-05 10:02:00", 700, "0"), ("2024-01-05 10:03:00", 900, "0")), lake, snapshot)
        A.refresh_silver(spark, lake)
        as_of = at("2024-01-05 10:06:00")
        assert A.refresh_metrics(spark, lake, as_of) == 1
        raised = A.check_delays(spark, lake, as_of, min_total=2, min_samples=1)
        assert raised.count() == 1
        assert raised.first().alert_text.startswith("Long waits from 2024-01-05 09:50:00 to 2024-01-05 10:05:00: 2 rows")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_report_holds_the_rows_of_its_run_day(spark, lake):
    A.land_snapshot(board(spark, ("2024-01-05 22:00:00", 120, "0")), lake, F.lit(at("2024-01-05 22:00:30")))
    A.refresh_silver(spark, lake)
    A.build_day(spark, lake, "20240105")
    D.write_context(spark, lake, "20240105")
    before = spark.read.text(lake.report_context).collect()
    # A row of the evening before comes in after midnight.
    A.land_snapshot(board(spark, ("2024-01-05 23:59:00", 300, "0"), ("2024-01-06 00:01:00", 60, "0")),
                    lake, F.lit(at("2024-01-06 00:01:30")))
    A.refresh_silver(spark, lake)
    A.build_day(spark, lake, "20240106")
    assert D.build_context(spark, lake, "20240106").count() == 1
    D.write_context(spark, lake, "20240106")
    after = spark.read.text(lake.report_context).collect()
    assert len(after) == 2 and set(before) <= set(after)
    doc = next(d for d in map(json.loads, (r.value for r in after)) if d["target_ymd"] == "20240106")
    # Both rows were ingested on the 6th, though one is of the 5th.
    assert doc["arrival"]["has_data"] and [s["line_id"] for s in doc["arrival"]["line_wait_stats"]] == [1001]


def test_a_clock_that_runs_ahead_does_not_stop_the_stream(spark, lake, folder):
    seen = []
    for minute, received in ((1, "2024-01-05 09:01:00"), (6, "2034-01-05 09:06:00"), (30, "2024-01-05 09:30:00"), (59, "2024-01-05 09:59:00")):
        A.land_snapshot(board(spark, (received, 100, "0")), lake, F.lit(at(f"2024-01-05 09:{minute:02d}:30")))
        L.watch_arrivals(
            spark, lake, folder("state"), seen.append, every=None, files_per_trigger=1, min_total=1, min_samples=1,
        ).awaitTermination()
    ends = {r[0] for r in rows(A.read_metrics(spark, lake), "window_end_ymdhm")}
    assert "202401050940" in ends and not any(e.startswith("2034") for e in ends)


def test_fields_without_a_column_are_landed(spark, lake):
    doc = {"realtimeArrivalList": [{"statnId": "1", "ordkey": "01", "subwayList": "1001,1002", "gone": None}]}
    A.land_snapshot(spark.createDataFrame([(json.dumps(doc),)], "body string"), lake, F.lit(at("2024-01-05 10:00:00")))
    landed = read_table(spark, lake.bronze_arrivals).first()
    assert json.loads(landed.other_fields) == {"ordkey": "01", "subwayList": "1001,1002", "gone": None}


def test_items_are_stored_as_text_between_parse_and_table(spark, folder, monkeypatch):
    from catalog import queries
    from railpulse.plans import landing
    from railpulse.sources.envelopes import USAGE, opened, rows_of

    def page(*items, code="INFO-000"):
        return json.dumps({"CardSubwayStatsNew": {"RESULT": {"CODE": code, "MESSAGE": "m"}, "row": list(items)}})

    docs = spark.createDataFrame(
        [
            (1, page({"USE_YMD": "20240105", "GTON_TNOPE": 1.50, "more": {"a": [1]}}, {"REG_YMD": None}, 7)),
            (2, page({"USE_YMD": "20240106"}, code="INFO-200")),
            (3, page()),
            (4, "no json"),
        ],
        "n int, body string",
    )
    stored, held = [], landing.held
    monkeypatch.setattr(landing, "held", lambda df, label: stored.append(df) or held(df, label))
    root, refused = folder("bronze"), folder("refused")
    landing.land(docs, USAGE, lambda found: found, root, partition_by=("n",), rejects=refused)
    assert "variant" not in str(dict(stored[0].dtypes))
    expected = rows_of(opened(docs, USAGE), USAGE)
    assert len(rows(expected)) == 3
    assert rows(read_table(spark, root), *expected.columns) == rows(expected)
    assert rows(read_table(spark, refused), "n", "reason") == [(2, "INFO-200 m"), (4, "no usage envelope")]

    # Rows are dealt out before they are made JSON, not after.
    lineitem = spark.createDataFrame(
        [(1, 2, 3, 4.0, 0.01, "A", "F", at("1994-01-01 00:00:00"))],
        "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    )
    monkeypatch.setattr(queries.I, "table", lambda *_: lineitem)
    plan = queries._usage_pages(spark, "")._jdf.queryExecution().analyzed().toString()
    assert 0 <= plan.index("to_json") < plan.index("RebalancePartitions")
