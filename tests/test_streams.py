import json
import random

import pytest
from pyspark.sql import functions as F

from railpulse.operators import alerts, metrics
from railpulse.sinks import messages as Ms
from railpulse import settings as S
from railpulse.sources import envelopes, topics
from railpulse.sources.tables import read_table
from railpulse.streaming import events, late, runs
from railpulse.streaming.arrivals import distinct_stream, latest_stream, metrics_stream, timed_stream
from tests.helpers import ARRIVAL_SCHEMA, arrivals, at, plan_of, rows

KEYS = ("window_end_ymdhm", "station_name", "n", "p90_eta_sec")


def arriving(spark, folder, *batches):
    """A stream of arrivals, one file per batch, read one file at a time."""
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(folder("in"))
    return topics.file_stream(spark, folder("in"), ARRIVAL_SCHEMA, files_per_trigger=1)


def event(time, wait=5, name="A"):
    return {"event_time": f"2024-01-01 {time}", "arrival_seconds": wait, "station_name": name}


def finished(spark, stream, folder, **args):
    runs.write_files(stream, folder("out"), folder("state"), **args).awaitTermination()
    return read_table(spark, folder("out"))


def test_stream_equals_batch_for_closed_windows(spark, folder):
    batches = [
        arrivals(spark, *(event(f"10:{m:02d}:00", m, "AB"[m % 2]) for m in range(0, 30))),
        arrivals(spark, *(event(f"10:{m:02d}:30", m, "AB"[m % 2]) for m in range(25, 59))),
    ]
    out = finished(spark, metrics_stream(arriving(spark, folder, *batches)), folder)
    batch = metrics.sliding_metrics(metrics.with_event_time(batches[0].unionAll(batches[1])))
    closed = batch.where(F.col("window_end_ts") <= F.lit(at("2024-01-01 10:48:30")))
    assert rows(out, *KEYS) == rows(closed, *KEYS)
    assert set(out.columns) == set(batch.columns)


def test_late_rows(spark, folder):
    """Late within the delay counts; later than that is left to a batch re-run."""
    stream = arriving(
        spark, folder,
        arrivals(spark, event("10:01:00"), event("10:14:00")),
        arrivals(spark, event("10:05:30", 7), event("11:00:00")),
        arrivals(spark, event("12:00:00")),
        arrivals(spark, event("10:02:00", 9), event("13:00:00")),
    )
    out = finished(spark, metrics_stream(stream), folder)
    ten_fifteen = out.where("window_end_ymdhm = '202401011015'")
    assert rows(ten_fifteen, "n", "p90_eta_sec") == [(3, 7)]


def test_exact_percentiles_over_files_with_eviction(spark, folder):
    rng = random.Random(5)
    wait = lambda: rng.choice([None, 0, 3, rng.randrange(1200), -5])
    batches = [
        arrivals(spark, *(
            {**event(f"1{h}:{rng.randrange(60):02d}:00", wait(), rng.choice("AB")), "is_last_train": rng.choice([None, True, False])}
            for _ in range(150)
        )) for h in range(4)
    ]
    args = {"percentile": 0.9, "long_wait_sec": 600}
    stream = metrics_stream(arriving(spark, folder, *batches), delay="61 minutes", **args)
    query = runs.write_files(stream, folder("out"), folder("state"))
    query.awaitTermination()
    whole = batches[0].unionAll(batches[1]).unionAll(batches[2]).unionAll(batches[3])
    batch = metrics.sliding_metrics(metrics.with_event_time(whole), **args)
    end = whole.agg(F.max("event_time")).first()[0]
    closed = batch.where(F.col("window_end_ts") <= F.lit(end) - F.expr("interval 61 minutes"))
    names = ["window_end_ymdhm", "station_name", "n", "p90_eta_sec", "long_ratio_10m", "last_train_seen"]
    out = read_table(spark, folder("out"))
    means = [F.round("avg_eta_sec", 9).alias("mean")]
    assert rows(out.select(*names, *means)) == rows(closed.select(*names, *means)) and not out.isEmpty()
    removed = sum(op.numRowsRemoved for p in query.recentProgress for op in p.stateOperators)
    assert removed > 0 and not any(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def test_late_rows_are_kept_and_their_windows_run_again(spark, folder):
    batches = [
        arrivals(spark, event("10:01:00"), event("10:14:00")),
        arrivals(spark, event("10:05:30", 7), event("11:00:00")),  # late within the delay
        arrivals(spark, event("10:51:00", 2), event("12:00:00")),
        arrivals(spark, event("10:02:00", 9), event("10:03:00", 99, "B"), event("11:51:00", 1), event("13:00:00")),
    ]
    source = arriving(spark, folder, *batches)
    both = late.with_rows(metrics_stream(source), timed_stream(source))
    replace = runs.window_replacer(folder("gold"))
    write = late.splitting(replace, folder("late"), folder("marks"))
    query = runs.for_each_batch(both, write, folder("state"))
    query.awaitTermination()
    missed = late.late_rows(spark, folder("late"), ARRIVAL_SCHEMA)
    assert rows(missed, "event_time", "missed_watermark") == [
        (at("2024-01-01 10:02:00"), at("2024-01-01 11:50:00")),
        (at("2024-01-01 10:03:00"), at("2024-01-01 11:50:00")),
    ]
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == missed.count()
    whole = batches[0].unionAll(batches[1]).unionAll(batches[2]).unionAll(batches[3])
    timed = metrics.with_event_time(whole)
    again = late.rerun_windows(timed, missed)
    batch = metrics.sliding_metrics(timed)
    wanted = ["202401011005", "202401011010", "202401011015"]
    assert rows(again) == rows(batch.where(F.col("window_end_ymdhm").isin(wanted)).select(*again.columns))
    replace(again, -1)
    closed = batch.where(F.col("window_end_ts") <= F.lit(at("2024-01-01 12:50:00")))
    assert rows(read_table(spark, folder("gold"), schema=batch.schema), *KEYS) == rows(closed, *KEYS)


def test_a_batch_run_again_replaces_its_late_rows(spark, folder):
    timed = metrics.with_event_time(arrivals(spark, event("10:01:00"), event("12:00:00")))
    results = metrics.sliding_metrics(timed)
    write = late.splitting(lambda batch, number: None, folder("late"), folder("marks"))
    write(late.with_rows(results, timed), 0)
    for _ in range(2):
        write(late.with_rows(results, timed), 1)
    missed = late.late_rows(spark, folder("late"), ARRIVAL_SCHEMA)
    assert rows(missed, "event_time", "batch") == [(at("2024-01-01 10:01:00"), 1)]
    assert late.late_rows(spark, folder("none"), ARRIVAL_SCHEMA).isEmpty()
    assert late.rerun_windows(timed, missed.where("false")).isEmpty()


def test_latest_versions(spark, folder):
    schema = "id string, version int, t timestamp, note string"
    make = lambda *given: spark.createDataFrame([(i, v, at(f"2024-01-01 {t}"), n) for i, v, t, n in given], schema)
    for batch in (
        make(("a", 2, "10:00:00", "x"), ("b", 1, "10:05:00", "x"), ("c", None, "10:00:00", "z")),
        make(("a", 1, "10:01:00", "older"), ("b", 3, "10:06:00", "x"), ("b", 3, "10:04:00", "y"), (None, 1, "10:07:00", "n")),
        make(("c", 0, "10:09:00", "y"), ("d", 1, "10:59:00", "open")),
        make(("a", 5, "11:05:00", "anew"), ("d", 2, "11:40:00", "open")),
        make(("e", 1, "13:00:00", "open")),
    ):
        batch.coalesce(1).write.mode("append").parquet(folder("in"))
    stream = topics.file_stream(spark, folder("in"), schema, files_per_trigger=1)
    latest = latest_stream(stream, ["id"], ["version"], time="t", quiet="50 minutes")
    out = finished(spark, latest, folder)
    assert rows(out, "id", "version", "note") == rows(make(
        ("a", 2, "10:00:00", "x"), ("a", 5, "10:00:00", "anew"), ("b", 3, "10:00:00", "x"), ("c", 0, "10:00:00", "y"),
        ("d", 2, "10:00:00", "open"), (None, 1, "10:00:00", "n")), "id", "version", "note")


def test_repeats_are_dropped(spark, folder):
    stream = arriving(spark, folder, arrivals(spark, event("10:00:00", 1), event("10:00:00", 2)),
                      arrivals(spark, event("10:01:00", 3), event("10:02:00", 4, "B")))
    out = finished(spark, distinct_stream(stream, ["station_name"], time="event_time"), folder)
    assert rows(out.groupBy("station_name").count()) == [("A", 1), ("B", 1)]


def test_window_replacer_is_idempotent(spark, folder):
    df = metrics.sliding_metrics(
        metrics.with_event_time(arrivals(spark, event("10:00:00"), event("10:01:00", 9, "B")))
    )
    write = runs.window_replacer(folder("gold"))
    write(df, 1)
    write(df, 1)
    stored = read_table(spark, folder("gold"))
    assert rows(stored, "station_name", "n") == rows(df, "station_name", "n")


def test_alerts_from_a_stream(spark, folder):
    stream = arriving(
        spark, folder,
        arrivals(spark, *(event("10:00:30", 700) for _ in range(250)), event("10:10:30", 1)),
        arrivals(spark, event("12:00:00")),
    )
    delivered = []
    writer = runs.alerting(alerts.delay_alerts, lambda found: delivered.extend(found.collect()))
    runs.for_each_batch(metrics_stream(stream), writer, folder("state")).awaitTermination()
    # The slow rows are in three windows; one of them also holds the fast row.
    assert sorted(a.total_n for a in delivered) == [250, 250, 251]


def test_a_replayed_batch_is_not_delivered_twice(spark, folder):
    stream = lambda: metrics_stream(topics.file_stream(spark, folder("in"), ARRIVAL_SCHEMA, files_per_trigger=1))
    arriving(
        spark, folder,
        arrivals(spark, *(event("10:00:30", 700) for _ in range(250)), event("10:10:30", 1)),
        arrivals(spark, event("12:00:00")),
    )
    delivered = []
    alert = runs.alerting(alerts.delay_alerts, lambda found: delivered.extend(found.collect()), ledger=folder("ledger"))

    def crash_after(batch, number):
        alert(batch, number)
        if delivered:
            raise ValueError("the run dies before the stream notes the batch")

    with pytest.raises(Exception, match="dies"):
        runs.for_each_batch(stream(), crash_after, folder("state")).awaitTermination()
    first = list(delivered)
    assert sorted(a.total_n for a in first) == [250, 250, 251]
    runs.for_each_batch(stream(), alert, folder("state")).awaitTermination()
    assert delivered == first  # the batch was run again
    assert len({a.delivery_id for a in first}) == 1


def test_a_crash_during_delivery_sends_the_same_rows_again(spark, folder):
    ledger, sent = runs.Ledger(spark, folder("ledger")), []

    def send(found):
        sent.append(rows(found))
        if len(sent) == 1:
            raise ValueError("half way")

    first = spark.createDataFrame([(1, "a")], "n int, s string")
    with pytest.raises(ValueError):
        ledger.deliver(first, 7, send)
    assert ledger.deliver(spark.createDataFrame([(2, "b")], "n int, s string"), 7, send)
    assert sent == [[(1, "a", "ledger:7")]] * 2
    assert not ledger.deliver(first, 7, send) and len(sent) == 2
    assert not ledger.deliver(first.where("false"), 8, send) and len(sent) == 2


def test_pipeline_events(spark, folder):
    days = spark.createDataFrame([("20240101",), ("20240102",)], "target_ymd string")
    sent = Ms.ready_messages(
        days, project="transit", arrival_path="a/dt={target_ymd}/", position_path="p/{target_ymd}",
        run_id="r1", generated_at=F.lit(at("2024-01-02 03:04:05")),
    )
    assert rows(sent, "key") == [("gold_ready:20240101",), ("gold_ready:20240102",)]
    body = json.loads(sent.where("key = 'gold_ready:20240101'").first().value)
    assert body == {
        "event": "gold_ready", "project": "transit", "target_ymd": "20240101",
        "gold": {"arrival": "a/dt=20240101/", "position": "p/20240101"},
        "generated_at": "2024-01-02T03:04:05.000000Z", "run_id": "r1",
    }
    other = spark.createDataFrame([("x", '{"event":"other","target_ymd":"20240101"}'), ("y", "junk")], "key string, value string")
    Ms.publish_to_folder(sent.unionByName(other), folder("in"))
    stream = topics.file_stream(spark, folder("in"), "key string, value string", format="json")
    out = finished(spark, events.notifications(stream), folder)
    assert rows(out, "target_ymd", "run_id") == [("20240101", "r1"), ("20240102", "r1")]
    assert out.where("target_ymd = '20240101'").first().content == (
        "Tables of 20240101 are complete (run r1).\nArrivals: a/dt=20240101/\nPositions: p/20240101\n"
    )
    stored = read_table(spark, folder("in"), format="json")
    assert events.is_ready(stored, "20240102") and not events.is_ready(stored, "20240103")
    assert events.ready_event(stored, "20240101").first().gold.arrival == "a/dt=20240101/"


def test_envelopes(spark, folder, tmp_path):
    board = {"realtimeArrivalList": [{"statnId": "1", "barvlDt": "60"}, {"statnId": "2", "new": 1}]}
    error = {"errorMessage": {"status": 500, "code": "ERROR-500", "message": "down"}}
    (tmp_path / "docs").mkdir()
    for name, doc in (("a", board), ("b", error), ("c", {"else": 1}), ("d", {"realtimeArrivalList": []})):
        (tmp_path / "docs" / f"{name}.json").write_text(json.dumps(doc, indent=1))
    docs = envelopes.read_documents(spark, folder("docs"))
    got = envelopes.unpack_arrivals(docs)
    assert rows(got.rows, "statnId", "barvlDt", "query_station_name") == [("1", "60", "ALL"), ("2", None, "ALL")]
    assert rows(got.rejects, "reason") == [("500 ERROR-500 down",), ("no arrival list",)]

    pages = spark.createDataFrame(
        [(json.dumps({"CardSubwayStatsNew": p}),) for p in (
            {"list_total_count": 1, "RESULT": {"CODE": "INFO-000"}, "row": [{"USE_YMD": "20240101"}]},
            {"row": [{"USE_YMD": "20240102"}, {"USE_YMD": "20240103"}]},
            {"RESULT": {"CODE": "INFO-200", "MESSAGE": "none"}},
            {"RESULT": {"CODE": "INFO-000"}, "row": []},
        )] + [("[]",)],
        "body string",
    )
    usage = envelopes.unpack_usage(pages)
    assert rows(usage.rows, "USE_YMD") == [("20240101",), ("20240102",), ("20240103",)]
    assert rows(usage.rejects, "reason") == [("INFO-200 none",), ("no usage envelope",)]
    with pytest.raises(RuntimeError, match="rejected"):
        envelopes.failed_envelopes(usage)


def test_a_document_is_parsed_once(spark, folder):
    spark.createDataFrame([("{}",)], "value string").write.text(folder("one"))
    docs = envelopes.read_documents(spark, folder("one"))
    for kind in (envelopes.ARRIVALS, envelopes.USAGE):
        for strict in (False, True):
            found = envelopes.opened(docs, kind, strict=strict)
            assert plan_of(envelopes.rows_of(found, kind)).count("parseJson") == 1
            assert plan_of(found).count("parseJson") == 1
        refused = plan_of(envelopes.rejected(docs, kind))
        assert refused.count("from_json") == 1 and S.USAGE_DAY not in refused  # no items are read


def test_both_parses_refuse_the_same_documents(spark):
    service = lambda **given: json.dumps({"CardSubwayStatsNew": given})
    bodies = [
        None, "", "{", "[]", "7", "null", "{}", '{"CardSubwayStatsNew": null}', '{"CardSubwayStatsNew": 3}',
        service(), service(RESULT=None, row=[{}]), service(RESULT={"CODE": "INFO-200"}, row=[{"USE_YMD": "1"}]),
        service(RESULT={"CODE": "INFO-000"}, row=[]), service(RESULT={"CODE": "INFO-000"}, row=None),
        '{"realtimeArrivalList": null, "errorMessage": {"status": 500, "code": "E"}}',
        '{"realtimeArrivalList": [], "errorMessage": {"code": "E"}}', '{"realtimeArrivalList": [{"a": {"b": [1]}}]}',
    ]
    docs = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "n int, body string")
    for kind in (envelopes.ARRIVALS, envelopes.USAGE):
        both = envelopes.rejects_of(envelopes.opened(docs, kind)), envelopes.rejected(docs, kind)
        wide, narrow = (rows(r, "n", "body", "reason") for r in both)
        assert wide == narrow and len(wide) > 8
    found = envelopes.rows_of(envelopes.opened(docs, envelopes.ARRIVALS), envelopes.ARRIVALS)
    assert rows(found, "n", "other_fields") == [(16, '{"a":{"b":[1]}}')]


def test_documents(spark, folder):
    docs = spark.createDataFrame([("20240101", '{"a":1}')], "target_ymd string, context string")
    for _ in range(2):
        Ms.write_documents(docs, folder("docs"))
    assert rows(spark.read.text(folder("docs")), "value") == [('{"a":1}',)]


def test_state_partitions_follow_the_cores(spark, folder):
    rows_in = spark.createDataFrame([(i % 3, at("2024-01-01 10:00:00")) for i in range(9)], "k int, t timestamp")
    rows_in.write.parquet(folder("in"))
    stream = spark.readStream.schema(rows_in.schema).parquet(folder("in"))
    counts = stream.withWatermark("t", "0 seconds").groupBy("t", "k").count()
    before = spark.conf.get(runs.WIDTH)
    try:
        spark.conf.set(runs.WIDTH, "200")
        assert runs.state_width(spark, per_core=1) == spark.sparkContext.defaultParallelism
        run = runs.write_files(counts, folder("out"), folder("state"), state_partitions=3)
        assert spark.conf.get(runs.WIDTH) == "200"
        run.awaitTermination()
        assert [o["numShufflePartitions"] for o in run.lastProgress["stateOperators"]] == [3]
        spark.conf.set(runs.WIDTH, "2")
        assert runs.state_width(spark) == 2
    finally:
        spark.conf.set(runs.WIDTH, before)
