import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from railpulse.functions.columns import MissingColumnsError
from railpulse.operators import report as Rp
from tests.helpers import at, plan_of, rows

KPI = (
    "event_date date, line_id bigint, station_id bigint, station_name string, total_events bigint, "
    "avg_wait_sec double, p95_wait_sec bigint, long_wait_ratio_5 double, express_ratio double, "
    "late_night_events bigint, last_train_dt timestamp, last_train_wait_sec double"
)
USAGE = "pasngYmd string, stnNm string, lineNm string, totalNope bigint"
DAY = date(2024, 1, 5)


def kpi(spark, *given):
    def row(name, line=1, wait=10.0, late=0, last=None):
        return (DAY, line, 1, name, 1, wait, int(wait or 0), 0.0, 0.0, late, last and at(last), None)

    return spark.createDataFrame([row(*g) if isinstance(g, tuple) else row(**g) for g in given], KPI)


def usage(spark, *given):
    return spark.createDataFrame([("20240101", *g) for g in given], USAGE)


def brute_force(kpi_rows, usage_rows, k, match):
    """Every pair scored, in plain Python."""
    pairs = [(a, b) for a in kpi_rows for b in usage_rows if match(a, b)]
    top_wait = max((a.avg_wait_sec for a, _ in pairs), default=0)
    top_total = max((b.totalNope for _, b in pairs), default=0)
    scored = [
        ((a.avg_wait_sec / (top_wait + 1e-6)) * (b.totalNope / (top_total + 1e-6)), a, b) for a, b in pairs
    ]
    scored.sort(key=lambda s: (-s[0], -s[1].avg_wait_sec, -s[2].totalNope, s[1].station_name, s[1].line_id))
    return [(a.station_name, a.line_id, b.totalNope, round(s, 9)) for s, a, b in scored[:k]]


def test_pain_score_many_to_many(spark):
    k = kpi(spark, ("A", 1, 100.0), ("A", 2, 50.0), ("B", 1, 80.0), ("only-kpi", 1, 999.0), (None, 1, 500.0))
    u = usage(spark, ("A", "1", 10), ("A", "2", 30), ("B", "1", 60), ("only-usage", "1", 900), (None, "1", 800))
    got = Rp.painful_stations(k, u)
    assert rows(got, "station_name", "line_id", "totalNope") == [
        ("A", 1, 10), ("A", 1, 30), ("A", 2, 10), ("A", 2, 30), ("B", 1, 60),
    ]
    best = got.orderBy(F.col("pain_score").desc()).first()
    # Normalised over matching rows only.
    assert best.station_name == "B" and best.pain_score == pytest.approx(0.8, abs=1e-6)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_pain_score_with_a_hot_station_equals_all_pairs(spark, k):
    waits = spark.range(300).selectExpr(
        "date'2024-01-05' event_date", "id AS line_id", "1L station_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 9) END AS station_name", "1L total_events",
        "cast(abs(hash(id)) % 40 AS double) AS avg_wait_sec", "1L p95_wait_sec", "0D long_wait_ratio_5",
        "0D express_ratio", "0L late_night_events", "cast(null as timestamp) last_train_dt",
        "cast(null as double) last_train_wait_sec",
    )
    totals = spark.range(300).selectExpr(
        "'20240101' pasngYmd", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 11) END AS stnNm",
        "cast(id as string) lineNm", "cast(abs(hash(id, 2)) % 30 AS bigint) AS totalNope",
    )
    got = [
        (r.station_name, r.line_id, r.totalNope, round(r.pain_score, 9))
        for r in Rp.painful_stations(waits, totals, k=k, position="p").orderBy("p").collect()
    ]
    expected = brute_force(
        waits.collect(), totals.collect(), k, lambda a, b: a.station_name == b.stnNm
    )
    assert got == expected


@pytest.mark.parametrize("seed", range(4))
def test_pain_of_mixed_signs_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    low = -20 if seed < 3 else -30
    waits = [(rng.choice("AB"), i, rng.choice([None, float(rng.randint(low, 20 if seed < 3 else -1))])) for i in range(30)]
    totals = [(rng.choice("AB"), str(i), rng.choice([None, rng.randint(-50, 50)])) for i in range(30)]
    got = Rp.painful_stations(kpi(spark, *waits), usage(spark, *totals), k=4).collect()
    pairs = [(w, t) for s, _, w in waits for u, _, t in totals if s == u]
    peak = [max(v for v in side if v is not None) for side in zip(*pairs, strict=True)]
    scores = sorted(
        (w / peak[0] * (t / peak[1]) for w, t in pairs if None not in (w, t)), reverse=True
    )
    assert [r.pain_score for r in got] == pytest.approx(scores[:4])


def test_sections(spark):
    k = kpi(
        spark,
        {"name": "A", "wait": 10.0, "late": 3, "last": "2024-01-05 23:50:00"},
        {"name": "B", "wait": 30.0, "late": 7},
        {"name": "C", "line": None, "wait": 99.0, "late": 1, "last": "2024-01-05 23:59:00"},
    )
    assert rows(Rp.line_wait_stats(k), "line_id", "avg_wait_sec") == [(1, 20.0)]
    assert [r.station_name for r in Rp.last_trains(k).collect()] == ["C", "A"]
    assert Rp.last_trains(k).columns == ["station_name", "line_id", "last_train_time_str", "last_train_wait_sec"]
    assert Rp.last_trains(k).first().last_train_time_str == "2024-01-05 23:59:00"
    assert [r.station_name for r in Rp.late_night_hotspots(k, k=2).collect()] == ["B", "A"]

    u = usage(spark, *((f"s{i:02d}", "1", 5 if i > 8 else 100 - i) for i in range(12)), ("n", None, 1))
    assert [r.station_name for r in Rp.top_stations(u).collect()] == [f"s{i:02d}" for i in range(10)]
    assert rows(Rp.line_usage_stats(u), "line_name", "max_totalNope") == [("1", 100)]
    ranked = u.withColumn("rank", F.lit("7"))
    assert Rp.top_stations(ranked).first().rank_daily == 7
    with pytest.raises(MissingColumnsError):
        Rp.top_stations(u.drop("totalNope"))


def test_context(spark):
    k = Rp.kpi_by_report_day(kpi(spark, ("A", 1, 100.0), ("B", 2, 50.0)))
    u = Rp.usage_by_report_day(
        usage(spark, ("A", "1", 10), ("C", None, 5)).unionAll(
            spark.createDataFrame([("20240102", "A", "1", 9)], USAGE)
        )
    )
    docs = {r.target_ymd: json.loads(r.context) for r in Rp.context_json(Rp.report_context(k, u)).collect()}
    assert sorted(docs) == ["20240105", "20240106"]
    both, usage_only = docs["20240105"], docs["20240106"]
    assert both["usage"]["has_data"] and both["arrival"]["has_data"]
    assert [s["station_name"] for s in both["usage"]["top_stations_by_total"]] == ["A", "C"]
    assert both["usage"]["line_usage_stats"] == [{"line_name": "1", "avg_totalNope": 10.0, "max_totalNope": 10}]
    assert [p["station_name"] for p in both["arrival"]["painful_stations"]] == ["A"]
    assert both["arrival"]["last_train_info"] == []
    assert [h["station_name"] for h in both["arrival"]["late_night_hotspots"]] == ["A", "B"]
    assert usage_only["arrival"] == {"has_data": False}
    assert usage_only["usage"]["has_data"]


def test_context_without_bindable_usage(spark):
    k = Rp.kpi_by_report_day(kpi(spark, ("A", 1, 100.0)))
    u = Rp.usage_by_report_day(usage(spark, ("A", "1", 10))).drop("totalNope")
    doc = json.loads(Rp.context_json(Rp.report_context(k, u)).first().context)
    assert doc["usage"] == {"has_data": False} and doc["arrival"]["has_data"]


def test_pairs_are_pruned_before_the_join(spark):
    plan = plan_of(Rp.painful_stations(kpi(spark, ("A", 1, 1.0)), usage(spark, ("A", "1", 5))))
    assert plan.count("WindowGroupLimit") >= 4
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tables_read_as_they_are_are_not_stored_again(spark, monkeypatch):
    kpi = spark.createDataFrame(
        [("A", 1, 100.0, 100, 0.5), ("B", 1, 300.0, 300, 1.0)],
        "station_name string, line_id long, avg_wait_sec double, p95_wait_sec long, "
        "long_wait_ratio_5 double",
    )
    usage = spark.createDataFrame(
        [("A", "1", 900), ("B", "1", 100), ("B", "2", None)],
        "stnNm string, lineNm string, totalNope long",
    )
    labels, stored = [], Rp.stored
    monkeypatch.setattr(Rp, "stored", lambda df, label: labels.append(label) or stored(df, label))
    again = rows(Rp.painful_stations(kpi, usage))
    assert {"waits", "riders"} <= set(labels)
    labels.clear()
    assert rows(Rp.painful_stations(kpi, usage, kept=True)) == again and len(again) == 3
    assert not {"waits", "riders"} & set(labels)
