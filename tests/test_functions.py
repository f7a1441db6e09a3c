from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions import columns as C
from railpulse.functions import flags, text, times
from tests.helpers import at, rows


def test_three_time_formats_and_junk(spark):
    df = spark.createDataFrame(
        [
            (1, "2024-01-31 09:08:07"),
            (2, "2024-01-31T09:08:07"),
            (3, "20240131090807"),
            (4, "soon"),
            (5, None),
            (6, ""),
        ],
        "i int, t string",
    )
    got = dict(df.select("i", times.parse_ts(F.col("t"))).collect())
    assert got == {i: at("2024-01-31 09:08:07") for i in (1, 2, 3)} | {4: None, 5: None, 6: None}


def test_days_and_keys(spark):
    df = spark.createDataFrame([("20240229",), ("20240230",), ("x",), (None,)], "d string")
    assert rows(df.select(times.parse_day(F.col("d")))) == [(None,)] * 3 + [(date(2024, 2, 29),)]
    moment = F.lit(at("2024-01-31 23:59:59"))
    shown = spark.range(1).select(
        times.minute_key(moment), times.run_key(moment), times.day_key(moment),
        times.display_time(moment), times.floor_time(moment), times.local_time(moment),
    ).first()
    assert tuple(shown) == (
        "202401312359", "20240131T235959", "20240131", "2024-01-31 23:59:59",
        at("2024-01-31 23:55:00"), at("2024-02-01 08:59:59"),
    )


def test_floor_before_epoch(spark):
    moment = F.lit(at("1969-12-31 23:58:00"))
    assert spark.range(1).select(times.floor_time(moment)).first()[0] == at("1969-12-31 23:55:00")


def test_run_arguments():
    assert times.window_ending_at(at("2024-01-01 10:07:31")) == (
        at("2024-01-01 09:50:00"), at("2024-01-01 10:05:00"),
    )
    assert times.floor_instant(at("2024-01-01 10:05:00")) == at("2024-01-01 10:05:00")
    assert times.day_parts("20240309") == (2024, 3, 9)
    assert times.day_before("20240302", 4) == date(2024, 2, 27)
    assert times.run_day("20240101") == "20240101"
    late = datetime(2024, 1, 4, 20, 0, tzinfo=timezone.utc)
    assert times.run_day(now=late) == "20240105"
    assert times.run_day(now=late, lag_days=4) == "20240101"
    with pytest.raises(ValueError):
        times.run_day("2024")


def test_flags(spark):
    df = spark.createDataFrame([("1",), ("0",), ("2",), (None,)], "f string")
    assert [r[0] for r in df.select(flags.yes_no_unknown(F.col("f"))).collect()] == [
        True, False, None, None,
    ]
    waits = spark.createDataFrame([(299,), (300,), (None,)], "w bigint")
    assert [r[0] for r in waits.select(flags.at_least(F.col("w"), 300)).collect()] == [0, 1, 0]
    codes = spark.createDataFrame([(c,) for c in [*range(7), None]], "c bigint")
    assert [r[0] for r in codes.select(flags.arrival_phase(F.col("c"))).collect()] == [
        "approach", "at_platform", "depart", "approach", "approach", "approach", "other", "other",
    ]


def test_aggregate_helpers(spark):
    df = spark.createDataFrame(
        [("a", 600, True, 1), ("a", None, None, 2), ("b", None, None, 1), ("b", 5, False, 3)],
        "g string, w bigint, f boolean, n bigint",
    )
    got = df.groupBy("g").agg(
        flags.share_at_least(F.col("w"), 600), flags.any_true(F.col("f")),
        flags.weighted_mean(F.col("w"), F.col("n")),
    )
    # A null value is left out of the numerator only.
    assert rows(got) == [("a", 0.5, True, 200.0), ("b", 0.0, False, 3.75)]
    assert df.where("false").agg(flags.weighted_mean(F.col("w"), F.col("n"))).first()[0] is None


def test_resolve_and_require(spark):
    df = spark.createDataFrame([(1, 2)], "use_ymd int, b int")
    assert C.resolve_column(df, ["pasngYmd", "use_ymd"]) == "use_ymd"
    assert C.resolve_column(df, ["x"]) is None
    bound = C.resolve_columns(df, {"day": ["use_ymd"]}, {"code": ["stnCd"]})
    assert bound == {"day": "use_ymd", "code": None}
    with pytest.raises(C.MissingColumnsError) as error:
        C.resolve_columns(df, {"day": ["d"], "total": ["t"], "b": ["b"]})
    assert error.value.missing == ["day", "total"]
    with pytest.raises(C.MissingColumnsError):
        C.require_columns(df, ["b", "c"])
    assert C.select_existing(df, ["z", "b"]).columns == ["b"]


def test_casts_never_throw(spark):
    df = spark.createDataFrame([("7",), ("",), ("x",), ("1.7",), (None,)], "v string")
    got = df.select(*C.mapped_columns(df, [("n", "v", "bigint"), ("absent", "w", "bigint")]))
    assert rows(got) == [(None, None)] * 4 + [(7, None)]
    assert got.dtypes == [("n", "bigint"), ("absent", "bigint")]


def test_conform_and_standardise(spark):
    df = spark.createDataFrame([(1, "x")], "a int, extra string")
    target = spark.createDataFrame([], "a bigint, b string").schema
    assert C.conform(df, target).schema.simpleString() == "struct<a:bigint,b:string>"
    out = C.standardise(df, {"a": "A", "missing": "M"}, {"code": "string", "A": "int"})
    assert out.dtypes == [("A", "int"), ("extra", "string"), ("code", "string")]


def test_stringify_and_all_null(spark):
    df = spark.createDataFrame(
        [(1, (2, "역"), [1, 2], {"k": 1}, None), (2, None, None, None, None)],
        "i int, s struct<a:int,b:string>, l array<int>, m map<string,int>, none string",
    )
    kept = C.drop_all_null_columns(df)
    assert kept.columns == ["i", "s", "l", "m"]
    assert rows(C.stringify(kept)) == [
        ("1", '{"a":2,"b":"역"}', "[1,2]", '{"k":1}'), ("2", None, None, None),
    ]
    assert C.nested_to_json(kept).dtypes == [
        ("i", "int"), ("s", "string"), ("l", "string"), ("m", "string"),
    ]


def test_path_parts(spark):
    df = spark.createDataFrame(
        [("s3a://b/t/year=2025/month=3/day=11/hour=8/part-0.parquet",)], "path string"
    )
    got = df.select(
        text.path_part(F.col("path"), "year"), text.padded_path_part(F.col("path"), "month"),
        text.padded_path_part(F.col("path"), "hour"), text.path_part(F.col("path"), "minute"),
    ).first()
    assert tuple(got) == ("2025", "03", "08", None)
    with pytest.raises(Exception, match="no minute= part"):
        df.select(text.padded_path_part(F.col("path"), "minute")).collect()


def test_message_text(spark):
    body = '{"event":"gold_ready","target_ymd":"20240101","gold":{"arrival":"a/"}}'
    df = spark.createDataFrame([(body,), ("junk",)], "value string")
    got = df.select(text.from_message(F.col("value")).alias("m")).select(
        "m.event", "m.gold.arrival", "m.gold.position", "m.run_id"
    )
    assert rows(got) == [(None,) * 4, ("gold_ready", "a/", None, None)]
    day = F.lit("20240101")
    assert spark.range(1).select(
        text.message_key(F.lit(S.READY_EVENT), day), text.fill_path("x/dt={target_ymd}/", day)
    ).first() == ("gold_ready:20240101", "x/dt=20240101/")
