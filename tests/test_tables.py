import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railpulse.operators.drift import is_empty, union_drifting
from railpulse.sinks import tables as K
from railpulse.sinks.compaction import compact
from railpulse.sources import listing, reference
from railpulse.sources import tables as T
from railpulse.sources.footers import footers
from tests.helpers import plan_of, rows

BY = ("day", "hour")


def frame(spark, *given):
    return spark.createDataFrame(list(given), "day int, hour int, v string")


def test_replace_touches_only_its_partitions(spark, folder):
    root = folder("t")
    K.append(frame(spark, (1, 1, "a"), (1, 2, "b"), (2, 1, "c")), root, partition_by=BY)
    for _ in range(2):
        written = K.replace_partition(frame(spark, (1, 1, "new")), root, {"day": 1}, partition_by=BY)
        assert written == 1
        # Hour 2 of day 1 is within the replaced day, so it goes; day 2 stays.
        assert rows(T.read_table(spark, root), "day", "hour", "v") == [(1, 1, "new"), (2, 1, "c")]


def test_replace_creates_the_table(spark, folder):
    K.replace_partition(frame(spark, (1, 1, "a")), folder("new"), {"day": 1}, partition_by=BY)
    assert T.read_table(spark, folder("new")).count() == 1


def test_replace_by_nothing(spark, folder):
    root = folder("t")
    K.append(frame(spark, (1, 1, "a"), (2, 1, "c")), root, partition_by=BY)
    empty = frame(spark, (0, 0, "")).where("false")
    assert K.replace_partition(empty, root, {"day": 1}, partition_by=BY, skip_empty=True) == 0
    assert T.read_table(spark, root).count() == 2
    assert K.replace_partition(empty, root, {"day": 1}, partition_by=BY) == 0
    assert rows(T.read_table(spark, root), "day", "v") == [(2, "c")]


def test_replace_refuses_foreign_rows(spark, folder):
    root = folder("t")
    K.append(frame(spark, (1, 1, "a")), root, partition_by=BY)
    for stray in ((2, 1, "x"), (None, 1, "x")):
        with pytest.raises(Exception, match="outside the partitions"):
            K.replace_partition(frame(spark, (1, 1, "b"), stray), root, {"day": 1}, partition_by=BY)
    assert rows(T.read_table(spark, root), "v") == [("a",)]
    with pytest.raises(ValueError, match="not partition columns"):
        K.replace_partition(frame(spark), root, {"v": "a"}, partition_by=BY)


def test_replace_predicate_text():
    assert K._as_sql({"year": 2024, "key": "a'b"}) == "year = 2024 AND key = 'a''b'"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(1, 3), st.sampled_from("xy")), max_size=8))
def test_replace_twice_is_once(spark, tmp_path_factory, data):
    root = "file://" + str(tmp_path_factory.mktemp("twice")) + "/t"
    K.append(frame(spark, (1, 1, "old"), (2, 2, "old")), root, partition_by=BY)
    new = spark.createDataFrame(data, "day int, hour int, v string").where("day = 1")
    results = []
    for _ in range(2):
        K.replace_partition(new, root, {"day": 1}, partition_by=BY)
        results.append(rows(T.read_table(spark, root), "day", "hour", "v"))
    assert results[0] == results[1]
    assert results[0] == sorted([d for d in data if d[0] == 1] + [(2, 2, "old")])


def test_partition_pruning(spark, folder):
    root = folder("t")
    K.append(frame(spark, (1, 1, "a"), (2, 1, "c")), root, partition_by=BY)
    pruned = T.read_table(spark, root, where={"day": 1, "hour": 1})
    plan = plan_of(pruned)
    assert "PartitionFilters: [isnotnull(day" in plan and rows(pruned, "v") == [("a",)]


def test_read_if_present(spark, folder):
    schema = spark.createDataFrame([], "v string, w bigint").schema
    empty, present = T.read_if_present(spark, folder("absent"), schema)
    assert not present and is_empty(empty) and empty.schema == schema
    K.overwrite(frame(spark, (1, 1, "a")), folder("there"))
    got, present = T.read_if_present(spark, folder("there"), schema)
    assert present and rows(got) == [("a", None)]
    with pytest.raises(Exception, match="nowhere"):
        T.read_if_present(spark, folder("there"), schema, where=F.col("nowhere") == 1)


def test_drifting_files(spark, folder, tmp_path):
    root = folder("drift")
    one, two = spark.range(1).selectExpr("id", "'a' AS x"), spark.range(1).selectExpr("id", "'b' AS y")
    K.append(one, root)
    K.append(two, root)
    (tmp_path / "drift" / "_junk.parquet").write_text("junk")
    assert rows(T.read_drifting_files(spark, root), "id", "x", "y") == [(0, None, "b"), (0, "a", None)]
    assert rows(union_drifting([one, two]), "id", "x", "y") == [(0, None, "b"), (0, "a", None)]
    (tmp_path / "drift" / "part-bad.parquet").write_text("junk")
    with pytest.raises(Exception):
        T.read_drifting_files(spark, root).collect()
    assert T.read_drifting_files(spark, root, skip_unreadable=True).count() == 2


def test_rows_to_frame(spark):
    assert rows(T.rows_to_frame(spark, [("a", None)], "x string, y int")) == [("a", None)]


def test_latest_partition(spark, folder, tmp_path):
    root = folder("t")
    parts = ("year", "month", "day", "hour")
    data = spark.range(4).selectExpr("2024 year", "3 month", "cast(id + 1 as int) day", "5 hour", "id")
    K.append(data, root, partition_by=parts)
    K.append(data.where("day = 2"), root, partition_by=parts)
    log = tmp_path / "t" / "_delta_log"
    log.mkdir()
    (log / "9.checkpoint.parquet").write_text("newest, but not data")
    assert listing.latest_partition(spark, root).first().asDict() == {
        "year": "2024", "month": "03", "day": "02", "hour": "05",
    }
    assert "content" not in plan_of(listing.list_files(spark, root)).split("ReadSchema")[1]
    flat = folder("flat")
    K.overwrite(data, flat)
    with pytest.raises(Exception, match="no year= part"):
        listing.latest_partition(spark, flat).collect()
    (tmp_path / "bare").mkdir()
    assert listing.latest_partition(spark, folder("bare")).isEmpty()


def test_compaction(spark, folder):
    small = folder("small")
    spark.range(1000).repartition(20).write.parquet(small)
    assert compact(spark, small, folder("one")) == 1
    assert listing.list_files(spark, folder("one")).count() == 1
    assert T.read_table(spark, folder("one")).count() == 1000
    assert compact(spark, small, folder("four"), target_bytes=5_000) > 1
    with pytest.raises(ValueError):
        compact(spark, small, small + "/")
    parts = folder("parts")
    spark.range(100).selectExpr("id % 3 AS day", "id").repartition(8).write.partitionBy("day").parquet(parts)
    compact(spark, parts, folder("packed"), partition_by=["day"])
    assert listing.list_files(spark, folder("packed")).count() == 3
    assert rows(T.read_table(spark, folder("packed")).groupBy("day").count()) == [(0, 34), (1, 33), (2, 33)]


def test_release_removes_what_was_stored(spark):
    K.release(spark)
    one = K.stored(spark.range(3), "x")
    assert one.count() == 3
    K.release(spark)
    with pytest.raises(Exception):
        spark.read.parquet(one.inputFiles()[0])


def test_small_overwrite_and_stored(spark, folder):
    for _ in range(2):
        K.overwrite_small(spark.range(10), folder("s"))
    assert listing.list_files(spark, folder("s")).count() == 1
    kept = K.stored(spark.range(3).selectExpr("id", "'x' AS s"), "label")
    assert rows(kept) == [(0, "x"), (1, "x"), (2, "x")]


def test_catalog_table(spark):
    K.overwrite_table(spark.range(3), "numbers", sort_within=("id",))
    K.overwrite_table(spark.range(2), "numbers")
    assert T.read_catalog_table(spark, "numbers").count() == 2
    spark.sql("DROP TABLE numbers")


def test_counted_without_a_second_run(spark, folder):
    df, observed = K.counted(spark.range(7))
    K.overwrite(df, folder("c"))
    assert observed.get["rows"] == 7


def test_station_reference(spark, folder):
    ref = spark.createDataFrame(
        [(1001, 1, "서울역", "1호선"), (1001, 1, "서울", "1호선"), (1002, 2, "시청", "2호선"), (1002, 3, None, "2호선")],
        "SUBWAY_ID int, STATN_ID int, STATN_NM string, `호선이름` string",
    )
    K.overwrite(ref, folder("ref"))
    got = reference.read_station_reference(spark, folder("ref"))
    assert [r[0] for r in reference.station_names(got).collect()] == ["서울", "서울역", "시청"]
    assert [r[0] for r in reference.line_names(got).collect()] == ["1호선", "2호선"]
    dim = reference.station_dimension(got)
    assert rows(dim) == [(1001, 1, "서울", "1호선"), (1002, 2, "시청", "2호선"), (1002, 3, None, "2호선")]
    K.overwrite(ref.drop("STATN_NM"), folder("bad"))
    with pytest.raises(ValueError, match="STATN_NM"):
        reference.read_station_reference(spark, folder("bad"))


def test_only_the_named_partition_is_listed(spark, folder, tmp_path):
    root = folder("t")
    K.append(frame(spark, (1, 1, "a"), (1, 2, "b"), (2, 1, "c")), root, partition_by=BY)
    # A sibling that Spark cannot lay out: listing the root would fail on it.
    (tmp_path / "t" / "other=9" / "x=1").mkdir(parents=True)
    (tmp_path / "t" / "day=2" / "hour=1" / "junk.parquet").write_text("junk")
    for where in ({"day": 1}, {"day": 1, "hour": 2}, [{"day": 1, "hour": 1}, {"day": 1, "hour": 2}]):
        place = T.located(spark, root, where if isinstance(where, dict) else where[0])
        assert not place.known  # the odd folder at the top hides the layout
    clean = folder("u")
    K.append(frame(spark, (1, 1, "a"), (1, 2, "b"), (2, 1, "c")), clean, partition_by=BY)
    (tmp_path / "u" / "day=2" / "hour=1" / "junk.parquet").write_text("junk")
    assert T.located(spark, clean, {"day": 1, "hour": 2}) == (f"{clean}/day=1/hour=2", True)
    assert T.located(spark, clean, {"day": 3}) == (None, True)
    assert T.located(spark, clean, {"hour": 1}) == (None, False)
    one = T.read_table(spark, clean, where={"day": 1})
    assert rows(one, "day", "hour", "v") == [(1, 1, "a"), (1, 2, "b")]
    assert all("/day=1/" in f for f in one.inputFiles())
    two = T.read_table(spark, clean, where=[{"day": 1, "hour": 2}, {"day": 7, "hour": 1}])
    assert len(two.inputFiles()) == 1 and rows(two, "v") == [("b",)]
    assert T.read_table(spark, clean, where={"day": 7}, schema="day int, hour int, v string").isEmpty()
    with pytest.raises(Exception):
        T.read_table(spark, clean, where={"day": 2}).collect()
    K.replace_partition(frame(spark, (1, 2, "z")), clean, {"day": 1, "hour": 2}, partition_by=BY)
    assert rows(T.read_table(spark, clean, where={"day": 1}), "hour", "v") == [(1, "a"), (2, "z")]


def test_columns_of_several_types(spark, folder):
    root = folder("types")
    for made in ("cast(1 as int) a, cast(2 as int) b", "cast(3 as bigint) a, 'x' b", "cast(5 as bigint) a, 'y' b"):
        K.append(spark.range(1).selectExpr(*made.split(", ")), root)
    read = T.read_drifting_files(spark, root)
    assert read.dtypes == [("a", "bigint"), ("b", "string")]
    assert rows(read, "a", "b") == [(1, "2"), (3, "x"), (5, "y")]
    mixed = union_drifting([spark.range(1).selectExpr("1.5D a"), spark.range(1).selectExpr("2 a"), spark.range(1).selectExpr("null b")])
    assert rows(mixed, "a") == [(None,), (1.5,), (2.0,)]


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_compaction_to_size(spark, folder, tmp_path, partition_by):
    big = spark.range(200_000).selectExpr("id", "uuid() AS u", "CASE WHEN id % 10 = 0 THEN 1 ELSE 0 END AS p")
    source, target = folder("in"), folder("out")
    big.repartition(2).write.partitionBy(*partition_by).parquet(source)
    written = compact(spark, source, target, partition_by=partition_by, target_bytes=1_000_000)
    sizes = [f.stat().st_size for f in (tmp_path / "out").rglob("*.parquet")]
    assert written == len(sizes) > 6
    assert max(sizes) < 2_500_000
    assert spark.read.parquet(target).count() == 200_000
    if partition_by:
        with pytest.raises(ValueError, match="partitioned"):
            compact(spark, source, folder("lost"))


def test_many_clashing_files(spark, folder, tmp_path):
    root = folder("many")
    spark.range(0, 300, 1, 60).selectExpr("cast(id as int) v", "id % 3 p").write.partitionBy("p").parquet(root)
    spark.range(300, 500, 1, 40).selectExpr("concat('t', id) v", "id % 3 p").write.partitionBy("p").mode("append").parquet(root)
    keys = footers(spark, root)
    files = len(list((tmp_path / "many").rglob("*.parquet")))
    assert keys.count() == files and keys.select("schema_key").distinct().count() == 2
    read = T.read_drifting_files(spark, root)
    # One read per schema, not per file.
    assert plan_of(read).count("FileScan parquet") == 2
    assert dict(read.dtypes) == {"v": "string", "p": "int"}
    expected = [(f"t{i}" if i >= 300 else str(i), i % 3) for i in range(500)]
    assert rows(read, "v", "p") == sorted(expected)
    (tmp_path / "many" / "p=0" / "part-bad.parquet").write_text("junk")
    with pytest.raises(Exception, match="no Parquet footer in .*part-bad"):
        footers(spark, root).collect()
    assert T.read_drifting_files(spark, root, skip_unreadable=True).count() == 500


def test_footers_by_another_opener(spark, folder, tmp_path):
    root = folder("own")
    spark.range(3).write.parquet(root)
    (tmp_path / "none").mkdir()
    assert footers(spark, folder("none")).isEmpty()
    asked = footers(spark, root, opener=lambda path: open(path.removeprefix("file:").replace("//", ""), "rb"))
    assert rows(asked) == rows(footers(spark, root))


def test_new_partitions_come_once(spark, folder, tmp_path):
    root, checkpoint, parts = folder("t"), folder("seen"), ("day", "hour")
    (tmp_path / "t").mkdir()
    found = []

    def run(process=None):
        found.clear()
        keep = lambda df, number: found.extend((r.day, r.hour, r.files, number) for r in df.collect())
        listing.each_new_partition(spark, root, checkpoint, process or keep, parts).awaitTermination()
        return sorted(found)

    assert run() == []
    K.append(frame(spark, (1, 1, "a"), (1, 2, "b")).coalesce(1), root, partition_by=BY)
    assert run() == [("01", "01", 1, 0), ("01", "02", 1, 0)]
    assert run() == []
    K.append(frame(spark, (1, 1, "again")).coalesce(1), root, partition_by=BY)

    def crash(df, number):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(crash)
    # What was not processed is handed over again, under the same number.
    assert run() == [("01", "01", 1, 1)]
    assert run() == []


def test_highest_partition(spark, folder, tmp_path):
    root, parts = folder("t"), ("day", "hour")
    assert listing.highest_partition(spark, root, parts) is None
    K.append(frame(spark, (9, 23, "a"), (10, 2, "b"), (10, 11, "c")), root, partition_by=BY)
    assert listing.highest_partition(spark, root, parts) == {"day": "10", "hour": "11"}
    (tmp_path / "t" / "day=11").mkdir()
    (tmp_path / "t" / "day=10" / "hour=12").mkdir()
    (tmp_path / "t" / "day=10" / "hour=12" / "_SUCCESS").write_text("")
    assert listing.highest_partition(spark, root, parts) == {"day": "10", "hour": "11"}
    K.append(frame(spark, (1, 1, "rewritten")), root, partition_by=BY)
    assert listing.highest_partition(spark, root, parts) == {"day": "10", "hour": "11"}
