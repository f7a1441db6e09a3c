"""Which files exist, and which partition was written last."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from railpulse import settings as S
from railpulse.functions.text import padded_path_part
from railpulse.streaming.runs import for_each_batch

#: Columns of the binary-file source, which a stream has to be told; fixed names.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per data file: path, modified_at, bytes.

    The binary-file source lists in parallel and, with its content column pruned,
    opens no file, so the cost follows the number of files, not of rows.
    Folders starting with ``_``, such as a table log, are not entered.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return _described(reader.option("pathGlobFilter", pattern).load(root))


def _described(files: DataFrame) -> DataFrame:
    return files.select(
        "path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes")
    )


def with_path_parts(files: DataFrame, parts: Sequence[str] = S.ARRIVAL_PARTITION) -> DataFrame:
    """Add partition values read off the path as zero-padded text; a path that
    lacks one fails the job."""
    return files.withColumns(
        {
            name: padded_path_part(F.col("path"), name, 4 if name == "year" else 2)
            for name in parts
        }
    )


def latest_partition(
    spark: SparkSession, root: str, parts: Sequence[str] = S.ARRIVAL_PARTITION
) -> DataFrame:
    """One row: the partition values of the newest file, the path deciding ties.

    An empty root gives no row.
    """
    newest = list_files(spark, root).agg(
        F.max(F.struct("modified_at", "path")).alias("newest")
    )
    path = newest.where("newest is not null").select(F.col("newest.path").alias("path"))
    return with_path_parts(path, parts).drop("path")


def highest_partition(
    spark: SparkSession, root: str, parts: Sequence[str] = S.ARRIVAL_PARTITION
) -> dict[str, str] | None:
    """Values of the partition that is last in order, None under an empty root.

    One folder is listed per level, whatever the table's size. Numbers go by value, other
    text by code point. A folder that holds no data file is passed over, as a failed
    write may leave one. For a table filed by time this is its newest hour, however often
    an old one is written again; :func:`latest_partition` goes by the time of writing.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(fs_path(root)):
        return None

    def below(folder: str, left: Sequence[str]) -> dict[str, str] | None:
        entries = [(e.isDirectory(), e.getPath().getName()) for e in files.listStatus(fs_path(folder))]
        if not left:
            return {} if any(not d and n[0] not in "_." for d, n in entries) else None
        name = left[0]
        values = [n.split("=", 1)[1] for d, n in entries if d and n.startswith(f"{name}=")]
        values.sort(key=lambda v: (v.isdigit(), int(v) if v.isdigit() else 0, v), reverse=True)
        for value in values:
            found = below(f"{folder}/{name}={value}", left[1:])
            if found is not None:
                return {name: value, **found}
        return None

    return below(root.rstrip("/"), tuple(parts))


def each_new_partition(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    process: Callable[[DataFrame, int], None],
    parts: Sequence[str] = S.ARRIVAL_PARTITION,
    *,
    pattern: str = "*.parquet",
    files_per_trigger: int | None = None,
    max_file_age: str = "36500d",
) -> StreamingQuery:
    """Hand over the partitions that gained files since the last run, then end.

    ``process`` gets one row per such partition (its values, files, modified_at of the
    newest) and a number that stays the same if the batch is run again after a crash; a
    batch counts as done when ``process`` returns. Without new files it is not called.
    A file counts once, by its path, so a partition written again with new files comes
    again. ``checkpoint`` remembers the files; files older than ``max_file_age`` before
    the newest one seen are neither remembered nor taken, which bounds it. No file is opened.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("maxFileAge", max_file_age)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def handle(batch: DataFrame, number: int) -> None:
        gained = (
            with_path_parts(batch, parts)
            .groupBy(*parts)
            .agg(F.count(F.lit(1)).alias("files"), F.max("modified_at").alias("modified_at"))
        )
        if not batch.isEmpty():
            process(gained, number)

    return for_each_batch(_described(reader.load(root)), handle, checkpoint)
