"""Table writers that can be run again safely."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from railpulse.session import shared_folder
from railpulse.sources.tables import ABSENT, located, partition_predicate, read_table


#: Folders that ``stored`` has written and nobody has released.
_HELD: list[str] = []


def release(spark: SparkSession) -> None:
    """Remove the folders of ``stored``; for when all results built on them are written."""
    folders, _HELD[:] = list(_HELD), []
    _remove_folders(spark, folders)


def _clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a table partition brought together before the write.

    REBALANCE keeps files few: adaptive execution merges small partitions and
    splits a hot one over several tasks, which a plain repartition would not.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    For a result that several branches of a plan read: it is computed once, each
    branch reads just its columns, and a lost executor costs a re-read. The folder stays
    until ``release``, as frames built on it are lazy.
    """
    root = shared_folder(df.sparkSession, label)
    _HELD.append(root)
    df.write.parquet(root)
    return df.sparkSession.read.schema(df.schema).parquet(root)


@contextmanager
def held(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like ``stored`` for the length of a ``with`` block, which removes the folder at its
    end; all that is built on the frame must be written by then."""
    root = shared_folder(df.sparkSession, label)
    try:
        df.write.parquet(root)
        yield df.sparkSession.read.schema(df.schema).parquet(root)
    finally:
        _remove_folders(df.sparkSession, [root])


def append(
    df: DataFrame, root: str, *, partition_by: Sequence[str] = (), format: str = "parquet"
) -> None:
    _clustered(df, partition_by).write.format(format).mode("append").partitionBy(
        *partition_by
    ).save(root)


def overwrite(df: DataFrame, root: str, *, format: str = "parquet") -> None:
    """Replace all of a path."""
    df.write.format(format).mode("overwrite").save(root)


def overwrite_table(
    df: DataFrame, name: str, *, sort_within: Sequence[str] = (), path: str | None = None
) -> None:
    """Replace a catalog table, kept at ``path`` when one is given. ``sort_within``
    orders rows inside files, which sharpens file statistics; a global order would
    not outlive the write."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def overwrite_small(df: DataFrame, root: str, *, files: int = 1) -> None:
    """Replace a path by a few files. Only for results known to be small: a
    rebalance before the merge keeps the computation itself parallel."""
    df.repartition(files).write.mode("overwrite").parquet(root)


def counted(df: DataFrame, name: str = "written") -> tuple[DataFrame, Observation]:
    """The frame with its rows counted by the write that follows, not by a second run."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def replace_partition(
    df: DataFrame,
    root: str,
    values: Mapping[str, object],
    *,
    partition_by: Sequence[str],
    format: str = "parquet",
    skip_empty: bool = False,
) -> int:
    """Make the rows of the partitions with the given values exactly ``df``.

    Returns the number of rows written. A row outside those partitions fails the
    job before anything is committed. Other partitions are untouched, and running
    again gives the same table. An empty frame empties the partitions, or leaves
    them as they are with ``skip_empty``.

    With a transactional format this is one ``replaceWhere`` commit. On Parquet,
    new files of each partition are swapped in when the job commits, then
    partitions the new rows no longer reach are removed; a failure between the two
    steps leaves stale rows, which the next run removes.
    """
    unknown = set(values).difference(partition_by)
    if unknown:
        raise ValueError(f"not partition columns: {sorted(unknown)}")
    spark = df.sparkSession
    if skip_empty and format == "delta":  # replaceWhere would delete: ask first, run once
        df = df.persist()
        if df.isEmpty():
            df.unpersist()
            return 0
    guarded, observation = counted(_only_within(df, partition_predicate(values), root))
    writer = (
        _clustered(guarded, partition_by)
        .write.format(format)
        .mode("overwrite")
        .partitionBy(*partition_by)
    )
    if format == "delta":
        writer.option("replaceWhere", _as_sql(values)).save(root)
        return _observed_rows(observation, spark, root, values, format)

    before = _folders_of(spark, root, values)
    writer.option("partitionOverwriteMode", "dynamic").save(root)
    if skip_empty and not _counter(observation):  # a dynamic overwrite by no rows has replaced nothing
        return 0
    if before:
        after = _folders_of(spark, root, values)
        # A folder that still holds its old file was not reached by the new rows.
        _remove_folders(spark, (f for f, file in before.items() if after.get(f) == file))
    return _observed_rows(observation, spark, root, values, format)


def _observed_rows(
    observation: Observation, spark: SparkSession, root: str, values: Mapping[str, object], format: str
) -> int:
    """Rows counted during the write. A plan found to be empty loses its counter;
    then the (empty) partitions are asked."""
    rows = _counter(observation)
    if rows is None:
        try:
            return read_table(spark, root, format=format, where=values).count()
        except AnalysisException as error:
            if error.getCondition() not in ABSENT:
                raise
            return 0
    return rows


def _counter(observation: Observation) -> int | None:
    try:
        return observation.get["rows"]
    except (Py4JJavaError, KeyError):
        return None


def _only_within(df: DataFrame, predicate: Column, root: str) -> DataFrame:
    return df.where(
        F.when(F.coalesce(predicate, F.lit(False)), F.lit(True)).otherwise(
            F.raise_error(F.lit(f"row outside the partitions being replaced in {root}")).cast(
                "boolean"
            )
        )
    )


def _as_sql(values: Mapping[str, object]) -> str:
    def literal(value: object) -> str:
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return str(value)
        return "'" + str(value).replace("'", "''") + "'"

    return " AND ".join(f"{name} = {literal(value)}" for name, value in values.items())


def _folders_of(spark: SparkSession, root: str, values: Mapping[str, object]) -> dict[str, str]:
    """Folders of the partitions, each with one of its files.

    Listed through the binary-file source, which knows the partition columns and
    opens no file: one row per file, one row per folder on the driver. Only folders under
    the given values are listed where they lead the layout.
    """
    place = located(spark, root, values)
    if place.known and place.folder is None:
        return {}
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    try:
        files = reader.option("basePath", root).load(place.folder or root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    if not set(values).issubset(files.columns):
        return {}
    path = F.col("path")
    folders = (
        files.where(partition_predicate(values))
        .groupBy(F.regexp_replace(path, "/[^/]+$", "").alias("folder"))
        .agg(F.min(path).alias("file"))
    )
    return {row.folder: row.file for row in folders.collect()}


def _remove_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in sorted(folders):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
