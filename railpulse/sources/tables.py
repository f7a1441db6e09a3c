"""Table readers.

A table is read with a predicate on partition columns. Where the predicate names
partitions outright and the table is Parquet, only their folders are listed: a table
that gains a folder every few minutes is too large to list whole for one of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import groupby
from operator import or_
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse.functions.columns import conform
from railpulse.operators.drift import union_drifting
from railpulse.sources.footers import footers

ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def partition_predicate(values: Mapping[str, object]) -> Column:
    """All partition columns equal the given values."""
    predicate = F.lit(True)
    for name, value in values.items():
        predicate = predicate & (F.col(name) == F.lit(value))
    return predicate


class Located(NamedTuple):
    """A partition's folder, or None; ``known`` tells that the layout was followed."""

    folder: str | None
    known: bool


def located(spark: SparkSession, root: str, values: Mapping[str, object]) -> Located:
    """The folder of a partition, ``values`` in the order of the layout.

    Lists one folder per level. A level whose folders name another column means that
    the values do not lead the layout; then nothing is known.
    """
    fs_path, folder = spark._jvm.org.apache.hadoop.fs.Path, root.rstrip("/")
    conf = spark._jsc.hadoopConfiguration()
    if not fs_path(folder).getFileSystem(conf).exists(fs_path(folder)):
        return Located(None, False)
    for name, value in values.items():
        here = fs_path(folder)
        names = [s.getPath().getName() for s in here.getFileSystem(conf).listStatus(here) if s.isDirectory()]
        level = [n.split("=", 1) for n in names if "=" in n]
        if not level or any(column != name for column, _ in level):
            return Located(None, False)
        # A number may have been written with zeros before it.
        fit = [text for _, text in level if text == str(value) or text.isdigit() and int(text) == value]
        if len(fit) != 1:
            return Located(None, not fit)
        folder = f"{folder}/{name}={fit[0]}"
    return Located(folder, True)


def read_table(
    spark: SparkSession,
    root: str,
    *,
    format: str = "parquet",
    where: Column | Mapping[str, object] | Sequence[Mapping[str, object]] | None = None,
    merge_schema: bool = False,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table root, pruned by a predicate, by partition equality or by the equality
    of one of several partitions, of which at least one has to be given."""
    reader = spark.read.format(format).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if where is None or isinstance(where, Column):
        df = reader.load(root)
        return df if where is None else df.where(where)
    choices = [where] if isinstance(where, Mapping) else list(where)
    predicate = reduce(or_, map(partition_predicate, choices))
    if format == "parquet":
        found = [located(spark, root, values) for values in choices]
        if all(f.known for f in found):
            folders = [f.folder for f in found if f.folder]
            if folders:
                return reader.option("basePath", root).load(folders).where(predicate)
            if schema is not None:
                return spark.createDataFrame([], schema)
    return reader.load(root).where(predicate)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_if_present(
    spark: SparkSession, root: str, schema: T.StructType, **read_args
) -> tuple[DataFrame, bool]:
    """The table and True, or an empty frame of the declared schema and False.

    Only a missing path or table, or one without files, counts as absent; any other
    failure is raised.
    """
    try:
        return conform(read_table(spark, root, **read_args), schema), True
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return spark.createDataFrame([], schema), False


def read_drifting_files(
    spark: SparkSession, root: str, *, skip_unreadable: bool = False
) -> DataFrame:
    """Parquet files whose columns differ, united by name.

    A column of several types is read as the widest number type among them, or as text.
    Hidden files (leading ``_`` or ``.``) are passed over by Spark itself.
    ``skip_unreadable`` keeps reading past a damaged file, giving its rows up.
    """
    options = {"ignoreCorruptFiles": str(skip_unreadable).lower()}
    try:
        return read_table(spark, root, merge_schema=True, options=options)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    # Only types that clash get here. Tasks read the footers; the driver gets one path at a
    # time, as it holds the file list of any read, and reads one footer per distinct schema.
    keyed = footers(spark, root, skip_unreadable=skip_unreadable).orderBy("schema_key", "path")

    def reader() -> DataFrameReader:
        return spark.read.options(**options).option("basePath", root)

    frames = []
    for _, files in groupby(keyed.toLocalIterator(), key=lambda row: row.schema_key):
        paths = [file.path for file in files]
        frames.append(reader().schema(reader().parquet(paths[0]).schema).parquet(*paths))
    if not frames:
        raise ValueError(f"no readable Parquet file under {root}")
    return union_drifting(frames)


def rows_to_frame(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """A small driver-side row list, such as one API response, as a frame."""
    return spark.createDataFrame(rows, schema)
