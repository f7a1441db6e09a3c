"""Which schema each Parquet file has, read from the footers in tasks."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from railpulse.sources.listing import list_files

#: Key under which Spark files its own schema in a footer; a fixed name.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

Opener = Callable[[str], BinaryIO]

# Tasks get these functions with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_by_scheme(path: str) -> BinaryIO:
    """A seekable file by its URI, through Arrow's file systems."""
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    if not mark and path.startswith("file:"):  # Spark writes local files as file:/a
        scheme, rest = "file", path.removeprefix("file:")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    if scheme in ("s3a", "s3n"):
        scheme = "s3"
    system, place = fs.FileSystem.from_uri(f"{scheme}://{rest}")
    return system.open_input_file(place)


def footer_key(file: BinaryIO) -> str:
    """A digest of the schema; equal for files that any reader types alike.

    Only the footer is read, by seeking to the file's end.
    """
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(file).metadata
    shape = meta.schema
    columns = [
        (c.path, c.physical_type, str(c.logical_type), c.max_definition_level, c.max_repetition_level)
        for c in map(shape.column, range(len(shape)))
    ]
    own = (meta.metadata or {}).get(SPARK_SCHEMA, b"")
    return hashlib.md5(repr(columns).encode() + own).hexdigest()


def footers(
    spark: SparkSession, root: str, *, skip_unreadable: bool = False, opener: Opener = open_by_scheme
) -> DataFrame:
    """One row per Parquet file under a root: path, schema_key.

    Footers are read where the files' tasks run. A damaged file fails the job, or with
    ``skip_unreadable`` has no row. ``opener`` gives a seekable file for a path, for
    stores that Arrow does not know. An empty root has no rows.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, str]] = []
            for path in batch.column(0).to_pylist():
                with opener(path) as file:
                    try:
                        found.append((path, footer_key(file)))
                    except pa.ArrowInvalid as error:
                        if not skip_unreadable:
                            raise ValueError(f"no Parquet footer in {path}") from error
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in found], pa.string()) for i in range(2)],
                names=["path", "schema_key"],
            )

    return list_files(spark, root).select("path").mapInArrow(keyed, "path string, schema_key string")
