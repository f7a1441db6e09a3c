"""Many small files into few."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.sources.listing import list_files
from railpulse.sources.tables import read_table

#: Columns of the binary-file source; what else it has are partition columns.
FILE_COLUMNS = ("path", "modificationTime", "length", "content")
TARGET_BYTES = 512 * 1024 * 1024


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Rewrite a Parquet folder into files of about ``target_bytes`` in a new folder.

    Returns the number of files written. Rows are dealt out evenly over as many files as
    the bytes of the folder, or of each partition, need; so a hot partition is written by
    several tasks. A partitioned folder has to be given its partition columns.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compaction needs a target folder other than its source")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(source)
    inside = [c for c in files.columns if c not in FILE_COLUMNS]
    if set(inside) != set(partition_by):
        raise ValueError(f"the source is partitioned by {inside}")
    count = F.greatest(F.lit(1), F.ceil(F.sum("length") / target_bytes)).cast("int")
    aims = files.groupBy(*partition_by).agg(count.alias("_files"))
    rows = read_table(spark, source)
    total = aims.agg(F.sum("_files")).first()[0] or 1
    if partition_by:
        keys = list(partition_by)
        place = F.pmod(F.xxhash64(*rows.columns), F.col("_files"))
        dealt = (
            rows.join(aims.withColumnsRenamed({k: f"_{k}" for k in keys}), _same(rows, keys))
            .repartitionByRange(total, *keys, place)
            .select(*rows.columns)
        )
        dealt.write.mode("overwrite").partitionBy(*keys).parquet(target)
    else:
        rows.repartition(total).write.mode("overwrite").parquet(target)
    return list_files(spark, target).count()


def _same(rows: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, (rows[k].eqNullSafe(F.col(f"_{k}")) for k in keys))
