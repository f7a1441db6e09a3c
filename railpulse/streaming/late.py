"""Rows that come after their windows have closed, and the windows to be run again.

A stateful aggregation drops such rows silently. Here the stream that computes the windows
also carries its rows along, in one query, so both see the same batches. The watermark of
a batch is the highest event time of the batches before it less the delay; it is kept,
batch by batch, beside the late rows, and each batch's rows are compared with it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.operators.metrics import sliding_metrics, windows_over
from railpulse.sources.tables import ABSENT
from railpulse.streaming.runs import BatchWriter, replace_folder

_MARK = "mark timestamp"


def with_rows(results: DataFrame, timed: DataFrame) -> DataFrame:
    """Results of a stream and the rows they come from as one stream (``result``, ``row``).
    ``timed`` is the frame the results are built on."""
    result, row = F.struct(*results.columns), F.struct(*timed.columns)
    empty_row = F.lit(None).cast(timed.select(row.alias("x")).schema["x"].dataType)
    empty_result = F.lit(None).cast(results.select(result.alias("x")).schema["x"].dataType)
    return results.select(result.alias("result"), empty_row.alias("row")).unionAll(
        timed.select(empty_result.alias("result"), row.alias("row"))
    )


def splitting(
    write: BatchWriter,
    late_root: str,
    marks_root: str,
    *,
    delay: str = "10 minutes",
    pane_minutes: int | None = None,
    event_time: str = "event_ts",
) -> BatchWriter:
    """A batch writer for :func:`with_rows`: results go to ``write``, late rows to a table.

    A row is late if its pane ended at or before the batch's watermark, which is when the
    aggregation drops it. Late rows are kept whole with the watermark they missed, in a
    partition of their batch; a batch that is run again replaces its own partition and
    mark. ``pane_minutes`` is the pane of the results, by default that of the metrics.
    """
    pane = pane_minutes or math.gcd(S.WINDOW_MINUTES, S.SLIDE_MINUTES)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = _mark(spark, marks_root, batch_id - 1)
            rows = kept.where("row is not null").select("row.*")
            if before is not None:
                ends = F.window(event_time, f"{pane} minutes")["end"]
                passed = F.lit(before) - F.expr(f"interval {delay}")
                late = rows.where(ends <= passed).withColumn("missed_watermark", passed)
                replace_folder(late, f"{late_root}/batch={batch_id}")
            write(kept.where("result is not null").select("result.*"), batch_id)
            highest = rows.agg(F.greatest(F.max(event_time), F.lit(before)).alias("mark"))
            replace_folder(highest, f"{marks_root}/batch={batch_id}")
        finally:
            kept.unpersist()

    return run


def _mark(spark: SparkSession, root: str, batch_id: int):
    """The highest event time up to a batch."""
    if batch_id < 0:
        return None
    return spark.read.schema(_MARK).parquet(f"{root}/batch={batch_id}").first().mark


def late_rows(spark: SparkSession, late_root: str, schema: str) -> DataFrame:
    """All late rows so far, with ``missed_watermark`` and ``batch``; none without any."""
    try:
        return spark.read.parquet(late_root)
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return spark.createDataFrame([], f"{schema}, missed_watermark timestamp, batch int")


def rerun_windows(
    rows: DataFrame,
    late: DataFrame,
    *,
    minutes: int = S.WINDOW_MINUTES,
    slide: int = S.SLIDE_MINUTES,
    keys: Sequence[str] = S.METRIC_KEYS,
    event_time: str = "event_ts",
    **metric_args,
) -> DataFrame:
    """Metrics, from all ``rows``, of every group of every window that a late row belongs to.

    ``rows`` has ``event_ts``. Only rows in the panes of those windows are aggregated: the
    panes are joined with the rows' own, and a small list of them is sent to the tasks.
    """
    pane = math.gcd(minutes, slide)

    def pane_of(column: str):
        return F.window(column, f"{pane} minutes")["start"]

    ends = windows_over(
        late.select(pane_of(event_time).alias("_pane")).distinct(), minutes, slide
    ).distinct()
    steps = F.expr(f"sequence(window_end_ts - interval {minutes} minutes, "
                   f"window_end_ts - interval {pane} minutes, interval {pane} minutes)")  # fmt: skip
    panes = ends.select(F.explode(steps).alias("_in_pane")).distinct()
    touched = rows.where(F.col("event_ts").isNotNull()).withColumn("_in_pane", pane_of("event_ts"))
    touched = touched.join(panes, "_in_pane", "left_semi").drop("_in_pane")
    metrics = sliding_metrics(touched, minutes=minutes, slide=slide, keys=keys, **metric_args)
    return metrics.join(ends, "window_end_ts", "left_semi").select(*metrics.columns)
