"""Starting streams and writing their batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from railpulse import settings as S
from railpulse.sinks.messages import DELIVERY

BatchWriter = Callable[[DataFrame, int], None]


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


WIDTH = "spark.sql.shuffle.partitions"


def state_width(spark: SparkSession, per_core: int = 8) -> int:
    """State partitions for the cores at hand, at most the session's shuffle width.

    Adaptive execution cannot merge state partitions. Each costs a task and files in every
    batch and for every stateful operator, with rows or without; so a few to a core do.
    """
    return min(int(spark.conf.get(WIDTH)), per_core * spark.sparkContext.defaultParallelism)


@contextmanager
def _state_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """A stream started inside is given that many; it copies the session's settings."""
    if number is None:
        yield
        return
    before = spark.conf.get(WIDTH)
    spark.conf.set(WIDTH, str(number))
    try:
        yield
    finally:
        spark.conf.set(WIDTH, before)


def write_files(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append to Parquet, each row once even over restarts.

    ``every`` is a trigger interval; without it the run takes what is there and ends.
    ``state_partitions`` is for the first start, by default the session's shuffle width; the
    checkpoint keeps the number.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _state_partitions(stream.sparkSession, state_partitions):
        return writer.start(root)


def for_each_batch(
    stream: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    *,
    mode: str = "append",
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Hand each batch to ``write``; the other options are those of :func:`write_files`."""
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .foreachBatch(write)
    )
    with _state_partitions(stream.sparkSession, state_partitions):
        return writer.start()


def window_replacer(
    root: str, partition_by: Sequence[str] = S.METRIC_PARTITION
) -> BatchWriter:
    """A batch writer that replaces the partitions of the windows it receives.

    Append mode hands over a window's groups together, so a batch that is run
    again rewrites the same partitions with the same rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.hint("rebalance", *partition_by).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*partition_by).parquet(root)

    return write


def in_turn(*writers: BatchWriter) -> BatchWriter:
    """A batch writer that hands each batch to several.

    The batch is computed once, whole, and kept meanwhile: each writer would otherwise run
    the stream's stateful operators again, and a writer that reads no row of a replayed
    batch would leave the state of that batch uncommitted.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kept.count()
            for writer in writers:
                writer(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def replace_folder(rows: DataFrame, path: str) -> None:
    """Rows as the whole content of a folder; no folder of files without rows."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


class Ledger:
    """Which batches have been delivered, over restarts: a folder for each under ``root``,
    with the rows that were delivered.

    A batch's rows are written before they are delivered, and its entry is closed after.
    A replay of a closed batch delivers nothing. A crash between the two leaves the entry
    open: the replay then delivers the rows first written, under the same ``delivery_id``,
    so that a receiver can tell a repeat.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root

    def _path(self, batch_id: int, part: str) -> str:
        return f"{self._root}/batch={batch_id}/{part}"

    def _written(self, batch_id: int, part: str) -> bool:
        jvm, conf = self._spark._jvm, self._spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self._path(batch_id, part)}/_SUCCESS")
        return path.getFileSystem(conf).exists(path)

    def deliver(self, rows: DataFrame, batch_id: int, send: Callable[[DataFrame], None]) -> bool:
        """Send the rows, if any, unless the batch is closed; whether they were sent."""
        if self._written(batch_id, "closed"):
            return False
        if not self._written(batch_id, "rows"):
            replace_folder(
                rows.withColumn("delivery_id", F.lit(f"{self._root.rsplit('/', 1)[-1]}:{batch_id}")),
                self._path(batch_id, "rows"),
            )
        kept = self._spark.read.parquet(self._path(batch_id, "rows"))
        some = not kept.isEmpty()
        if some:
            send(kept)
        replace_folder(self._spark.range(1), self._path(batch_id, "closed"))
        return some


def alerting(
    judge: Callable[[DataFrame], DataFrame],
    deliver: Callable[[DataFrame], None],
    *,
    ledger: str | None = None,
) -> BatchWriter:
    """A batch writer that hands the alert rows of a batch, if any, to ``deliver``.

    With a ``ledger`` folder a batch that is run again after a crash is not delivered
    again; see :class:`Ledger`. Keep it beside the stream's checkpoint: batch ids are the
    checkpoint's.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if ledger is not None:
            Ledger(batch.sparkSession, ledger).deliver(judge(batch), batch_id, deliver)
            return
        alerts = judge(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not alerts.isEmpty():
                deliver(alerts)
        finally:
            alerts.unpersist()

    return in_turn(write)


def publish_stream(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Send a stream of key and value to a topic. Needs the Kafka connector."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**DELIVERY)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )
