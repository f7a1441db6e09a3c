"""Streams of JSON messages: a message topic, or a folder of files standing in for it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railpulse import settings as S
from railpulse.functions.text import from_message


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    group: str | None = None,
    starting: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Key and value text of a topic. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**(options or {}))
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    format: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Files arriving in a folder, as a stream."""
    reader = spark.readStream.format(format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def decode_events(messages: DataFrame, schema: str = S.EVENT_SCHEMA) -> DataFrame:
    """Message values as a struct column ``message`` beside the key."""
    return messages.select("key", from_message(F.col("value"), schema).alias("message"))
