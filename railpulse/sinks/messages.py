"""Pipeline events and report documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.text import fill_path, message_key, to_message

# Delivery guarantees of the topic sink.
DELIVERY = {"kafka.acks": "all", "kafka.retries": "5", "kafka.linger.ms": "10"}


def ready_messages(
    days: DataFrame,
    *,
    project: str,
    arrival_path: str,
    position_path: str,
    run_id: str | None = None,
    generated_at: Column | None = None,
) -> DataFrame:
    """A keyed JSON message per row of ``target_ymd``, saying its gold tables are ready.

    The path arguments are templates with a ``{target_ymd}`` place.
    """
    day = F.col("target_ymd")
    stamp = generated_at if generated_at is not None else F.current_timestamp()
    body = F.struct(
        F.lit(S.READY_EVENT).alias("event"),
        F.lit(project).alias("project"),
        day.alias("target_ymd"),
        F.struct(
            fill_path(arrival_path, day).alias("arrival"),
            fill_path(position_path, day).alias("position"),
        ).alias("gold"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at"),
        F.lit(run_id).cast("string").alias("run_id"),
    )
    return days.select(*to_message(message_key(F.lit(S.READY_EVENT), day), body))


def publish(
    messages: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> None:
    """Send key and value to a topic. Needs the Kafka connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).options(**{**DELIVERY, **(options or {})}).save()


def publish_to_folder(messages: DataFrame, root: str) -> None:
    """The file twin of :func:`publish`: one JSON line of key and value per message."""
    messages.write.mode("append").json(root)


def write_documents(documents: DataFrame, root: str) -> None:
    """Report documents as text, one folder per ``target_ymd``."""
    documents.select(
        "target_ymd", F.col(next(c for c in documents.columns if c != "target_ymd")).alias("value")
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "target_ymd"
    ).text(root)
