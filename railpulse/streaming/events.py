"""Pipeline events: filtering, notification rows and readiness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.text import ready_text
from railpulse.sources.topics import decode_events


def events_of_type(messages: DataFrame, event: str = S.READY_EVENT) -> DataFrame:
    """Decoded messages of one event type, from a batch or stream of key and value."""
    return decode_events(messages).where(F.col("message.event") == event)


def notifications(messages: DataFrame, event: str = S.READY_EVENT) -> DataFrame:
    """A notification row per event of the type, for a sink the caller chooses."""
    message = F.col("message")
    return events_of_type(messages, event).select(
        "key",
        message["target_ymd"].alias("target_ymd"),
        message["run_id"].alias("run_id"),
        ready_text(message).alias("content"),
    )


def ready_event(messages: DataFrame, day: str, event: str = S.READY_EVENT) -> DataFrame:
    """At most one row: an event of the type about the day. A scheduler polls this
    query instead of blocking on a consumer."""
    return (
        events_of_type(messages, event)
        .where(F.col("message.target_ymd") == day)
        .select("key", "message.*")
        .limit(1)
    )


def is_ready(messages: DataFrame, day: str) -> bool:
    return not ready_event(messages, day).isEmpty()
