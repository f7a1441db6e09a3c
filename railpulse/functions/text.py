"""Keys, paths and message text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railpulse import settings as S


def message_key(event: Column, day: Column) -> Column:
    """Key under which an event about a day is published, ``<event>:<day>``."""
    return F.concat_ws(":", event, day)


def fill_path(template: str, day: Column) -> Column:
    """A path template with its ``{target_ymd}`` place filled from a column."""
    return F.replace(F.lit(template), F.lit("{target_ymd}"), day)


def path_part(path: Column, name: str) -> Column:
    """Value of ``name=value`` in a partitioned path, null when absent."""
    return F.nullif(
        F.regexp_extract(path, rf"(?:^|/){name}=([^/]+)/", 1), F.lit("")
    )


def padded_path_part(path: Column, name: str, width: int = 2) -> Column:
    """Like :func:`path_part`, zero-padded; raises when the path lacks the part."""
    value = path_part(path, name)
    return F.when(value.isNotNull(), F.lpad(value, width, "0")).otherwise(
        F.raise_error(F.concat(F.lit(f"no {name}= part in path "), path)).cast("string")
    )


def delay_line(top: Column) -> Column:
    """One alert line for a struct of a delayed station; an unknown p90 shows as 0."""
    return F.format_string(
        S.DELAY_LINE_FORMAT,
        top["station_name"],
        top["line_id"].cast("string"),
        top["updn_line"],
        top["n"].cast("string"),
        top["long_ratio_10m"],
        F.coalesce(top["p90_eta_sec"], F.lit(0)).cast("string"),
    )


def ready_text(event: Column) -> Column:
    """Notification text of a ready event."""
    return F.format_string(
        S.READY_TEXT_FORMAT,
        event["target_ymd"],
        event["run_id"],
        event["gold"]["arrival"],
        event["gold"]["position"],
    )


def to_message(key: Column, body: Column) -> list[Column]:
    """The key and value columns of a keyed JSON message."""
    return [key.cast("string").alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value")]


def from_message(value: Column, schema: str = S.EVENT_SCHEMA) -> Column:
    """The struct held by JSON text; a field the text lacks is null."""
    return F.from_json(value.cast("string"), schema)
