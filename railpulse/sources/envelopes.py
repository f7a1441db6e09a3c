"""Landed JSON envelopes to rows.

All take one JSON document per row and parse it once, into a variant. An envelope that
reports an error, or is not one, does not stop the batch: it goes to a reject frame with
its reason. Where a run must stop, a strict frame fails the job that writes it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse import settings as S

ARRIVAL_FIELDS = (
    S.RECEPTION_TIME,
    *(source for _, source, _ in S.ARRIVAL_MAPPING),
    S.LAST_TRAIN_FLAG,
)
USAGE_FIELDS = (
    S.USAGE_DAY,
    S.USAGE_LINE,
    S.USAGE_STATION,
    S.USAGE_BOARDED,
    S.USAGE_ALIGHTED,
    S.USAGE_VERSION,
)


class Unpacked(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


#: JSON text of the fields of an item that have no column of their own; null without any.
OTHER_FIELDS = "other_fields"
_REFUSED = "envelope rejected: "


class Envelope(NamedTuple):
    """Where a kind of document keeps its items, which of their fields have columns, and
    why a document is refused (null if it is not), told from the document as a variant
    and, for a parse of that part alone, from a struct of a narrow schema."""

    items: str
    fields: tuple[str, ...]
    reason: Callable[[Column], Column]
    narrow_schema: str
    narrow_reason: Callable[[Column], Column]


def _text(variant: Column, path: str) -> Column:
    return F.try_variant_get(variant, path, "string")


def _board_reason(has_list: Column, has_error: Column, parts: Sequence[Column]) -> Column:
    return F.when(
        ~F.coalesce(has_list, F.lit(False)),
        F.when(has_error, F.concat_ws(" ", *parts)).otherwise("no arrival list"),
    )


def _page_reason(has_service: Column, code: Column, message: Column) -> Column:
    return F.when(~has_service, F.lit("no usage envelope")).when(
        code.isNotNull() & (code != S.USAGE_OK_CODE), F.concat_ws(" ", code, message)
    )


def _is_object(variant: Column, path: str) -> Column:
    """Whether there is an object; a struct without fields takes nothing out of it."""
    return F.try_variant_get(variant, path, "struct<>").isNotNull()


_ERROR, _SERVICE = f"$.{S.ARRIVAL_ERROR_FIELD}", f"$.{S.USAGE_SERVICE_FIELD}"

ARRIVALS = Envelope(
    items=f"$.{S.ARRIVAL_LIST_FIELD}",
    fields=ARRIVAL_FIELDS,
    reason=lambda doc: _board_reason(
        F.try_variant_get(doc, f"$.{S.ARRIVAL_LIST_FIELD}", "array<variant>").isNotNull(),
        _is_object(doc, _ERROR),
        [_text(doc, f"{_ERROR}.{name}") for name in ("status", "code", "message")],
    ),
    narrow_schema=(
        # An empty struct for the items: their fields are passed over, not read.
        f"{S.ARRIVAL_LIST_FIELD} array<struct<>>, "
        f"{S.ARRIVAL_ERROR_FIELD} struct<status: string, code: string, message: string>"
    ),
    narrow_reason=lambda doc: _board_reason(
        doc[S.ARRIVAL_LIST_FIELD].isNotNull(),
        doc[S.ARRIVAL_ERROR_FIELD].isNotNull(),
        [doc[S.ARRIVAL_ERROR_FIELD][name] for name in ("status", "code", "message")],
    ),
)
USAGE = Envelope(
    items=f"{_SERVICE}.row",
    fields=USAGE_FIELDS,
    reason=lambda doc: _page_reason(
        _is_object(doc, _SERVICE),
        _text(doc, f"{_SERVICE}.RESULT.CODE"),
        _text(doc, f"{_SERVICE}.RESULT.MESSAGE"),
    ),
    narrow_schema=f"{S.USAGE_SERVICE_FIELD} struct<RESULT: struct<CODE: string, MESSAGE: string>>",
    narrow_reason=lambda doc: _page_reason(
        doc[S.USAGE_SERVICE_FIELD].isNotNull(),
        doc[S.USAGE_SERVICE_FIELD]["RESULT"]["CODE"],
        doc[S.USAGE_SERVICE_FIELD]["RESULT"]["MESSAGE"],
    ),
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed files, one JSON document each, as column ``body``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")


def opened(
    documents: DataFrame, kind: Envelope, *, body: str = "body", strict: bool = False
) -> DataFrame:
    """Items and refused documents in one frame, from one parse of each document.

    A document becomes a variant once. An accepted one gives a row for each of its items
    (``item``, a variant that keeps every field with its type); a refused one gives one row
    with ``reason`` and its text in ``body``. With ``strict`` a refused document fails the
    job that reads the frame. Columns beside the body are kept on all rows.
    """
    keep = [c for c in documents.columns if c != body]
    parsed = documents.select(
        *keep, F.col(body).alias("body"), F.try_parse_json(F.col(body)).alias("doc")
    )
    told = parsed.select(
        *keep, "body", "doc", F.coalesce(kind.reason(F.col("doc")), F.lit("")).alias("reason")
    )
    accepted = F.when(
        F.col("reason") == "", F.try_variant_get("doc", kind.items, "array<variant>")
    )
    if strict:
        accepted = accepted.otherwise(
            F.raise_error(F.concat(F.lit(_REFUSED), "reason")).cast("array<variant>")
        )
    # The outer form gives refused documents their row. An inner one would also make Spark
    # filter on the items below the parse, which repeats it.
    return told.select(
        *keep,
        F.explode_outer(accepted).alias("item"),
        F.nullif("reason", F.lit("")).alias("reason"),
        F.when(F.col("reason") != "", F.col("body")).alias("body"),
    )


def _text_columns(kind: Envelope) -> list[Column]:
    """The fields of ``item``, a map of variants, as text."""
    item = F.col("item")
    others = F.map_filter(item, lambda name, _: ~name.isin(*kind.fields))
    more = F.size(F.array_except(F.map_keys(item), F.array(*map(F.lit, kind.fields)))) > 0
    return [
        *(item[name].try_cast("string").alias(name) for name in kind.fields),
        F.when(more, F.to_json(others, {"ignoreNullFields": "false"})).alias(OTHER_FIELDS),
    ]


def _fields_of_item() -> Column:
    return F.try_variant_get("item", "$", "map<string, variant>").alias("item")


def rows_of(found: DataFrame, kind: Envelope) -> DataFrame:
    """The accepted items of ``opened`` as text columns; fields without a column, nulls
    included, stay together in ``other_fields``."""
    keep = [c for c in found.columns if c not in ("item", "reason", "body")]
    items = found.where("item is not null").select(*keep, _fields_of_item())
    return items.select(*keep, *_text_columns(kind))


def as_text(found: DataFrame, kind: Envelope) -> DataFrame:
    """``opened`` with the columns of :func:`rows_of` as a struct in place of each variant:
    smaller to store than variants, which repeat their field names, and read back as it is."""
    keep = [c for c in found.columns if c != "item"]
    there = F.col("item").isNotNull().alias("_there")
    return found.select(*keep, there, _fields_of_item()).select(
        *keep, F.when(F.col("_there"), F.struct(*_text_columns(kind))).alias("item")
    )


def text_rows(found: DataFrame) -> DataFrame:
    """The accepted items of :func:`as_text`, column by column."""
    keep = [c for c in found.columns if c not in ("item", "reason", "body")]
    return found.where("item is not null").select(*keep, "item.*")


def rejects_of(found: DataFrame) -> DataFrame:
    """The refused documents of ``opened``: kept columns, body, reason."""
    keep = [c for c in found.columns if c not in ("item", "reason", "body")]
    return found.where("reason is not null").select(*keep, "body", "reason")


def rejected(documents: DataFrame, kind: Envelope, *, body: str = "body") -> DataFrame:
    """Refused documents alone: only what tells the reason is parsed, no item is built."""
    keep = [c for c in documents.columns if c != body]
    doc = F.from_json(F.col(body), kind.narrow_schema)
    reason = kind.narrow_reason(F.col("doc"))
    # A filter on the reason would be pushed below the parse and repeat it.
    told = documents.select(*keep, F.col(body).alias("body"), doc.alias("doc")).select(
        *keep, "body", F.explode_outer(F.when(reason.isNotNull(), F.array(reason))).alias("reason")
    )
    return told.where("reason is not null")


def _unpacked(documents: DataFrame, kind: Envelope, body: str) -> Unpacked:
    return Unpacked(
        rows_of(opened(documents, kind, body=body), kind), rejected(documents, kind, body=body)
    )


def unpack_arrivals(documents: DataFrame, body: str = "body") -> Unpacked:
    """Arrival board rows, tagged as a whole-network query."""
    rows, rejects = _unpacked(documents, ARRIVALS, body)
    return Unpacked(rows.withColumn("query_station_name", F.lit(S.WHOLE_NETWORK_QUERY)), rejects)


def unpack_usage(documents: DataFrame, body: str = "body") -> Unpacked:
    """Ridership rows of all pages; a page is good with the OK code or with none."""
    return _unpacked(documents, USAGE, body)


@contextmanager
def refusals() -> Iterator[None]:
    """Turns the failure of a job that reads a ``strict`` frame into its reason."""
    try:
        yield
    except PySparkException as error:
        found = re.search(f"{_REFUSED}[^\n]*", str(error))
        if not found:
            raise
        raise RuntimeError(found[0]) from error


def failed_envelopes(unpacked: Unpacked) -> None:
    """Raise with the first reject's reason when there is any."""
    first = unpacked.rejects.select("reason").first()
    if first is not None:
        raise RuntimeError(f"{_REFUSED}{first.reason}")
