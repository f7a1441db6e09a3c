"""Landing of enveloped documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from railpulse.sinks.tables import append, held
from railpulse.sources.envelopes import (
    Envelope,
    as_text,
    opened,
    refusals,
    rejects_of,
    rows_of,
    text_rows,
)


def land(
    documents: DataFrame,
    kind: Envelope,
    bronze: Callable[[DataFrame], DataFrame],
    root: str,
    *,
    partition_by: Sequence[str],
    format: str = "parquet",
    rejects: str | None = None,
) -> None:
    """Append the items of landed documents, made into bronze rows, to a table.

    Each document is parsed once. Without ``rejects`` a refused document fails the write,
    so nothing of its batch is committed. With it, items, as text already, and refused
    documents are written once to the shared folder and from there to the table and to
    ``rejects``.
    """
    if rejects is None:
        with refusals():
            rows = rows_of(opened(documents, kind, strict=True), kind)
            append(bronze(rows), root, partition_by=partition_by, format=format)
        return
    with held(as_text(opened(documents, kind), kind), "opened") as found:
        append(bronze(text_rows(found)), root, partition_by=partition_by, format=format)
        append(rejects_of(found), rejects, format=format)
