"""Schema helpers: choosing, checking, casting and standardising columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED_TYPES = (T.StructType, T.ArrayType, T.MapType)


class MissingColumnsError(ValueError):
    """Required columns are absent."""

    def __init__(self, missing: Sequence[str], present: Sequence[str]):
        super().__init__(f"missing columns {list(missing)}; present are {list(present)}")
        self.missing = list(missing)


def resolve_column(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """The first candidate the frame has, or None."""
    present = set(df.columns)
    return next((name for name in candidates if name in present), None)


def resolve_columns(
    df: DataFrame,
    required: Mapping[str, Sequence[str]],
    optional: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str | None]:
    """Bind logical names to physical ones; raise listing every unbound required one."""
    bound = {k: resolve_column(df, names) for k, names in required.items()}
    missing = [k for k, name in bound.items() if name is None]
    if missing:
        raise MissingColumnsError(missing, df.columns)
    return bound | {k: resolve_column(df, names) for k, names in (optional or {}).items()}


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names).difference(df.columns))
    if missing:
        raise MissingColumnsError(missing, df.columns)
    return df


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only those of the names the frame has, in the order given."""
    present = set(df.columns)
    return df.select(*(n for n in names if n in present))


def column_or_null(df: DataFrame, name: str | None, dtype: str) -> Column:
    """The column cast to the type, or a typed null when the frame lacks it."""
    if name is None or name not in df.columns:
        return F.lit(None).cast(dtype)
    return F.col(name).try_cast(dtype)


def mapped_columns(df: DataFrame, mapping: Iterable[tuple[str, str, str]]) -> list[Column]:
    """Rename-and-cast projection from (target, source, type) rows. Text that does
    not fit the type becomes null, as does a column the input lacks."""
    return [column_or_null(df, source, dtype).alias(target) for target, source, dtype in mapping]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order and type; extra columns are dropped."""
    return df.select(
        *(
            column_or_null(df, f.name, f.dataType.simpleString()).alias(f.name)
            for f in schema.fields
        )
    )


def nested_to_json(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, others untouched."""
    nested = {
        f.name: F.to_json(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, NESTED_TYPES)
    }
    return df.withColumns(nested) if nested else df


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text: nested values as JSON, the rest by cast."""
    return df.select(
        *(
            (
                F.to_json(F.col(f.name))
                if isinstance(f.dataType, NESTED_TYPES)
                else F.col(f.name).cast("string")
            ).alias(f.name)
            for f in df.schema.fields
        )
    )


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without a single value.

    One aggregation counts all columns together, and only that one row of counts
    reaches the driver. Opt-in: it makes the schema depend on the data.
    """
    counts = df.agg(*(F.count(F.col(c)).alias(c) for c in df.columns)).first()
    return df.drop(*(c for c in df.columns if counts[c] == 0))


def standardise(df: DataFrame, renames: Mapping[str, str], optional: Mapping[str, str]) -> DataFrame:
    """Rename present columns; add the optional ones still absent as typed nulls."""
    renamed = df.withColumnsRenamed(
        {old: new for old, new in renames.items() if old in df.columns and old != new}
    )
    absent = {n: F.lit(None).cast(t) for n, t in optional.items() if n not in renamed.columns}
    return renamed.withColumns(absent) if absent else renamed
