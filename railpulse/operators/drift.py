"""Frames whose columns differ."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widest(kinds: Sequence[T.DataType]) -> T.DataType:
    """One type that holds values of all: the widest whole number, double where a fraction
    is among numbers, else text."""
    kinds = [k for k in kinds if not isinstance(k, T.NullType)] or [T.NullType()]
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if all(isinstance(k, WHOLE) for k in kinds):
        return max(kinds, key=lambda k: WHOLE.index(type(k)))
    if all(isinstance(k, T.NumericType) for k in kinds):
        return T.DoubleType()
    return T.StringType()


def union_drifting(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows by column name; a column a frame lacks is null in its rows, one of several
    types takes the widest."""
    frames = list(frames)
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            kinds.setdefault(field.name, []).append(field.dataType)
    goal = {name: widest(seen) for name, seen in kinds.items()}

    def fitted(frame: DataFrame) -> DataFrame:
        return frame.select(
            *(
                F.col(f"`{f.name}`").cast(goal[f.name]).alias(f.name)
                if f.dataType != goal[f.name]
                else F.col(f"`{f.name}`")
                for f in frame.schema.fields
            )
        )

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(fitted, frames))


def is_empty(df: DataFrame) -> bool:
    """Whether the frame has no row; stops at the first one found."""
    return df.isEmpty()
