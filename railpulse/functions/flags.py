"""Flags, labels and null-safe ratios."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from railpulse import settings as S


def yes_no_unknown(column: Column, yes: str = "1", no: str = "0") -> Column:
    """True, false, or null when the text is neither."""
    text = column.cast("string")
    return F.when(text == yes, True).when(text == no, False)


def as_flag(condition: Column) -> Column:
    """0/1 integer; unknown counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def at_least(column: Column, threshold: float) -> Column:
    """0/1 integer: the value reaches the threshold."""
    return as_flag(column >= F.lit(threshold))


def one_of(column: Column, members: Iterable) -> Column:
    """0/1 integer: the value is in a fixed list."""
    return as_flag(column.isin(*members))


def label_of(column: Column, labels: Mapping[int, str], default: str) -> Column:
    """Text label of a code; codes sharing a label share one membership test."""
    codes_by_label: dict[str, list[int]] = {}
    for code, label in labels.items():
        codes_by_label.setdefault(label, []).append(code)
    chain = F
    for label, codes in codes_by_label.items():
        chain = chain.when(column.isin(*codes), F.lit(label))
    return chain.otherwise(F.lit(default))


def arrival_phase(code: Column) -> Column:
    return label_of(code, S.PHASE_BY_STATUS_CODE, S.OTHER_PHASE)


def share_at_least(column: Column, threshold: float) -> Column:
    """Aggregate: share of rows reaching the threshold. A null row counts as not
    reaching it, yet stays in the denominator."""
    return F.avg(at_least(column, threshold).cast("double"))


def any_true(column: Column) -> Column:
    """Aggregate: some row is true; false for a group of unknowns."""
    return F.coalesce(F.bool_or(column), F.lit(False))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: a null value drops out of the numerator only; no rows give null."""
    return F.try_divide(F.sum(weight * value), F.sum(weight))


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))
