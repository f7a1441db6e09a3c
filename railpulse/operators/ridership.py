"""Daily ridership totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse import settings as S
from railpulse.functions.columns import resolve_columns, standardise
from railpulse.operators.ranking import rank_within, top_k

SUMS = {"totalNope": "total", "rideNope": "boarded", "gffNope": "alighted"}


def _totals(
    df: DataFrame, keys: dict[str, tuple[str, Sequence[str]]], codes: dict[str, Sequence[str]]
) -> DataFrame:
    names = resolve_columns(
        df,
        required={**{k: c for k, (_, c) in keys.items()}, "total": S.TOTAL_SUM_NAMES},
        optional={**codes, "boarded": S.TOTAL_BOARDED_NAMES, "alighted": S.TOTAL_ALIGHTED_NAMES},
    )
    group = [names[k] for k in keys] + [names[c] for c in codes if names[c]]
    sums = [F.sum(names[part]).alias(out) for out, part in SUMS.items() if names[part]]
    return standardise(
        df.groupBy(*group).agg(*sums),
        renames={names[k]: out for k, (out, _) in keys.items()},
        optional={code: "string" for code in codes},
    )


def station_totals(df: DataFrame) -> DataFrame:
    """Totals per (day, station, line) and, where present, their codes."""
    return _totals(
        df,
        keys={
            "day": ("pasngYmd", S.TOTAL_DAY_NAMES),
            "station": ("stnNm", S.TOTAL_STATION_NAMES),
            "line": ("lineNm", S.TOTAL_LINE_NAMES),
        },
        codes={"stnCd": S.TOTAL_STATION_CODE_NAMES, "lineNo": S.TOTAL_LINE_NUMBER_NAMES},
    )


def line_totals(df: DataFrame) -> DataFrame:
    """Totals per (day, line) and, where present, the line number."""
    return _totals(
        df,
        keys={
            "day": ("pasngYmd", S.TOTAL_DAY_NAMES),
            "line": ("lineNm", S.TOTAL_LINE_NAMES),
        },
        codes={"lineNo": S.TOTAL_LINE_NUMBER_NAMES},
    )


def daily_totals(silver: DataFrame, by: str) -> DataFrame:
    """Sum of all movements per day and ``by`` (station_name or line_name)."""
    return silver.groupBy("use_ymd", by).agg(F.sum("total_count").alias("daily_total"))


def busiest(totals: DataFrame, k: int = S.PREVIEW_K, measure: str = "daily_total") -> DataFrame:
    return top_k(totals, k, [F.col(measure).desc_nulls_last()])


def with_daily_rank(totals: DataFrame) -> DataFrame:
    """Add ``rank_daily``, the station's place by total within its day."""
    return rank_within(totals, ["pasngYmd"], "totalNope")
