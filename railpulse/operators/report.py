"""The ranked daily report context.

Each section works over one day's frame (``within=()``), or over many days at once
with ``within=("report_date",)``; :func:`usage_by_report_day` and
:func:`kpi_by_report_day` add that column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railpulse import settings as S
from railpulse.functions.columns import resolve_column, resolve_columns, select_existing
from railpulse.functions.times import display_time, parse_day
from railpulse.operators.ranking import top_k
from railpulse.sinks.tables import stored

REPORT_DAY = "report_date"
WAIT_COLUMNS = ("station_name", "line_id", "avg_wait_sec", "p95_wait_sec", "long_wait_ratio_5")
PAIN_COLUMNS = (*WAIT_COLUMNS, "totalNope", "pain_score")


def usage_by_report_day(usage: DataFrame, *, lag_days: int = S.USAGE_LAG_DAYS) -> DataFrame:
    """Add the report day on which a ridership day is the newest confirmed one."""
    day = resolve_columns(usage, {"day": S.TOTAL_DAY_NAMES})["day"]
    return usage.withColumn(REPORT_DAY, F.date_add(parse_day(F.col(day)), lag_days))


def kpi_by_report_day(kpi: DataFrame, *, lag_days: int = S.ARRIVAL_LAG_DAYS) -> DataFrame:
    return kpi.withColumn(REPORT_DAY, F.date_add("event_date", lag_days))


def bind_usage(usage: DataFrame, within: Sequence[str] = ()) -> DataFrame | None:
    """Ridership under its report names, or None without a station or total column."""
    station = resolve_column(usage, S.REPORT_STATION_NAMES)
    total = resolve_column(usage, S.REPORT_TOTAL_NAMES)
    if station is None or total is None:
        return None
    line = resolve_column(usage, S.REPORT_LINE_NAMES)
    rank = resolve_column(usage, S.REPORT_RANK_NAMES)
    return usage.select(
        *within,
        F.col(station).alias("station_name"),
        (F.col(line) if line else F.lit(None).cast("string")).alias("line_name"),
        F.col(total).alias("totalNope"),
        (F.col(rank) if rank else F.lit(None)).cast("bigint").alias("rank_daily"),
    )


def _bound(usage: DataFrame, within: Sequence[str]) -> DataFrame:
    bound = bind_usage(usage, within)
    if bound is None:
        resolve_columns(
            usage, {"station": S.REPORT_STATION_NAMES, "total": S.REPORT_TOTAL_NAMES}
        )
    return bound


def top_stations(
    usage: DataFrame,
    *,
    k: int = S.TOP_K,
    within: Sequence[str] = (),
    position: str | None = None,
) -> DataFrame:
    """The k station-line rows with the most passengers."""
    return top_k(
        _bound(usage, within),
        k,
        [F.col("totalNope").desc_nulls_last()],
        within=within,
        position=position,
    )


def line_usage_stats(usage: DataFrame, *, within: Sequence[str] = ()) -> DataFrame:
    """Mean and highest total per known line."""
    return (
        _bound(usage, within)
        .where("line_name is not null")
        .groupBy(*within, "line_name")
        .agg(F.avg("totalNope").alias("avg_totalNope"), F.max("totalNope").alias("max_totalNope"))
    )


def line_wait_stats(kpi: DataFrame, *, within: Sequence[str] = ()) -> DataFrame:
    """Plain means over the stations of each known line."""
    measures = ("avg_wait_sec", "p95_wait_sec", "long_wait_ratio_5", "express_ratio")
    return (
        kpi.where("line_id is not null")
        .groupBy(*within, "line_id")
        .agg(*(F.avg(m).alias(m) for m in measures))
    )


def _share_of(value: Column, highest: Column) -> Column:
    return F.try_divide(value, highest + F.lit(S.NORMALISER_EPSILON))


def painful_stations(
    kpi: DataFrame,
    usage: DataFrame,
    *,
    k: int = S.TOP_K,
    within: Sequence[str] = (),
    position: str | None = None,
    kept: bool = False,
) -> DataFrame:
    """The k worst pairs of station KPI and ridership rows that share a station.

    The score of a pair is its wait times its ridership, each over the highest
    among matching rows. A station has a row per line on both sides, so all pairs
    of a busy station would grow with the product of its rows. They are not made.

    First each side is reduced to the extremes of its stations. With one row held fixed
    the score moves one way with the other, so a station's best score is that of two
    extremes. The k-th best of the stations is a score that k pairs reach; a station whose
    best is below takes no further part. Of the others a pair of the first k joins one of
    the k highest or k lowest waits with one of the k highest or k lowest riderships, the
    lowest only where a value is below 0: at most 4 * k * k pairs per station.

    Both frames are read twice. They are stored for that, unless they are ``kept``, that is
    read from tables as they are.
    """
    station = [*within, "station_name"]
    waits = select_existing(kpi, [*within, *WAIT_COLUMNS]).where("station_name is not null")
    riders = _bound(usage, within).select(*station, "totalNope").where("station_name is not null")

    if not kept:
        waits, riders = stored(waits, "waits"), stored(riders, "riders")

    def reduced(rows: DataFrame, measure: str, name: str) -> DataFrame:
        return rows.groupBy(*station).agg(
            F.max(measure).alias(f"_{name}_high"),
            F.min(measure).alias(f"_{name}_low"),
            F.count(measure).alias(f"_{name}_n"),
        )

    both = reduced(waits, "avg_wait_sec", "wait").join(reduced(riders, "totalNope", "total"), station)
    with_peaks = _with_peaks(stored(both, "stations"), within)
    corners = [
        _pain(F.col(f"_wait_{w}"), F.col(f"_total_{t}"))
        for w in ("high", "low")
        for t in ("high", "low")
    ]
    chosen = _reaching(with_peaks.withColumn("_best", F.greatest(*corners)), k, within)
    chosen = stored(chosen.drop("_best"), "chosen")
    signs = ("_wait_low", "_total_low", "_wait", "_total")
    least = chosen.agg(F.min(F.least(*signs))).first()[0]
    low = least is not None and least < 0

    pairs = _outermost(waits.join(chosen, station), "avg_wait_sec", "_wait_n", k, station, low).join(
        _outermost(
            riders.join(chosen.select(*station, "_total_n"), station), "totalNope", "_total_n", k, station, low
        ),
        station,
    )
    scored = pairs.withColumn("pain_score", _pain(F.col("avg_wait_sec"), F.col("totalNope")))
    return top_k(
        select_existing(scored, [*within, *PAIN_COLUMNS]),
        k,
        [
            F.col("pain_score").desc_nulls_last(),
            F.col("avg_wait_sec").desc_nulls_last(),
            F.col("totalNope").desc_nulls_last(),
        ],
        within=within,
        position=position,
    )


def _pain(wait: Column, total: Column) -> Column:
    return _share_of(wait, F.col("_wait")) * _share_of(total, F.col("_total"))


def _with_peaks(stations: DataFrame, within: Sequence[str]) -> DataFrame:
    """Add the highest wait and ridership of the group, or of all stations."""
    highest = (F.max("_wait_high").alias("_wait"), F.max("_total_high").alias("_total"))
    if within:
        return stations.join(stations.groupBy(*within).agg(*highest), list(within))
    peak = stations.agg(*highest).select(F.struct("_wait", "_total")).scalar()
    return stations.withColumns({"_wait": peak["_wait"], "_total": peak["_total"]})


def _reaching(stations: DataFrame, k: int, within: Sequence[str]) -> DataFrame:
    """Stations whose best score is at least the k-th best of their group; all of them
    where fewer than k have one."""
    best = F.col("_best")
    if not within:
        leading = stations.select("_best").where(best.isNotNull()).orderBy(best.desc()).limit(k)
        bar = leading.agg(F.when(F.count(F.lit(1)) == k, F.min("_best")).alias("_bar")).scalar()
        return stations.where(bar.isNull() | (best >= bar))
    place = F.row_number().over(Window.partitionBy(*within).orderBy(best.desc_nulls_last()))
    bars = (
        stations.select(*within, "_best", place.alias("_place"))
        .where(F.col("_place") <= k)
        .where((F.col("_place") == k) & best.isNotNull())
        .select(*within, F.col("_best").alias("_bar"))
    )
    return stations.join(bars, list(within), "left").where("_bar is null or _best >= _bar").drop("_bar")


def _outermost(
    df: DataFrame, measure: str, known: str, k: int, within: Sequence[str], low: bool
) -> DataFrame:
    """The k highest rows of each group and, with ``low``, the k lowest, each row once; a
    null counts as the lowest and comes with the highest only. Column ``known`` has the
    group's rows without null.

    The two orders are each other's reverse, so in a group of n rows the p-th lowest is
    the (n - p + 1)-th highest. Each side limits a group before its shuffle.
    """
    rest = [c for c in df.columns if c != measure and c not in within]
    highest = [F.col(measure).desc_nulls_last(), *(F.col(c).asc_nulls_first() for c in rest)]
    lowest = [F.col(measure).asc_nulls_first(), *(F.col(c).desc_nulls_last() for c in rest)]

    def first(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
        return rows.withColumn("_place", place).where(F.col("_place") <= k)

    found = first(df, highest)
    if low:
        lower = first(df.where(F.col(measure).isNotNull()), lowest)
        found = found.unionByName(lower.where(F.col("_place") <= F.col(known) - k))
    return found.drop("_place", known)


def last_trains(
    kpi: DataFrame,
    *,
    k: int = S.TOP_K,
    within: Sequence[str] = (),
    position: str | None = None,
) -> DataFrame:
    """The k latest last trains, their time as text."""
    timed = kpi.where("last_train_dt is not null").withColumn(
        "last_train_time_str", display_time(F.col("last_train_dt"))
    )
    names = [*within, "station_name", "line_id", "last_train_time_str", "last_train_wait_sec"]
    return top_k(
        select_existing(timed, [*names, "last_train_dt"]),
        k,
        [F.col("last_train_dt").desc()],
        within=within,
        position=position,
    ).drop("last_train_dt")


def late_night_hotspots(
    kpi: DataFrame,
    *,
    k: int = S.TOP_K,
    within: Sequence[str] = (),
    position: str | None = None,
) -> DataFrame:
    """The k stations with the most late-night events."""
    return top_k(
        select_existing(kpi, [*within, "station_name", "line_id", "late_night_events"]),
        k,
        [F.col("late_night_events").desc_nulls_last()],
        within=within,
        position=position,
    )


def _as_list(section: DataFrame, order: str, name: str, drop_order: bool = True) -> DataFrame:
    """One row per report day holding a section's rows as an ordered list.

    Sections are top-k lists or one row per line, so a list stays small.
    """
    fields = [c for c in section.columns if c not in (REPORT_DAY, order)]
    items = F.array_sort(F.collect_list(F.struct(order, *fields)))
    if drop_order:
        items = F.transform(items, lambda i: F.struct(*(i[f].alias(f) for f in fields)))
    return section.groupBy(REPORT_DAY).agg(items.alias(name))


def report_context(
    kpi: DataFrame, usage: DataFrame, *, k: int = S.TOP_K, kept: bool = False
) -> DataFrame:
    """One row per report day: target_ymd, nested usage and arrival sections, has_data.

    Both inputs carry ``report_date``. A day present on one side only has
    ``has_data`` false, and no lists, on the other. ``kept``: see :func:`painful_stations`.
    """
    day = (REPORT_DAY,)
    ranked = {"k": k, "within": day, "position": "position"}

    usage_day = usage.select(REPORT_DAY).distinct().withColumn("usage_seen", F.lit(True))
    arrival_day = kpi.select(REPORT_DAY).distinct().withColumn("arrival_seen", F.lit(True))
    usage_bound = bind_usage(usage, day) is not None
    if not usage_bound:
        usage_day = usage_day.withColumn("usage_seen", F.lit(False))

    context = usage_day.join(arrival_day, REPORT_DAY, "full_outer")
    sections = [
        _as_list(line_wait_stats(kpi, within=day), "line_id", "line_wait_stats", drop_order=False),
        _as_list(last_trains(kpi, **ranked), "position", "last_train_info"),
        _as_list(late_night_hotspots(kpi, **ranked), "position", "late_night_hotspots"),
    ]
    if usage_bound:
        sections += [
            _as_list(top_stations(usage, **ranked), "position", "top_stations_by_total"),
            _as_list(
                line_usage_stats(usage, within=day), "line_name", "line_usage_stats", drop_order=False
            ),
            _as_list(
                painful_stations(kpi, usage, kept=kept, **ranked), "position", "painful_stations"
            ),
        ]
    for section in sections:
        context = context.join(section, REPORT_DAY, "left")

    def part(seen: str, names: Sequence[str]) -> Column:
        present = F.coalesce(F.col(seen), F.lit(False))
        lists = [
            F.when(present, F.coalesce(F.col(n), F.array())).alias(n)
            for n in names
            if n in context.columns
        ]
        return F.struct(present.alias("has_data"), *lists)

    return context.where(F.col(REPORT_DAY).isNotNull()).select(
        F.date_format(REPORT_DAY, S.DAY_PATTERN).alias("target_ymd"),
        part("usage_seen", ["top_stations_by_total", "line_usage_stats"]).alias("usage"),
        part(
            "arrival_seen",
            ["line_wait_stats", "painful_stations", "last_train_info", "late_night_hotspots"],
        ).alias("arrival"),
    )


def context_json(context: DataFrame) -> DataFrame:
    """Each day's context as one JSON document. Null fields of a listed row are written
    out; a side without data holds nothing but ``has_data``."""

    def side(name: str) -> Column:
        whole = F.to_json(name, {"ignoreNullFields": "false"})
        return F.when(F.col(name)["has_data"], whole).otherwise('{"has_data":false}')

    day = F.to_json(F.struct("target_ymd"))
    body = F.concat(
        F.expr("substring(_day, 1, length(_day) - 1)"),
        F.lit(',"usage":'), side("usage"), F.lit(',"arrival":'), side("arrival"), F.lit("}"),
    )
    return context.withColumn("_day", day).select("target_ymd", body.alias("context"))
