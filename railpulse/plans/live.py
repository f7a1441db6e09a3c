"""Bronze to metrics to alerts as one running stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from railpulse import settings as S
from railpulse.operators.alerts import delay_alerts
from railpulse.operators.silver import silver_arrivals
from railpulse.plans.lake import Lake
from railpulse.sources.envelopes import ARRIVAL_FIELDS, OTHER_FIELDS
from railpulse.sources.topics import file_stream
from railpulse.streaming.arrivals import metrics_stream
from railpulse.streaming.runs import alerting, for_each_batch, in_turn, window_replacer

BRONZE_SCHEMA = ", ".join(
    [f"{name} string" for name in (*ARRIVAL_FIELDS, OTHER_FIELDS, "query_station_name", "run_ts")]
    + ["snapshot_ts timestamp"]
    + [f"{name} int" for name in (*S.ARRIVAL_PARTITION, "minute")]
)
EVERY = f"{S.SLIDE_MINUTES} minutes"


def watch_arrivals(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    deliver: Callable[[DataFrame], None],
    *,
    every: str | None = EVERY,
    delay: str = "10 minutes",
    files_per_trigger: int | None = None,
    **thresholds,
) -> StreamingQuery:
    """Follow bronze arrivals, replace the metrics of each closed window and deliver
    its alert, once even over restarts. With ``every=None`` the run takes what is there and
    ends."""
    bronze = file_stream(
        spark,
        lake.bronze_arrivals,
        BRONZE_SCHEMA,
        format=lake.format,
        files_per_trigger=files_per_trigger,
    )
    metrics = metrics_stream(silver_arrivals(bronze), delay=delay, time_columns=("event_time",))
    writer = in_turn(
        window_replacer(lake.arrival_metrics),
        alerting(
            lambda batch: delay_alerts(batch, **thresholds),
            deliver,
            ledger=f"{checkpoint}-delivered",
        ),
    )
    return for_each_batch(metrics, writer, checkpoint, every=every)
