"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from railpulse.settings import SERVICE_ZONE


def build_session(
    app_name: str,
    *,
    zone: str = SERVICE_ZONE,
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the options the operators rely on.

    Shuffle width is left to adaptive execution: a high initial partition count
    is coalesced at run time, and skewed join partitions are split.
    """
    options = {
        "spark.sql.session.timeZone": zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Window state can outgrow executor heap; RocksDB keeps it off heap and
        # writes incremental change logs to the checkpoint folder.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder path every executor can reach.

    It lies under the session's ``spark.checkpoint.dir``. Only a local-mode
    session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="railpulse-")
    return f"{root.rstrip('/')}/railpulse/{label}-{uuid.uuid4().hex}"
