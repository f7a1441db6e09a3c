import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from railpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="railpulse-tests-")
    session = build_session(
        "tests",
        zone="UTC",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{base}/warehouse",
            "spark.checkpoint.dir": f"{base}/shared",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return lambda name: f"file://{tmp_path}/{name}"
