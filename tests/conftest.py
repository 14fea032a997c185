from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from terrace.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[*]",
        app_name="terrace-tests",
        conf={"spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "8"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    # Tests write only below a fresh temporary folder.
    return tempfile.mkdtemp(prefix="terrace-test-")
