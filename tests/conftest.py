from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from demandcast.schemas import CREDIT_SCHEMA, PANEL_SCHEMA  # noqa: E402
from demandcast.session import get_session, resolve_checkpoint_dir  # noqa: E402
from sample_rows import CREDIT_ROWS, PANEL_ROWS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(master="local[2]", shuffle_partitions=4, app_name="demandcast-tests")
    resolve_checkpoint_dir(session)  # the configured folder, or a temporary one when unset
    yield session
    session.stop()


@pytest.fixture(scope="session")
def credit(spark):
    return spark.createDataFrame(CREDIT_ROWS, CREDIT_SCHEMA)


@pytest.fixture(scope="session")
def panel(spark):
    return spark.createDataFrame(PANEL_ROWS, PANEL_SCHEMA)


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="demandcast-test-")
