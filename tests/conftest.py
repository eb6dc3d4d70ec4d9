"""One local session for all tests."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paceline.session import session

    s = session("local[4]", 4, **{"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    at = DATA / "sf0.001"
    if not at.is_dir():
        pytest.skip("the driver's tables aren't there")
    return str(at)
