import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from evenkeel.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_groups(monkeypatch):
    """Treat every small table as too large to broadcast, to take the salted shuffle join."""
    from evenkeel.plans import staging
    monkeypatch.setattr(staging, "PIN_ROWS", 0)
    monkeypatch.setattr(staging, "SALTS", 3)
