import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from textloom.session import build_session

    options = {"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    session = build_session("tests", "local[8]", 8, options)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
