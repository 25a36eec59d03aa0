import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from weirgate.session import build_session

    session = build_session(
        "tests", master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
