import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from equitylake.session import session

    folder = tempfile.mkdtemp(prefix="spark-tests-")
    found = session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.local.dir": folder, "spark.checkpoint.dir": f"file://{folder}", "spark.sql.warehouse.dir": f"{folder}/warehouse"},
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"
