import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from oracle import connect  # noqa: E402
from spoor.session import builder  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    # The suite's own folder for intermediate tables; a cluster names one itself.
    shared = tempfile.mkdtemp(prefix="spoor-tests-")
    session = (
        builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def small_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)
