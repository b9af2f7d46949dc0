import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session, tune

    session = tune(local_session("4", shuffle_partitions=4, app="tests"))
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from millrace.session import scratch

    return lambda name: scratch(spark, f"test-{name}")
