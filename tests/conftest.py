import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session

    session = get_session(
        "strata-tests",
        master="local[4]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "4"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    from strata.sources.store import TableStore

    s = TableStore(spark, tempfile.mkdtemp(prefix="strata-store-"))
    s.ensure_layers()
    return s
