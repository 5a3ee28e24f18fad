import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from assay.session import build_session, ensure_checkpoint_dir

    session = build_session("local[*]", app_name="assay-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    # Shared staging folder: the session's own if it names one, else a scratch one.
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="assay-ckpt-"))
    yield session


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="assay-test-")


@pytest.fixture(scope="session")
def source01(spark):
    from assay.sources import downloads_from_events, read_table
    return downloads_from_events(read_table(spark, SF01, "events"))


@pytest.fixture(scope="session")
def source001(spark):
    from assay.sources import downloads_from_events, read_table
    return downloads_from_events(read_table(spark, SF001, "events"))
