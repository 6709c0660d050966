import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelhouse.session import build_session

    import tempfile

    wh = tempfile.mkdtemp(prefix="reelhouse-warehouse-", dir="/tmp")
    s = build_session("local[4]", app_name="reelhouse-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
