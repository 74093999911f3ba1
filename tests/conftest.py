import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from adlake.session import local_session

    warehouse = tempfile.mkdtemp(prefix="adlake-wh-")
    s = local_session(cores="*", shuffle_partitions=8, app="adlake-tests",
                      conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
