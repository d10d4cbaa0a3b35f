import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakeops.session import checkpoint_root, get_spark
    s = get_spark("local[4]", app_name="lakeops-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        d = tempfile.mkdtemp(prefix="lakeops-test-ckpt-")   # tests only: no shared folder set
        s.sparkContext.setCheckpointDir(d)
    checkpoint_root(s)
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
