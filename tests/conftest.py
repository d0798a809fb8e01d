import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import build_session
    scratch = tempfile.mkdtemp(prefix="shelfwise-test-")
    os.environ.setdefault("SHELFWISE_SCRATCH", scratch)
    s = build_session("local[4]", app="shelfwise-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch_dir(spark):
    from shelfwise.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark)
