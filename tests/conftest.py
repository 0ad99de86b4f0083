import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparkplate.session import checkpoint_dir, get_session
    scratch = tempfile.mkdtemp(prefix="sparkplate-test-")
    s = get_session("local[4]", app="sparkplate-tests", shuffle_partitions=8, conf={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.driver.memory": "4g",
    })
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="sparkplate-data-")
