import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from workpulse.session import ensure_checkpoint_dir, get_spark

    warehouse = tempfile.mkdtemp(prefix="wp-warehouse-", dir="/tmp")
    checkpoints = tempfile.mkdtemp(prefix="wp-checkpoints-", dir="/tmp")
    s = get_spark(master="local[*]", app_name="workpulse-tests", shuffle_partitions=8,
                  conf={"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": checkpoints})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
