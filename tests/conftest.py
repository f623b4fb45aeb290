import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quantleaf.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="quantleaf-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quantleaf-test-ckpt-"),
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="quantleaf-test-wh-")})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="quantleaf-test-")
