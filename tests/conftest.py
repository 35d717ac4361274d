import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from anthro.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="anthro-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="anthro-test-ckpt-"),
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="anthro-test-wh-")})
    yield s
    s.stop()
