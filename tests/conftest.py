import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

@pytest.fixture(scope="session")
def spark():
    from stratum.session import get_session

    ckpt = tempfile.mkdtemp(prefix="stratum-test-ckpt-")
    s = get_session("local[4]", app="stratum-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path(tmp_path):
    return str(tmp_path)
