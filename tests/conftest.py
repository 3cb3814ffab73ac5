import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinloom.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app="clinloom-tests", conf={"spark.sql.shuffle.partitions": "8"})
    checkpoint_dir(s)  # the configured shared folder; a scratch one only when none is set
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="clinloom-test-")
