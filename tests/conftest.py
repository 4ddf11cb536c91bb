import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    ckpt = tempfile.mkdtemp(prefix="tessera-test-ckpt-")
    s = get_session("local[*]", app="tessera-tests", shuffle_partitions=8,
                    spark__checkpoint__dir=ckpt)
    yield s
    s.stop()
