import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inboxlens.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="inboxlens-ckpt-"))
    yield s
