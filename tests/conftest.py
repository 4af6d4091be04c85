import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0 = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewatch.session import checkpoint_dir, get_session
    s = get_session("local[4]", 8)
    checkpoint_dir(s, fallback=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
