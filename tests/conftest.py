import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from repo_pulse.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=4, app_name="repo_pulse-tests")
    yield s
    s.stop()
