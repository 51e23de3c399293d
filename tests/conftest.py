import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conceptnorm.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_spark(master="local[4]", shuffle_partitions=4)


@pytest.fixture()
def tmp_release(tmp_path):
    return str(tmp_path)
