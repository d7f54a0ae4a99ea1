import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strophe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture
def rows():
    def collect(df):
        return [tuple(r) for r in df.collect()]

    return collect
