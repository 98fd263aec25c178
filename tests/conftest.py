import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from lodestar.session import local_session

    session = local_session("*", partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows():
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
