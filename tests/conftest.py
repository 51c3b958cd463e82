import os

import pytest

from tallyloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [str(v) for v in r])
