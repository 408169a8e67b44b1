import pytest

from quayside.session import local_session, scratch


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=2)


@pytest.fixture
def folder(spark):
    """A new folder path per call, below the session's shared folder."""
    return lambda name="test": scratch(spark, name)
