import pytest

from testbed.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
