import pytest

from stumpline.functions.scan import HOT_ROWS_CONF
from stumpline.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def hot(spark):
    """Call with a row count: larger groups take the hot-group route until the test ends."""
    yield lambda rows: spark.conf.set(HOT_ROWS_CONF, str(rows))
    spark.conf.unset(HOT_ROWS_CONF)
