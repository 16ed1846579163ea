import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(__file__), os.path.dirname(os.path.dirname(__file__))]

from tidemart.session import build_session, tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = tune(build_session("tidemart-tests", 8))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new folder under the shared working folder."""
    from tidemart.session import work_dir

    return lambda name: work_dir(spark, name)
