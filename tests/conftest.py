import os

import pytest

import shelfwise.plans  # noqa: F401  (registers the reports)
from shelfwise.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shelfwise-tests", os.environ.get("TEST_MASTER", "local[4]"), spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
