import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import local_session, new_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tidemark-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")
