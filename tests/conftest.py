import sys
import tempfile
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from forecourt.session import build_session, release_scratch  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture
def new_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def use(**conf):
        for name, value in conf.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield use
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
