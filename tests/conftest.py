import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamwatch.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture()
def transactions(spark):
    """Rows of (timestamp text, amount, label) as a table with the default columns."""

    def build(rows):
        return spark.createDataFrame(rows, "timestamp string, Amount double, Class int")

    return build
