import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from commitlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        str(tmp_path_factory.mktemp("shared")),
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
        # The plans are many and the data small: compiling them would take longer than running them.
        spark__sql__codegen__wholeStage="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Joins take the shuffled, salted way, as they do for tables over the broadcast limit."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def rows():
    def collect(df, *columns):
        return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]

    return collect
