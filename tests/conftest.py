import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from codonmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """A frame of the given rows; all columns are text unless a schema says otherwise."""

    def make(columns, rows, schema=None):
        ddl = schema or ", ".join(f"`{c}` string" for c in columns.split())
        return spark.createDataFrame(rows, ddl)

    return make


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
