import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from roadbook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def plan(spark):
    """The physical plan of a frame before it runs, as text."""

    def explain(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return explain


def rows(df, *columns):
    """All rows as sorted tuples."""
    df = df.select(*columns) if columns else df
    return sorted(map(tuple, df.collect()), key=repr)
