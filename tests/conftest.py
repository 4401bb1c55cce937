import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemart.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", "UTC", 4, {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of dicts."""
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=repr)


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def plan(df):
    """Physical plan of a frame that has not run yet."""
    return df._jdf.queryExecution().executedPlan().toString()
