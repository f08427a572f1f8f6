import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weekloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


MONDAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="session")
def panel(spark):
    """Build a weekly panel from {series: values}; NULL skips the week."""
    def make(**series):
        rows = [(k, MONDAY + dt.timedelta(weeks=w), y) for k, ys in series.items() for w, y in enumerate(ys) if y is not None]
        return spark.createDataFrame(rows, "unique_id string, ds date, y bigint")
    return make
