import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clickflow import schemas  # noqa: E402
from clickflow.sources.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


@pytest.fixture
def actions(spark):
    """Builds an action table from dicts; ``time`` is text and fills date and action_time."""

    def build(*rows):
        full = []
        for row in rows:
            time = at(row["time"])
            values = {"date": time.date(), "action_time": time, "user_id": 1, **row}
            full.append(tuple(values.get(name) for name in schemas.USER_VISIT_ACTION.names))
        return spark.createDataFrame(full, schemas.USER_VISIT_ACTION)

    return build


@pytest.fixture
def users(spark):
    def build(*rows):
        full = [tuple(row.get(name) for name in schemas.USER_INFO.names) for row in rows]
        return spark.createDataFrame(full, schemas.USER_INFO)

    return build
