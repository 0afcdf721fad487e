import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.session import build_session  # noqa: E402

UTC = timezone.utc
T0 = datetime(2023, 10, 1, 6, 30, tzinfo=UTC)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "8", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    yield session
    session.stop()


def minute(k: int) -> datetime:
    """The instant ``k`` minutes before the trigger."""
    return T0 - timedelta(minutes=k)


EVENT_DDL = "site_id int, ts timestamp, plant_up int, records array<struct<id:string,value:double>>"


@pytest.fixture(scope="session")
def make_events(spark):
    def build(rows):
        """``rows``: (minutes back, plant_up, {tag: value}) of site 1."""
        data = [(1, minute(k), up, list(tags.items())) for k, up, tags in rows]
        return spark.createDataFrame(data, EVENT_DDL)

    return build


@pytest.fixture(scope="session")
def anchor(spark):
    return spark.createDataFrame([(1, T0)], "site_id int, anchor_ts timestamp")
