from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from citymarts.session import build_session  # noqa: E402
from citymarts.sources.lake import GEO_SCHEMA, ODS_SCHEMA  # noqa: E402

SF_CHECK = "/root/testdata/sf0.01"
SF_SMOKE = "/root/testdata/sf0.001"
UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "citymarts-tests", shuffle_partitions=8)
    yield s


def ts(day: str, seconds: int = 0) -> dt.datetime:
    d = dt.datetime.fromisoformat(day).replace(tzinfo=UTC)
    return d + dt.timedelta(seconds=seconds)


def make_events(spark, rows: list[dict]):
    """Event-log rows in the ODS schema; ``date`` defaults to the UTC day of ``ts``."""
    data = []
    for i, r in enumerate(rows):
        t = r.get("ts")
        day = r.get("date") or (t.astimezone(UTC).date() if t else None)
        if isinstance(day, str):
            day = dt.date.fromisoformat(day)
        data.append((r.get("event_id", i),
                     (r.get("message_from"), r.get("message_to"), t, r.get("user"),
                      r.get("channel")),
                     r.get("lat"), r.get("lon"), day, r["event_type"]))
    return spark.createDataFrame(data, ODS_SCHEMA)


def make_geo(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, GEO_SCHEMA)
