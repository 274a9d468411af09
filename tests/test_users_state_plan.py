"""The users state: messages are shuffled once for their runs, and late users go through the same advance as the others."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from citymarts.operators import activity
from citymarts.plans import jobs
from citymarts.session import materialized
from conftest import make_events, make_geo, ts

CITIES = {"A": (0.0, 0.0), "B": (10.0, 10.0), "C": (20.0, 20.0)}


def _row(i, user, city, day, seconds=0, untimed=False):
    lat, lon = CITIES[city]
    return {"event_type": "message", "message_from": user, "event_id": i, "date": day, "lat": lat, "lon": lon,
            "ts": None if untimed else ts(day, seconds)}


# user 1 is on time, 2 has a late row, 3 one without a time, 4 one older than the earlier state, NULL is on time
OLD = [_row(i, u, c, f"2024-01-0{d}") for i, (u, c, d) in enumerate(
    [(1, "A", 1), (1, "B", 4), (2, "A", 1), (2, "B", 5), (3, "A", 2), (3, "B", 5), (4, "B", 3), (4, "A", 5), (None, "A", 3)])]
NEW = [_row(20, 1, "C", "2024-01-06"), _row(21, 2, "C", "2024-01-04"), _row(22, 3, "C", "2024-01-06", untimed=True),
       _row(23, 4, "C", "2024-01-02"), _row(24, None, "B", "2024-01-06")]


def test_messages_are_shuffled_once_and_no_branch_repeats_the_advance(spark):
    geo = make_geo(spark, [(k, c, *pos, "UTC") for k, (c, pos) in enumerate(CITIES.items())])
    messages = lambda rows: activity.messages_in_cities(make_events(spark, rows), geo)
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM")
    first = activity.advance_users_state(None, messages(OLD))
    assert shuffles(first) == 2                     # those of messages and summaries are the same, so one is reused

    earlier = [r for r in OLD if r["date"] < "2024-01-04"]
    former = materialized(activity.advance_users_state(None, messages(earlier)), "state")
    since = [r for r in [*OLD, *NEW] if r not in earlier]
    located = lambda days=None: messages([*OLD, *NEW] if days is None else since)
    state = jobs.advanced_users(materialized(first, "state"), messages(NEW), lambda day: (former, [dt.date(2024, 1, 4)]), located)
    assert shuffles(state) == 2
    cols = ["user_id", "act_city", "home_city", "travel_count", "travel_array", "local_time"]
    rows = lambda df: sorted(df.select(*cols).collect(), key=lambda r: str(r.user_id))
    assert rows(activity.users_in_cities_from_state(state)) == rows(activity.users_in_cities(make_events(spark, [*OLD, *NEW]), geo))
    assert state.where(F.col("user_id") == 2).first().travels[0].city == "A"
