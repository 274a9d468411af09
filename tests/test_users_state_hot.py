"""The users state: only users with very many messages are spread over tasks; one shuffle by user serves all others."""

from __future__ import annotations

import random

from citymarts.operators import activity
from citymarts.session import materialized
from conftest import make_events, make_geo, ts

CITIES = {"A": (0.0, 0.0), "B": (10.0, 10.0), "C": (20.0, 20.0)}
COLS = ["user_id", "act_city", "home_city", "travel_count", "travel_array", "local_time"]


def _rows():
    """Users 1 and NULL have 90 messages each, 2 to 6 have 20; equal times, unknown places and no times occur."""
    rnd, rows = random.Random(3), []
    for u, n in [(1, 90), (None, 90), *[(u, 20) for u in range(2, 7)]]:
        for k in range(n):
            city = rnd.choice("AAABC")
            lat, lon = CITIES[city] if rnd.random() > 0.1 else (None, None)
            when = ts("2024-01-01", 86400 * (k * 30 // n) + 3600 * rnd.randrange(3)) if k % 17 else None
            rows.append({"event_type": "message", "message_from": u, "event_id": len(rows), "ts": when,
                         "date": f"2024-01-{1 + k * 30 // n:02d}", "lat": lat, "lon": lon})
    return rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read(df):
    return sorted(df.select(*COLS).collect(), key=lambda r: str(r.user_id))


def test_users_are_labelled_and_aggregated_after_one_shuffle(spark):
    geo = make_geo(spark, [(k, c, *pos, "UTC") for k, (c, pos) in enumerate(CITIES.items())])
    events = materialized(make_events(spark, _rows()), "events")
    sent = activity.sent_messages(events)
    want = _read(activity.users_in_cities(events, geo))
    hot = activity.hot_users(sent, 50)
    assert {r.user_id for r in hot.collect()} == {1, None}
    for users in (hot, activity.hot_users(sent)):       # some are hot, none is
        state = materialized(activity.advance_users_state(None, activity.located_messages(sent, geo), hot=users), "state")
        assert _read(activity.users_in_cities_from_state(state)) == want
    none = activity.advance_users_state(None, activity.located_messages(sent, geo), hot=activity.hot_users(sent))
    plan = _plan(none)
    assert "REPARTITION_BY_NUM" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_step_with_hot_users_equals_the_mart(spark, monkeypatch):
    monkeypatch.setattr(activity, "HOT_USER_MESSAGES", 50)
    geo = make_geo(spark, [(k, c, *pos, "UTC") for k, (c, pos) in enumerate(CITIES.items())])
    events = materialized(make_events(spark, _rows()), "events")
    timed = activity.sent_messages(events.where("event.message_ts is not null"))
    late = "message_ts >= '2024-01-04'"
    first = activity.located_messages(timed.where(f"not {late}"), geo)
    state = materialized(activity.advance_users_state(None, first, hot=activity.hot_users(timed)), "state")
    new = timed.where(late)
    state = activity.advance_users_state(state, activity.located_messages(new, geo), hot=activity.hot_users(new))
    want = activity.users_in_cities(events.where("event.message_ts is not null"), geo)
    assert _read(activity.users_in_cities_from_state(state)) == _read(want)
