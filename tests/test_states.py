"""States over a lake that changes: what is read, what is continued, what is published.

Days that must not be read are overwritten with bytes that no reader accepts;
the lake's days are then passed as they were before.
"""

from __future__ import annotations

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from citymarts.operators import activity, citystats, matches
from citymarts.plans import jobs, states
from citymarts.session import child_names, materialized, move, new_scratch
from citymarts.sources import lake as lk
from citymarts.sources.sinks import load_increment, publish
from conftest import make_events, make_geo, ts

GEO = [(i, f"C{i}", 10.0 * i, 10.0 * i, "UTC") for i in range(5)]
FIRST = dt.date(2024, 3, 1)


def day(i):
    return FIRST + dt.timedelta(days=i)


class Lake:
    """A lake of ``n`` days with a city dimension, written by day."""

    def __init__(self, spark, rows):
        self.spark, self.root = spark, new_scratch(spark, "test-lake")
        self.ods, self.geo = f"{self.root}/ods", f"{self.root}/geo"
        make_geo(spark, GEO).write.parquet(self.geo)
        self.write(rows)

    def write(self, rows):
        (make_events(self.spark, rows).coalesce(1).write.mode("append").partitionBy("date", "event_type").parquet(self.ods))

    def reload(self, rows, d):
        stg = new_scratch(self.spark, "test-stg")
        make_events(self.spark, [r for r in rows if r["date"] == d]).coalesce(1).write.partitionBy("date").parquet(stg)
        load_increment(self.spark, d + dt.timedelta(days=1), stg, self.ods)

    def spoil(self, *days):
        for d in days:
            for f in glob.glob(f"{self.ods}/date={d.isoformat()}/**/*.parquet", recursive=True):
                with open(f, "wb") as out:
                    out.write(b"not a parquet file")

    def users(self, i, **kw):
        return jobs.update_users_state(self.spark, day(i), self.ods, self.geo, f"{self.root}/users", **kw)


def messages(n_days, seed=0, users=6, per_day=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n_days):
        for u in range(users):
            for k in range(per_day):
                c = rng.randrange(5)
                rows.append({"event_type": "message", "event_id": len(rows), "message_from": u, "message_to": rng.randrange(users),
                             "ts": ts(day(i).isoformat(), 100 * k + u), "date": day(i), "lat": 10.0 * c, "lon": 10.0 * c})
    return rows


def mart(state):
    return sorted(map(str, activity.users_in_cities_from_state(state).collect()))


def expected(spark, rows):
    return sorted(map(str, activity.users_in_cities(make_events(spark, rows), make_geo(spark, GEO)).collect()))


def test_lake_days_notice_changes_only(spark):
    rows = messages(4)
    lake = Lake(spark, rows)
    before = states.lake_days(spark, lake.ods)
    assert sorted(before) == [day(i) for i in range(4)]
    lake.reload(rows, day(2))
    after = states.lake_days(spark, lake.ods)
    assert [d for d in before if before[d] != after[d]] == [day(2)]


def test_a_day_without_late_rows_reads_that_day_alone(spark):
    rows = messages(5)
    lake = Lake(spark, rows)
    lake.users(4)
    days = states.lake_days(spark, lake.ods)
    lake.spoil(*[day(i) for i in range(4)])
    assert mart(lake.users(5, days=days)) == expected(spark, rows)
    with pytest.raises(Exception, match="parquet"):      # a spoiled day would be noticed
        lk.scan_events(spark, lake.ods, [day(1)]).count()


def test_late_rows_are_replayed_from_their_first_day(spark):
    rows = messages(8)
    # one user's message of day 5 and another's of day 4 arrive on day 7
    for i, u in ((5, 1), (4, 2)):
        rows.append({"event_type": "message", "event_id": len(rows), "message_from": u, "message_to": 0,
                     "ts": ts(day(i).isoformat(), 50), "date": day(7), "lat": 0.0, "lon": 0.0})
    lake = Lake(spark, rows)
    for i in (4, 7):
        lake.users(i)
    days = states.lake_days(spark, lake.ods)
    lake.spoil(*[day(i) for i in range(4)])
    assert mart(lake.users(8, days=days)) == expected(spark, rows)


def test_rows_without_time_and_rows_later_than_their_states_rebuild_their_users(spark):
    rows = messages(6)
    for u, when in ((0, None), (3, ts(day(0).isoformat(), 1)), (None, None), (None, ts(day(3).isoformat(), 1)), (9, None)):
        rows.append({"event_type": "message", "event_id": len(rows), "message_from": u, "message_to": 0, "ts": when,
                     "date": day(5), "lat": 20.0, "lon": 20.0})
    # arrived before its time: the state of day 3 holds a message of day 4
    rows.append({"event_type": "message", "event_id": len(rows), "message_from": 4, "message_to": 0, "ts": ts(day(4).isoformat(), 10),
                 "date": day(2), "lat": 30.0, "lon": 30.0})
    rows.append({"event_type": "message", "event_id": len(rows), "message_from": 4, "message_to": 0, "ts": ts(day(3).isoformat(), 5),
                 "date": day(5), "lat": 0.0, "lon": 0.0})
    lake = Lake(spark, rows)
    for i in (3, 5, 6):
        state = lake.users(i)
    assert mart(state) == expected(spark, rows)


def test_reloaded_earlier_day_and_lost_runs(spark):
    rows = messages(9)
    part = [r for r in rows if r["date"] != day(4) or r["event_id"] % 3]
    lake = Lake(spark, part)
    lake.users(4)
    lake.users(5)
    lake.users(9)                                    # runs 6 to 8 were lost
    assert mart(lake.users(9)) == expected(spark, part)
    lake.reload(rows, day(4))
    days = states.lake_days(spark, lake.ods)
    lake.spoil(*[day(i) for i in range(4)])          # the state of day 4 is continued
    assert mart(lake.users(9, days=days)) == expected(spark, rows)
    assert states.newest(spark, f"{lake.root}/users", day(8), days, states_made_with(lake)) == day(4)


def states_made_with(lake):
    from citymarts.functions.geo import fingerprint
    return {"geo": fingerprint(lk.read_geo_handbook(lake.spark, lake.geo))}


def test_other_handbook_or_removed_day_starts_anew(spark):
    rows = messages(4)
    lake = Lake(spark, rows)
    lake.users(4)
    make_geo(spark, [(z, f"new {c}", *rest) for z, c, *rest in GEO]).write.mode("overwrite").parquet(lake.geo)
    assert all("new" in r.act_city for r in activity.users_in_cities_from_state(lake.users(4)).collect())
    other = Lake(spark, rows)
    other.users(3)
    days = {d: s for d, s in states.lake_days(spark, other.ods).items() if d != day(0)}
    assert mart(other.users(4, days=days)) == expected(spark, [r for r in rows if r["date"] != day(0)])


def test_publish_keeps_the_former_table_until_the_new_one_is_whole(spark):
    root = new_scratch(spark, "test-publish")
    path = f"{root}/mart/date=2024-03-01"
    publish(spark.range(5), path, {"_note": "first"})
    bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(bad, path)
    assert spark.read.parquet(path).count() == 5 and spark.read.parquet(f"{root}/mart").count() == 5
    # killed between the two renames: the former table stepped aside and the new one never came
    move(spark, path, f"{root}/mart/_old-date-2024-03-01-0")
    publish(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7
    assert child_names(spark, f"{root}/mart") == ["date=2024-03-01"]


# ---------------------------------------------------------------- logs

def test_logs_write_new_rows_only_and_are_written_together_once(spark, monkeypatch):
    monkeypatch.setattr(states, "MAX_PARTS", 3)
    rows = walk(8, seed=5)
    lake = Lake(spark, rows)
    root = f"{lake.root}/contacts"
    full = lambda i: {(r.lo, r.hi) for r in matches.contacted_unordered(
        make_events(spark, rows).where(F.col("date") < F.lit(day(i)))).collect()}
    written = []
    for i in range(2, 8):
        got = [(r.lo, r.hi) for r in jobs.update_contacts(spark, day(i), lake.ods, root).collect()]
        assert len(got) == len(set(got)) and set(got) == full(i)
        written.append(spark.read.parquet(states.dated(root, day(i))).count())
    new = [len(full(i) - full(i - 1)) for i in range(2, 8)]
    assert written[:3] == [len(full(2)), *new[1:3]] and written[3] == len(full(5)) and written[4:] == new[4:]
    # a part that was made anew no longer belongs to the states that named it
    jobs.update_contacts(spark, day(5), lake.ods, root, rebuild=True)
    assert {(r.lo, r.hi) for r in jobs.update_contacts(spark, day(8), lake.ods, root).collect()} == full(8)
    again = jobs.update_contacts(spark, day(7), lake.ods, root)
    assert again.count() == len(full(7)) == again.distinct().count()


# ---------------------------------------------------------------- pairs

def walk(n_days, seed=0, users=40):
    """Users subscribe, move a little or far, join channels and write to each other; one day is nearly quiet."""
    rng = random.Random(seed)
    rows = []
    for i in range(n_days):
        for u in rng.sample(range(users), 3 if i == 3 else 15):
            lat, lon = rng.choice([0.0, 10.0]) + rng.random() * 0.02, 20 + rng.random() * 0.02
            rows.append({"event_type": "subscription", "event_id": len(rows), "user": rng.choice([str(u), f"0{u}"]),
                         "channel": rng.choice([1, 1, 2, 3, None]), "ts": ts(day(i).isoformat(), u) if rng.random() < 0.95 else None,
                         "date": day(i), "lat": lat if rng.random() < 0.95 else None, "lon": lon})
        for _ in range(10):
            rows.append({"event_type": "message", "event_id": len(rows), "message_from": rng.randrange(users),
                         "message_to": rng.randrange(users), "ts": ts(day(i).isoformat(), 7), "date": day(i), "lat": 1.0, "lon": 1.0})
    return rows


def match_states(lake):
    return {f"{n}_state": f"{lake.root}/{n}" for n in ("contacts", "subscriptions", "pairs")}


def test_pairs_day_by_day_equal_the_full_mart(spark):
    rows = walk(6)
    lake = Lake(spark, rows)
    for i in range(3, 7):
        got = jobs.users_matches_mart(spark, day(i), lake.ods, lake.geo, **match_states(lake))
        want = jobs.users_matches_mart(spark, day(i), lake.ods, lake.geo, as_of=True)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() > 20


def test_pairs_after_a_reload_and_with_spoiled_history(spark):
    rows = walk(6, seed=1)
    lake = Lake(spark, [r for r in rows if r["date"] != day(3) or r["event_id"] % 2])
    for i in (3, 4, 6):
        jobs.users_matches_mart(spark, day(i), lake.ods, lake.geo, **match_states(lake)).count()
    lake.reload(rows, day(3))
    want = sorted(map(str, jobs.users_matches_mart(spark, day(6), lake.ods, lake.geo, as_of=True).collect()))
    days = states.lake_days(spark, lake.ods)
    lake.spoil(*[day(i) for i in range(3)])
    args = {k.replace("pairs_state", "pairs_root"): v for k, v in match_states(lake).items()}
    pairs = jobs.update_pairs(spark, day(6), lake.ods, args["pairs_root"], args["contacts_state"], args["subscriptions_state"], days=days)
    subs = spark.read.parquet(states.dated(args["subscriptions_state"], day(6)))
    profile = matches.subscriber_profile(None, make_geo(spark, GEO), state=subs)
    assert sorted(map(str, matches.users_matches_from_pairs(pairs, profile, day(6)).collect())) == want


def test_only_changed_users_meet_again(spark):
    rows = walk(5, seed=2)
    ev = make_events(spark, rows)
    before, after = (matches.positions(matches.subscription_state(ev.where(F.col("date") < F.lit(day(i))))) for i in (3, 4))
    new = matches.subscription_state(ev.where(F.col("date") == F.lit(day(3))))
    changed = {r.user_id for r in matches.changed_positions(before, after, new).collect()}
    old = {r.user_id: (r[1], r[2], r[3]) for r in before.collect()}
    assert changed == {r.user_id for r in after.collect() if old.get(r.user_id) != (r[1], r[2], r[3])}
    assert 0 < len(changed) <= 3


@pytest.mark.parametrize("hot", [3_000, 4])
def test_delta_join_equals_brute_force(spark, hot):
    state = matches.subscription_state(make_events(spark, walk(6, seed=3, users=80)))
    profile = materialized(matches.positions(state), "test-profile")
    every = {(r.a, r.b): round(r.distance_km, 9) for r in matches.near_pairs(profile, 1.0, hot).collect()}
    some = profile.where("user_id % 3 = 0")
    got = matches.near_pairs_of(some, profile, 1.0, hot).collect()
    assert {(r.a, r.b): round(r.distance_km, 9) for r in got} == {p: d for p, d in every.items() if p[0] % 3 == 0 or p[1] % 3 == 0}
    assert len(got) == len({(r.a, r.b) for r in got}) > 20


# ---------------------------------------------------------------- rollups

def test_rollups_read_one_day_a_run(spark):
    rows = walk(6, seed=4) + [r | {"event_id": 10_000 + r["event_id"]} for r in messages(6)]
    rows.append({"event_type": "message", "event_id": 99_999, "message_from": 77, "message_to": 1, "ts": ts(day(1).isoformat(), 5),
                 "date": day(5), "lat": 0.0, "lon": 0.0})                       # a late row counts on the day of its partition
    lake = Lake(spark, rows)
    args = dict(state_root=f"{lake.root}/seen", rollups=f"{lake.root}/rollups")
    for i in (4, 5):
        jobs.build_events_in_cities(spark, day(i), lake.ods, lake.geo, f"{lake.root}/mart", **args)
    want = sorted(map(str, jobs.events_in_cities_mart(spark, day(6), lake.ods, lake.geo).collect()))
    days = states.lake_days(spark, lake.ods)
    lake.spoil(*[day(i) for i in range(5)])
    counts, firsts = jobs.update_rollups(spark, day(6), lake.ods, lake.geo, args["rollups"], days)
    seen = jobs.update_first_seen(spark, day(6), lake.ods, args["state_root"], days=days)
    geo = make_geo(spark, GEO)
    got = citystats.events_in_cities(make_events(spark, []), geo, day(6), seen, (counts, firsts))
    assert sorted(map(str, got.collect())) == want


def test_rollups_of_changed_days_and_handbooks(spark):
    rows = messages(4)
    lake = Lake(spark, [r for r in rows if r["event_id"] % 5 or r["date"] != day(1)])
    root = f"{lake.root}/rollups"
    total = lambda: {(r.date, r.zone_id): r.n for r in jobs.update_rollups(spark, day(4), lake.ods, lake.geo, root)[0].collect()}
    full = {(r.date, r.zone_id): r.n for r in citystats.day_counts(make_events(spark, rows), make_geo(spark, GEO)).collect()}
    assert total() != full
    lake.reload(rows, day(1))
    assert total() == full
    assert len(child_names(spark, f"{root}/counts")) == 2
    make_geo(spark, [(z + 100, *rest) for z, *rest in GEO]).write.mode("overwrite").parquet(lake.geo)
    assert total() == {(d, z + 100): n for (d, z), n in full.items()}
    empty = jobs.update_rollups(spark, "2020-01-01", lake.ods, lake.geo, f"{root}-none")
    assert [t.count() for t in empty] == [0, 0]
