"""Golden micro-tables for the semantics most easily got wrong (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from citymarts.functions.geo import haversine_km, with_nearest_city
from citymarts.operators import activity, citystats, matches
from citymarts.sources import lake as lk
from citymarts.session import new_scratch
from citymarts.sources.sinks import load_increment
from conftest import make_events, make_geo, ts

CITY = {"A": (0.0, 0.0), "B": (10.0, 10.0), "C": (20.0, 20.0)}


@pytest.fixture(scope="module")
def geo(spark):
    return make_geo(spark, [(1, "A", 0.0, 0.0, "UTC"), (2, "B", 10.0, 10.0, "Asia/Tokyo"),
                            (3, "C", 20.0, 20.0, "America/New_York")])


def _msg(user, t, city, eid=None, to=None):
    lat, lon = CITY[city] if city else (None, None)
    r = {"event_type": "message", "message_from": user, "message_to": to, "ts": t,
         "lat": lat, "lon": lon}
    if eid is not None:
        r["event_id"] = eid
    return r


# ------------------------------------------------------------ G-1 runs and travels

G1_CITIES = ["A", "A", "B", "B", "A", None, "C"]


@pytest.mark.parametrize("bucket", [1, 3600, 10 ** 9])
def test_g1_runs_and_travels(spark, geo, bucket):
    ev = make_events(spark, [_msg(7, ts("2024-01-01", t), c, eid=t)
                             for t, c in enumerate(G1_CITIES, start=1)])
    msgs = activity.messages_in_cities(ev, geo)
    runs = activity.city_runs(msgs.select("user_id", "event_id", "message_ts", "day", "city"),
                              bucket_seconds=bucket)
    got = {r["event_id"]: (r["next_city"], r["flag"], r["seq_label"]) for r in runs.collect()}
    assert got == {1: ("A", 0, 2), 2: ("B", 1, 2), 3: ("B", 0, 1), 4: ("A", 1, 1),
                   5: (None, 0, 0), 6: ("C", 0, 0), 7: (None, 0, 0)}
    mart = activity.users_in_cities(ev, geo, bucket_seconds=bucket).collect()
    assert len(mart) == 1
    row = mart[0]
    assert (row["act_city"], row["home_city"], row["travel_count"], row["travel_array"]) == \
        ("C", None, 2, ["A", "B"])


def test_g1_no_change_gives_nulls(spark, geo):
    ev = make_events(spark, [_msg(1, ts("2024-01-01", t), "A", eid=t) for t in range(3)])
    row = activity.users_in_cities(ev, geo).collect()[0]
    assert row["travel_count"] is None and row["travel_array"] is None


# ------------------------------------------------------------ G-2 home city

def _days(user, city, start, n, eid0, step_days=1):
    d0 = dt.date.fromisoformat(start)
    return [_msg(user, ts((d0 + dt.timedelta(days=i * step_days)).isoformat(), 3600), city,
                 eid=eid0 + i) for i in range(n)]


def _home(spark, geo, rows, bucket=3600):
    ev = make_events(spark, rows)
    return {r["user_id"]: r["home_city"] for r in activity.users_in_cities(
        ev, geo, bucket_seconds=bucket).collect()}


@pytest.mark.parametrize("bucket", [3600, 86400 * 7])
def test_g2_home_city(spark, geo, bucket):
    rows = (_days(1, "A", "2024-01-01", 28, 0) + _days(1, "B", "2024-02-01", 1, 100)
            + _days(2, "A", "2024-01-01", 27, 200) + _days(2, "B", "2024-02-01", 1, 300))
    assert _home(spark, geo, rows, bucket) == {1: "A", 2: None}


def test_g2_gap_does_not_break_a_run(spark, geo):
    rows = _days(1, "A", "2024-01-01", 14, 0) + _days(1, "A", "2024-03-01", 14, 100)
    assert _home(spark, geo, rows) == {1: "A"}


def test_g2_latest_of_two_long_runs(spark, geo):
    rows = (_days(1, "A", "2024-01-01", 28, 0) + _days(1, "B", "2024-02-01", 28, 100)
            + _days(1, "C", "2024-03-15", 2, 200))
    assert _home(spark, geo, rows) == {1: "B"}


# ------------------------------------------------------------ G-3 distance / nearest

def test_g3_distance(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 180.0), (None, 0.0, 0.0, 0.0),
         (float("nan"), 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert math.isclose(got[1], 20015.086796, abs_tol=1e-6)
    assert got[2] is None and got[3] is None


def test_g3_nearest_null_nan_and_ties(spark, geo):
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 3.0), (3, float("nan"), 1.0),
                                 (4, 19.0, 19.5)], "id int, lat double, lon double")
    got = {r["id"]: (r["n"]["zone_id"] if r["n"] else None)
           for r in with_nearest_city(pts, geo, out="n").collect()}
    assert got == {1: 1, 2: None, 3: None, 4: 3}
    tie = make_geo(spark, [(9, "Z9", 0.0, 1.0, "UTC"), (4, "Z4", 0.0, -1.0, "UTC")])
    p = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lat double, lon double")
    assert with_nearest_city(p, tie, out="n").collect()[0]["n"]["zone_id"] == 4
    empty = make_geo(spark, [])
    assert with_nearest_city(p, empty, out="n").collect()[0]["n"] is None


@pytest.mark.parametrize("n_cities", [60, 300])
def test_nearest_equals_brute_force(spark, n_cities):
    import random
    rnd = random.Random(7)
    cities = [(i, f"c{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180), "UTC")
              for i in range(n_cities)]
    g = make_geo(spark, cities)
    pts = spark.createDataFrame(
        [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(2000)],
        "id int, lat double, lon double")
    fast = with_nearest_city(pts, g, out="n").select("id", F.col("n.zone_id").alias("z"))
    d = haversine_km("p.lat", "p.lon", "g.lat", "g.lon")
    brute = (pts.alias("p").join(g.alias("g"), how="cross")      # test oracle only
             .groupBy("p.id").agg(F.min_by("g.zone_id", F.struct(d, F.col("g.zone_id")))
                                  .alias("z")))
    assert fast.exceptAll(brute).count() == 0 and brute.exceptAll(fast).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_nearest_clustered_cities_far_points(spark, monkeypatch, broadcast):
    import random
    from citymarts.functions import geo as G
    monkeypatch.setattr(G, "MAX_BROADCAST_INDEX_BYTES", 10 ** 9 if broadcast else 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rnd = random.Random(3)
    cities = [(i, f"k{i}", 48.0 + rnd.uniform(0, 0.5), 11.0 + rnd.uniform(0, 0.5), "UTC")
              for i in range(40)]
    g = make_geo(spark, cities)
    pts = spark.createDataFrame(
        [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(500)]
        + [(1000 + i, 48.0 + rnd.uniform(0, 0.5), 11.0 + rnd.uniform(0, 0.5)) for i in range(500)],
        "id int, lat double, lon double")
    fast = G.with_nearest_city(pts, g, out="n", cell_km=400.0)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin [_nc_x" in plan) == broadcast
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("SortMergeJoin [_nc_x" in plan) == (not broadcast)
    fast = fast.select("id", F.col("n.zone_id").alias("z"))
    d = haversine_km("p.lat", "p.lon", "g.lat", "g.lon")
    brute = (pts.alias("p").join(g.alias("g"), how="cross")      # test oracle only
             .groupBy("p.id").agg(F.min_by("g.zone_id", F.struct(d, F.col("g.zone_id")))
                                  .alias("z")))
    assert fast.exceptAll(brute).count() == 0 and brute.exceptAll(fast).count() == 0


# ------------------------------------------------------------ G-4 period

def test_g4_period(spark):
    days = ["2023-12-31", "2024-01-01", "2024-01-07", "2024-01-08"]
    ev = make_events(spark, [{"event_type": "reaction", "ts": ts(d, 60), "event_id": i}
                             for i, d in enumerate(days)])
    got = sorted(r["date"].isoformat() for r in lk.scan_date_range(ev, "2024-01-08", 7).collect())
    assert got == ["2024-01-01", "2024-01-07"]


def test_g4_require_complete_reports_missing_days(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-04"]
    ev = make_events(spark, [{"event_type": "message", "message_from": 1, "ts": ts(d, 60),
                              "event_id": i} for i, d in enumerate(days)])
    assert lk.scan_date_range(ev, "2024-01-03", 2, require_complete=True).count() == 2
    with pytest.raises(FileNotFoundError, match="2024-01-03"):
        lk.scan_message_range(ev, "2024-01-05", 4, require_complete=True)


# ------------------------------------------------------------ G-5 new users

def test_g5_new_users(spark, geo):
    rows = [
        # history (before the 3-day period of run 2024-01-10)
        _msg(1, ts("2024-01-02"), "A", eid=1, to=50),           # 1 sent before
        _msg(60, ts("2024-01-02"), "A", eid=2, to=2),           # 2 received before
        {"event_type": "subscription", "user": "3", "channel": 1, "ts": ts("2024-01-03"),
         "event_id": 3, "lat": 0.0, "lon": 0.0},                # 3 subscribed before
        {"event_type": "reaction", "ts": ts("2024-01-03"), "event_id": 4},   # reactions only
        # period 2024-01-07 .. 2024-01-09
        _msg(1, ts("2024-01-07", 10), "B", eid=10),
        _msg(2, ts("2024-01-07", 20), "B", eid=11),
        _msg(3, ts("2024-01-07", 30), "B", eid=12),
        _msg(4, ts("2024-01-08", 40), "C", eid=13),             # new, first at C
        _msg(4, ts("2024-01-09", 50), "B", eid=14),
        _msg(5, ts("2024-01-09", 60), "B", eid=15),             # new, at B
    ]
    ev = make_events(spark, rows)
    got = {r["zone_id"]: r["p_user"] for r in
           citystats.new_users_by_zone(ev, geo, "2024-01-10", {"p": 3}).collect()}
    assert got == {3: 1, 2: 1}


# ------------------------------------------------------------ G-6 events mart

def test_g6_events_mart(spark, geo):
    rows = [_msg(1, ts("2024-12-25", 1), "A", eid=1),
            {"event_type": "subscription", "user": "1", "channel": 5, "ts": ts("2024-12-26"),
             "lat": 0.0, "lon": 0.0, "event_id": 2},
            {"event_type": "message", "message_from": 2, "ts": ts("2024-12-27"), "event_id": 3}]
    ev = make_events(spark, rows)
    mart = citystats.events_in_cities(ev, geo, "2024-12-30")
    assert dict(mart.dtypes)["week_reaction"] == "bigint"
    got = {r["zone_id"]: r.asDict() for r in mart.collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["month"] == 12 and got[1]["week"] == 1
    assert (got[1]["week_message"], got[1]["week_subscription"], got[1]["week_reaction"]) == (1, 1, 0)
    assert got[1]["week_user"] == 1      # user 2's message has no coordinates: no zone
    assert all(v == 0 for k, v in got[2].items() if k.startswith(("week_", "month_")))


def test_events_single_pass_equals_two_pivots(spark):
    from conftest import SF_CHECK
    from citymarts.sources.fixture import geo_handbook, social_events
    ev, g = social_events(spark, SF_CHECK), geo_handbook(spark, SF_CHECK)
    one = citystats.event_counts(ev, g, "2024-01-20", {"week": 7, "month": 30})
    for prefix, depth in (("week", 7), ("month", 30)):
        piv = citystats.events_pivot_by_zone(ev, g, "2024-01-20", depth)
        piv = piv.select("zone_id", *[F.coalesce(F.col(t), F.lit(0)).alias(f"{prefix}_{t}")
                                      for t in citystats.EVENT_TYPES])
        mine = one.select("zone_id", *[f"{prefix}_{t}" for t in citystats.EVENT_TYPES])
        assert mine.exceptAll(piv).count() == 0 and piv.exceptAll(mine).count() == 0


# ------------------------------------------------------------ G-7 pairs

def _sub(user, lat, lon, ch, t="2024-01-05", eid=None):
    return {"event_type": "subscription", "user": str(user), "channel": ch, "ts": ts(t),
            "lat": lat, "lon": lon, "event_id": eid if eid is not None else user * 100 + ch}


def _pairs(spark, geo, rows):
    ev = make_events(spark, rows)
    return sorted((r["user_left"], r["user_right"], r["zone_id"])
                  for r in matches.users_matches(ev, geo, "2024-01-31").collect())


def test_g7_pairs(spark, geo):
    step = 0.002 * 4                     # 0.89 km of latitude
    far = 0.002 * 5                      # 1.11 km
    assert _pairs(spark, geo, [_sub(1, 0.0, 0.0, 1), _sub(2, step, 0.0, 1)]) == \
        [(1, 2, 1), (2, 1, 1)]
    assert _pairs(spark, geo, [_sub(1, 0.0, 0.0, 1), _sub(2, far, 0.0, 1)]) == []
    assert _pairs(spark, geo, [_sub(1, 0.0, 0.0, 1), _sub(2, step, 0.0, 2)]) == []
    assert _pairs(spark, geo, [_sub(1, 0.0, 0.0, 1), _sub(2, None, None, 1)]) == []
    msg = {"event_type": "message", "message_from": 2, "message_to": 1, "ts": ts("2024-01-01"),
           "event_id": 999}
    assert _pairs(spark, geo, [_sub(1, 0.0, 0.0, 1), _sub(2, step, 0.0, 1), msg]) == []
    null_to = dict(msg, message_to=None)
    assert len(_pairs(spark, geo, [_sub(1, 0.0, 0.0, 1), _sub(2, step, 0.0, 1), null_to])) == 2
    # across the antimeridian and at the pole
    assert len(_pairs(spark, geo, [_sub(1, 10.0, 179.999, 1), _sub(2, 10.0, -179.999, 1)])) == 2
    assert len(_pairs(spark, geo, [_sub(1, 89.999, 0.0, 1), _sub(2, 89.999, 180.0, 1)])) == 2


def test_pairs_shared_channels_counted_once(spark, geo):
    rows = [_sub(1, 0.0, 0.0, c) for c in (1, 2, 3)] + [_sub(2, 0.001, 0.0, c) for c in (1, 2, 3)]
    assert _pairs(spark, geo, rows) == [(1, 2, 1), (2, 1, 1)]


def test_grid_join_equals_brute_force(spark):
    import random
    rnd = random.Random(11)
    centres = [(89.995, 0.0), (-89.995, 50.0), (10.0, 179.995), (10.0, -179.995), (45.0, 7.0)]
    prof = []
    for u in range(400):
        la, lo = centres[u % len(centres)]
        lat = max(-90.0, min(90.0, la + rnd.uniform(-0.01, 0.01)))
        lon = lo + rnd.uniform(-0.01, 0.01)
        lon = (lon + 180.0) % 360.0 - 180.0
        prof.append((u, [rnd.randint(0, 3)], lat, lon, 1, None))
    p = spark.createDataFrame(prof, "user_id bigint, sub_channels_array array<bigint>, "
                                    "last_message_lat double, last_message_lon double, "
                                    "city_id int, local_time timestamp")
    fast = matches.nearby_pairs_unordered(p, 1.0).select("a", "b")
    d = haversine_km("x.last_message_lat", "x.last_message_lon",
                     "y.last_message_lat", "y.last_message_lon")
    brute = (p.alias("x").join(p.alias("y"), F.col("x.user_id") < F.col("y.user_id"))
             .where((d < 1.0) & F.arrays_overlap("x.sub_channels_array", "y.sub_channels_array"))
             .select(F.col("x.user_id").alias("a"), F.col("y.user_id").alias("b")))
    assert brute.count() > 100
    assert fast.exceptAll(brute).count() == 0 and brute.exceptAll(fast).count() == 0


# ------------------------------------------------------------ G-8 reload

def test_g8_reload_is_a_static_overwrite(spark):
    root = new_scratch(spark, "test-reload")
    stg, ods = f"{root}/stg", f"{root}/ods"
    day = "2024-01-09"
    first = make_events(spark, [
        {"event_type": "message", "message_from": 1, "ts": ts(day), "event_id": 1},
        {"event_type": "reaction", "ts": ts(day), "event_id": 2}])
    first.write.mode("overwrite").partitionBy("date").parquet(stg)
    load_increment(spark, "2024-01-10", stg, ods)
    assert sorted(r["event_type"] for r in spark.read.parquet(ods).collect()) == \
        ["message", "reaction"]
    second = make_events(spark, [
        {"event_type": "message", "message_from": 1, "ts": ts(day), "event_id": 1}])
    second.write.mode("overwrite").partitionBy("date").parquet(stg)
    load_increment(spark, "2024-01-10", stg, ods)
    back = spark.read.parquet(ods).collect()
    assert [r["event_type"] for r in back] == ["message"]
    assert back[0]["date"] == dt.date(2024, 1, 9)


def test_location_from_message(spark, geo):
    step = 0.002 * 4
    rows = [_sub(1, 0.0, 0.0, 1), _sub(2, 5.0, 5.0, 1),          # far apart by subscription
            {"event_type": "message", "message_from": 2, "message_to": 77, "ts": ts("2024-01-06"),
             "lat": step, "lon": 0.0, "event_id": 500}]          # but 2 last wrote near 1
    ev = make_events(spark, rows)
    by_sub = matches.users_matches(ev, geo, "2024-01-31").count()
    by_msg = matches.users_matches(ev, geo, "2024-01-31", location_from="message")
    assert by_sub == 0
    assert sorted((r["user_left"], r["user_right"]) for r in by_msg.collect()) == []  # 1 sent nothing
    rows.append({"event_type": "message", "message_from": 1, "message_to": 78,
                 "ts": ts("2024-01-06"), "lat": 0.0, "lon": 0.0, "event_id": 501})
    ev = make_events(spark, rows)
    by_msg = matches.users_matches(ev, geo, "2024-01-31", location_from="message")
    assert sorted((r["user_left"], r["user_right"]) for r in by_msg.collect()) == [(1, 2), (2, 1)]


def test_null_sender_forms_one_group(spark, geo):
    rows = [_msg(None, ts("2024-01-01", 1), "A", eid=1), _msg(None, ts("2024-01-01", 2), "B", eid=2),
            _msg(5, ts("2024-01-01", 3), "C", eid=3)]
    got = {r["user_id"]: (r["act_city"], r["travel_count"])
           for r in activity.users_in_cities(make_events(spark, rows), geo).collect()}
    # the NULL sender keeps a row; like any left join on user_id, its travel
    # metrics cannot match a NULL key and stay NULL
    assert got == {None: ("B", None), 5: ("C", None)}


def test_nan_coordinates_give_null_city(spark, geo):
    rows = [_msg(1, ts("2024-01-01", 1), "A", eid=1),
            dict(_msg(1, ts("2024-01-01", 2), "A", eid=2), lat=float("nan")),
            _msg(1, ts("2024-01-01", 3), "A", eid=3)]
    msgs = activity.messages_in_cities(make_events(spark, rows), geo)
    assert {r["event_id"]: r["city"] for r in msgs.collect()} == {1: "A", 2: None, 3: "A"}
    row = activity.users_in_cities(make_events(spark, rows), geo).collect()[0]
    assert (row["act_city"], row["travel_count"]) == ("A", None)


def test_more_cities_than_one_array_of_them(spark):
    import random
    rnd = random.Random(9)
    g = make_geo(spark, [(i, f"c{i % 7000}", rnd.uniform(-90, 90), rnd.uniform(-180, 180), "UTC") for i in range(12_000)])
    pts = spark.createDataFrame([(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(60)] + [(99, None, 1.0)],
                                "id int, lat double, lon double")
    fast = {r["id"]: r["z"] for r in with_nearest_city(pts, g, out="n").select("id", F.col("n.zone_id").alias("z")).collect()}
    d = haversine_km("p.lat", "p.lon", "g.lat", "g.lon")
    brute = (pts.alias("p").join(F.broadcast(g.alias("g")), how="cross")      # test oracle only
             .groupBy("p.id").agg(F.min_by("g.zone_id", F.struct(d, F.col("g.zone_id"))).alias("z")))
    assert fast.pop(99) is None
    assert fast == {r["id"]: r["z"] for r in brute.collect() if r["id"] != 99}
