"""Job-level behaviour: daily run, idempotent snapshots, CSV dimension load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from citymarts.plans import jobs
from citymarts.session import new_scratch
from citymarts.sources import lake as lk
from citymarts.sources.fixture import geo_handbook, materialize_lake
from conftest import SF_SMOKE


def test_run_daily_builds_all_marts(spark):
    lake = materialize_lake(spark, SF_SMOKE)
    root = new_scratch(spark, "test-daily")
    ods = f"{root}/ods"
    # backfill history up to 2024-01-29, then let the daily run load 2024-01-30
    hist = spark.read.parquet(lake.ods).where(F.col("date") < F.lit(dt.date(2024, 1, 30)))
    hist.write.partitionBy("date", "event_type").parquet(ods)
    paths = jobs.Paths(lake.stg, ods, lake.geo, f"{root}/uic", f"{root}/eic", f"{root}/um")
    out = jobs.run_daily(spark, "2024-01-31", paths)
    assert out["increment"].endswith("date=2024-01-30")
    before = F.col("date") < F.lit(dt.date(2024, 1, 31))
    assert lk.scan_events(spark, ods).count() == spark.read.parquet(lake.ods).where(before).count()
    users = spark.read.parquet(out["users_in_cities"])
    assert users.columns == ["user_id", "act_city", "home_city", "travel_count", "travel_array",
                             "local_time"]
    senders = lk.scan_events(spark, ods).where("event_type = 'message'").select("event.message_from").distinct()
    assert users.count() == senders.count() == 16          # 15 users and the messages without a sender
    ev = spark.read.parquet(out["events_in_cities"])
    assert ev.count() == 25 and ev.select("zone_id").distinct().count() == 25
    assert spark.read.parquet(out["users_matches"]).columns == \
        ["user_left", "user_right", "processed_dttm", "zone_id", "local_time"]


def test_snapshot_rewrite_is_idempotent(spark):
    lake = materialize_lake(spark, SF_SMOKE)
    root = new_scratch(spark, "test-snap")
    p1 = jobs.build_events_in_cities(spark, "2024-01-31", lake.ods, lake.geo, root)
    first = spark.read.parquet(p1).collect()
    p2 = jobs.build_events_in_cities(spark, "2024-01-31", lake.ods, lake.geo, root)
    assert p1 == p2
    assert sorted(map(tuple, spark.read.parquet(p2).collect())) == sorted(map(tuple, first))


def test_as_of_ignores_later_history(spark):
    lake = materialize_lake(spark, SF_SMOKE)
    full = jobs.users_in_cities_mart(spark, "2024-01-10", lake.ods, lake.geo)
    asof = jobs.users_in_cities_mart(spark, "2024-01-10", lake.ods, lake.geo, as_of=True)
    assert asof.count() <= full.count()
    latest = asof.agg(F.max("local_time")).first()[0]
    assert latest is not None and latest < dt.datetime(2024, 1, 11)


def test_geo_handbook_from_csv(spark):
    root = new_scratch(spark, "test-csv")
    geo_handbook(spark, SF_SMOKE).coalesce(1).write.option("header", True).csv(f"{root}/csv")
    out = lk.geo_handbook_from_csv(spark, f"{root}/csv", f"{root}/pq")
    back = lk.read_geo_handbook(spark, out)
    assert back.schema == lk.GEO_SCHEMA
    assert sorted(map(tuple, back.collect())) == \
        sorted(map(tuple, geo_handbook(spark, SF_SMOKE).collect()))


def test_duplicate_zone_fails_and_names_may_repeat(spark):
    import pytest
    rows = [(1, "A", 0.0, 0.0, "UTC"), (2, "A", 1.0, 1.0, "UTC")]
    assert lk.validate_geo(spark.createDataFrame(rows, lk.GEO_SCHEMA)).count() == 2
    dup = spark.createDataFrame([rows[0], (1, "B", 1.0, 1.0, "UTC")], lk.GEO_SCHEMA)
    with pytest.raises(Exception, match="not unique"):
        lk.validate_geo(dup).collect()


def test_cli_builds_a_mart(spark):
    import os
    import subprocess
    import sys
    lake = materialize_lake(spark, SF_SMOKE)
    out = new_scratch(spark, "test-cli")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    state = new_scratch(spark, "test-cli-state")
    r = subprocess.run([sys.executable, "-m", "citymarts.plans.jobs", "events", "2024-01-31",
                        lake.ods, lake.geo, out, state], cwd=root, capture_output=True,
                       timeout=600)
    assert r.returncode == 0, r.stderr.decode()[-2000:]
    assert spark.read.parquet(f"{out}/date=2024-01-31").count() == 25
    assert spark.read.parquet(f"{state}/asof=2024-01-31").count() > 0


def test_first_seen_state_incremental_equals_full(spark):
    from citymarts.operators import citystats
    lake = materialize_lake(spark, SF_SMOKE)
    state = new_scratch(spark, "test-state")
    jobs.update_first_seen(spark, "2024-01-28", lake.ods, state)          # full build
    for day in range(29, 32):                                            # then daily steps
        inc = jobs.update_first_seen(spark, f"2024-01-{day}", lake.ods, state)
    full = citystats.first_seen(lk.scan_events(spark, lake.ods), "2024-01-31")
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0
    with_state = jobs.events_in_cities_mart(spark, "2024-01-31", lake.ods, lake.geo, state)
    without = jobs.events_in_cities_mart(spark, "2024-01-31", lake.ods, lake.geo)
    assert with_state.exceptAll(without).count() == 0 and without.exceptAll(with_state).count() == 0


def test_matches_states_incremental_equal_full(spark):
    from citymarts.operators import matches
    lake = materialize_lake(spark, "/root/testdata/sf0.01")
    state = new_scratch(spark, "test-contacts")
    jobs.update_contacts(spark, "2024-01-28", lake.ods, state)
    for day in range(29, 32):
        inc = jobs.update_contacts(spark, f"2024-01-{day}", lake.ods, state)
    history = lk.filter_history_before(lk.scan_events(spark, lake.ods), "2024-01-31")
    full = matches.contacted_unordered(history)
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0
    subs = new_scratch(spark, "test-subs")
    jobs.update_subscriptions(spark, "2024-01-28", lake.ods, subs)
    for day in range(29, 32):
        jobs.update_subscriptions(spark, f"2024-01-{day}", lake.ods, subs)
    a = jobs.users_matches_mart(spark, "2024-01-31", lake.ods, lake.geo, contacts_state=state,
                                subscriptions_state=subs)
    b = jobs.users_matches_mart(spark, "2024-01-31", lake.ods, lake.geo, as_of=True)
    assert a.count() > 500 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_events_mart_require_complete(spark):
    import pytest
    lake = materialize_lake(spark, SF_SMOKE)
    ok = jobs.events_in_cities_mart(spark, "2024-01-31", lake.ods, lake.geo, require_complete=True)
    assert ok.count() == 25
    with pytest.raises(FileNotFoundError, match="2023-12-31"):   # period starts before the data
        jobs.events_in_cities_mart(spark, "2024-01-30", lake.ods, lake.geo, require_complete=True)


def test_users_state_job_equals_mart(spark):
    lake = materialize_lake(spark, SF_SMOKE)
    state = new_scratch(spark, "test-users-job")
    jobs.update_users_state(spark, "2024-01-29", lake.ods, lake.geo, state)       # full build
    for day in range(30, 32):
        jobs.update_users_state(spark, f"2024-01-{day}", lake.ods, lake.geo, state)
    a = jobs.users_in_cities_mart(spark, "2024-01-31", lake.ods, lake.geo, state_root=state)
    b = jobs.users_in_cities_mart(spark, "2024-01-31", lake.ods, lake.geo, as_of=True)
    assert a.count() == 16
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_run_daily_with_states_equals_without(spark):
    lake = materialize_lake(spark, SF_SMOKE)
    outs = []
    for use_states in (False, True):
        root = new_scratch(spark, "test-daily-states")
        ods = f"{root}/ods"
        hist = spark.read.parquet(lake.ods).where(F.col("date") < F.lit(dt.date(2024, 1, 30)))
        hist.write.partitionBy("date", "event_type").parquet(ods)
        states = {k: f"{root}/{k}" for k in
                  ("users_state", "first_seen_state", "contacts_state", "subscriptions_state")}
        paths = jobs.Paths(lake.stg, ods, lake.geo, f"{root}/uic", f"{root}/eic", f"{root}/um",
                           **(states if use_states else {}))
        if use_states:      # yesterday's states, so the daily run takes the incremental step
            jobs.update_users_state(spark, "2024-01-30", ods, lake.geo, states["users_state"])
            jobs.update_first_seen(spark, "2024-01-30", ods, states["first_seen_state"])
            jobs.update_contacts(spark, "2024-01-30", ods, states["contacts_state"])
            jobs.update_subscriptions(spark, "2024-01-30", ods, states["subscriptions_state"])
        outs.append(jobs.run_daily(spark, "2024-01-31", paths))
    for mart in ("users_in_cities", "events_in_cities", "users_matches"):
        a, b = (spark.read.parquet(o[mart]) for o in outs)
        assert a.count() > 0 or mart == "users_matches"
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, mart
