"""Physical-plan properties: native expressions only, no pair products, pruned scans."""

from __future__ import annotations

import pytest

from citymarts.operators import activity, citystats, matches
from citymarts.plans.catalog import QUERIES, RUN_DATE
from citymarts.sources import lake as lk
from citymarts.sources.fixture import materialize_lake
from conftest import SF_CHECK


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    lake = materialize_lake(spark, SF_CHECK)
    return lk.scan_events(spark, lake.ods), lk.read_geo_handbook(spark, lake.geo)


@pytest.mark.parametrize("mart", ["users", "events", "matches"])
def test_no_python_no_products(inputs, mart):
    ev, geo = inputs
    df = {"users": lambda: activity.users_in_cities(ev, geo),
          "events": lambda: citystats.events_in_cities(ev, geo, RUN_DATE),
          "matches": lambda: matches.users_matches(ev, geo, RUN_DATE)}[mart]()
    p = plan(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{bad} in {mart} plan"


def test_period_scan_prunes_partitions(inputs):
    ev, _ = inputs
    df = lk.scan_message_range(ev, "2024-01-08", 7).select("event_id")
    ex = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    line = next(x for x in ex.splitlines() if x.startswith("PartitionFilters"))
    for part in ("(date", ">= 2024-01-01", "<= 2024-01-07", "= message)"):
        assert part in line, line
    assert "ReadSchema: struct<event_id:bigint>" in ex


def test_nested_schema_pruning(inputs):
    ev, _ = inputs
    df = ev.where("event_type = 'message'").select("event.message_from")
    p = plan(df)
    assert "ReadSchema: struct<event:struct<message_from:bigint>>" in p


def test_queries_registered():
    assert len(QUERIES) >= 40


def test_incremental_users_state_plan(inputs):
    import datetime as dt
    from pyspark.sql import functions as F
    ev, geo = inputs
    msgs = activity.messages_in_cities(ev, geo)
    st = activity.advance_users_state(None, msgs.where(F.col("day") < F.lit(dt.date(2024, 1, 20))))
    st2 = activity.advance_users_state(st, msgs.where(F.col("day") == F.lit(dt.date(2024, 1, 20))))
    p = plan(activity.users_in_cities_from_state(st2))
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p or "BroadcastHashJoin" in p
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, bad
