"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The ODS lake is written and the per-session nearest-city index is built first
(reported as ``lake_load_sec`` and ``city_index_build_sec``, not part of the
total). Each query runs to completion through a ``noop`` sink, so nothing is
collected to the driver; the best of ``BENCH_REPEAT`` (default 3) runs is
reported. ``BENCH_EXTRA_CONF`` (a JSON object) adds session settings.
``incremental`` reports, outside the total, one daily step of each mart's job
(its states advanced by the last lake day, late rows included, and the mart
read off them).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from citymarts.plans.catalog import QUERIES  # noqa: E402
from citymarts.session import build_session  # noqa: E402
from citymarts.functions.geo import stored_city_index  # noqa: E402
from citymarts.sources.fixture import materialize_lake  # noqa: E402
from citymarts.sources.lake import read_geo_handbook  # noqa: E402

EXTRA = json.loads(os.environ.get("BENCH_EXTRA_CONF", "{}"))

HEADLINE = ["users_in_cities", "events_in_cities", "users_matches", "nearest_zone",
            "new_users_by_zone", "subscriber_profile", "city_run_labels"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", "citymarts-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "8g", **EXTRA})
    t = time.time()
    lake = materialize_lake(spark, sf_dir)
    lake_sec = time.time() - t
    t = time.time()                      # once per handbook: the nearest-city index
    stored_city_index(read_geo_handbook(spark, lake.geo))
    index_sec = time.time() - t
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(repeat):
            t = time.time()
            _run(QUERIES[name](spark, sf_dir))
            best = min(best, time.time() - t)
        times[name] = round(best, 3)
    # incremental path: users state as of the last day, advanced by one day of messages
    # (reported outside the total; never allowed to suppress the headline line)
    try:
        import datetime as dt
        from citymarts.plans import jobs, states
        from citymarts.session import new_scratch
        days = states.lake_days(spark, lake.ods)
        last = max(days)
        after = last + dt.timedelta(days=1)
        root = new_scratch(spark, "bench-states")
        kinds = {f"{n}_state": f"{root}/{n}" for n in ("contacts", "subscriptions", "pairs")}
        steps = {
            "users": lambda run: jobs.users_in_cities_mart(spark, run, lake.ods, lake.geo, state_root=f"{root}/users"),
            "events": lambda run: jobs.events_in_cities_mart(spark, run, lake.ods, lake.geo, f"{root}/seen", f"{root}/rollups"),
            "matches": lambda run: jobs.users_matches_mart(spark, run, lake.ods, lake.geo, **kinds)}
        incremental = {}
        for name, step in steps.items():
            _run(step(last))                          # setup: the states before the last day
            t = time.time()
            _run(step(after))
            incremental[f"{name}_one_day_step"] = round(time.time() - t, 3)
    except Exception as e:  # noqa: BLE001
        incremental = {"error": f"{type(e).__name__}: {str(e)[:200]}"}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()) + index_sec, 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "lake_load_sec": round(lake_sec, 3),
                      "city_index_build_sec": round(index_sec, 3),
                      "incremental": incremental}))


if __name__ == "__main__":
    main()
