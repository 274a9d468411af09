"""Registered queries: one per operator of the blueprint, over the test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame. Inputs are the
driver's tables mapped by ``citymarts.sources.fixture`` and written once as the
ODS lake, so scans below are partition-pruned Parquet reads. Output columns are
flat and typed for the SQL cross-check: timestamps as ``timestamp_ntz``,
arrays joined to strings.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citymarts.functions.geo import haversine_km, with_nearest_city
from citymarts.operators import activity, citystats, matches
from citymarts.plans import jobs, states
from citymarts.session import ensure_utc, materialized, new_scratch
from citymarts.sources import lake as lk
from citymarts.sources.fixture import materialize_lake
from citymarts.sources.sinks import load_increment, write_snapshot

# Run parameters of the checks (the test data spans 2024-01-01 .. 2024-01-30).
RUN_DATE = "2024-01-31"      # full 30-day period; nobody is new at depth 7
EARLY_RUN = "2024-01-08"     # depth 7 covers the first week
MIX_RUN, MIX_DEPTH = "2024-01-05", 3
PARTITION_DAY = "2024-01-15"
HISTORY_BEFORE = "2024-01-24"

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str):
    ensure_utc(spark)
    lake = materialize_lake(spark, sf_dir)
    return lk.scan_events(spark, lake.ods), lk.read_geo_handbook(spark, lake.geo), lake


def _ntz(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _flat_event_cols() -> list[Column]:
    return [F.col("event.message_from").alias("message_from"),
            F.col("event.message_to").alias("message_to"),
            _ntz("event.message_ts").alias("message_ts"),
            F.col("event.user").alias("user"),
            F.col("event.subscription_channel").alias("subscription_channel")]


# ------------------------------------------------------------------ sources

def q_geo_handbook(spark, sf_dir):
    _, geo, _ = _inputs(spark, sf_dir)
    return geo


def q_scan_events(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return ev.select("event_id", "date", "event_type", "lat", "lon", *_flat_event_cols())


def q_scan_date_partition(spark, sf_dir):
    _, _, lake = _inputs(spark, sf_dir)
    day = lk.scan_date_partition(spark, lake.stg, PARTITION_DAY)
    return day.select("event_id", "event_type", "lat", "lon", *_flat_event_cols())


def q_scan_date_range(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return lk.scan_date_range(ev, EARLY_RUN, 7).select("event_id", "date", "event_type")


def q_scan_message_range(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return lk.scan_message_range(ev, EARLY_RUN, 7).select(
        "event_id", "date", F.col("event.message_from").alias("message_from"),
        F.col("event.message_to").alias("message_to"))


def q_filter_event_type(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return ev.where(F.col("event_type") == "message").select("event_id", "date")


def q_filter_history_before(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return lk.filter_history_before(ev, HISTORY_BEFORE).select("event_id", "date", "event_type")


def q_project_nested(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return ev.where(F.col("event_type") == "message").selectExpr(
        "event_id", "event.message_from as user_id", "event.message_to as message_to",
        "cast(event.message_ts as timestamp_ntz) as message_ts", "lat", "lon")


def q_cast_user_ids(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return ev.where(F.col("event_type") == "subscription").select(
        "event_id", F.col("event.user").try_cast("bigint").alias("user_id"))


# ------------------------------------------------------------------ geo

def _nearest_all(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return with_nearest_city(ev.select("event_id", "lat", "lon"), geo, out="n")


def q_nearest_zone(spark, sf_dir):
    return _nearest_all(spark, sf_dir).select("event_id", F.col("n.zone_id").alias("zone_id"))


def q_nearest_city(spark, sf_dir):
    return _nearest_all(spark, sf_dir).select("event_id", F.col("n.city").alias("city"))


def q_haversine_km(spark, sf_dir):
    n = _nearest_all(spark, sf_dir).where(F.col("n").isNotNull())
    d = haversine_km("lat", "lon", "n.lat", "n.lon")
    return n.select("event_id", F.col("n.zone_id").alias("zone_id"),
                    F.round(d, 6).alias("distance_km"))


# ------------------------------------------------------------------ users mart

def _messages(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return activity.messages_in_cities(ev, geo)


def _runs(spark, sf_dir):
    m = _messages(spark, sf_dir)
    return activity.city_runs(m.select("user_id", "event_id", "message_ts", "day", "city"))


def q_messages_in_cities(spark, sf_dir):
    return _messages(spark, sf_dir).select("user_id", "event_id", _ntz("message_ts")
                                           .alias("message_ts"), "city")


def q_latest_message_per_user(spark, sf_dir):
    lm = activity.latest_message_per_user(_messages(spark, sf_dir))
    return lm.select("user_id", "event_id", _ntz("message_ts").alias("message_ts"), "city")


def q_last_city(spark, sf_dir):
    lc = activity.last_city(_messages(spark, sf_dir))
    return lc.select("user_id", "act_city", _ntz("local_time").alias("local_time"))


def q_local_time_of_last_message(spark, sf_dir):
    lm = activity.latest_message_per_user(_messages(spark, sf_dir))
    return lm.select("user_id", F.col("city").alias("act_city"), "tz",
                     _ntz("message_ts").alias("message_ts"),
                     _ntz(F.from_utc_timestamp("message_ts", F.col("tz"))).alias("local_time"))


def q_city_change_flags(spark, sf_dir):
    return _runs(spark, sf_dir).select("user_id", "event_id", "city", "next_city", "flag")


def q_city_run_labels(spark, sf_dir):
    return _runs(spark, sf_dir).select("user_id", "event_id", "city", "flag", "seq_label")


def q_city_stays(spark, sf_dir):
    st = activity.city_stays(_runs(spark, sf_dir))
    return st.select("user_id", "city", "seq_label", "days_of_stay",
                     _ntz("max_ts").alias("max_ts"))


def q_long_stays(spark, sf_dir):
    st = activity.long_stays(activity.city_stays(_runs(spark, sf_dir)))
    return st.select("user_id", "city", "seq_label", "days_of_stay",
                     _ntz("max_ts").alias("max_ts"))


def q_home_city(spark, sf_dir):
    return activity.home_city(_runs(spark, sf_dir))


def q_travel_count(spark, sf_dir):
    return activity.travels(_runs(spark, sf_dir)).select("user_id", "travel_count")


def q_travel_array(spark, sf_dir):
    return activity.travels(_runs(spark, sf_dir)).select(
        "user_id", F.array_join("travel_array", "|").alias("travel_array"))


def q_users_in_cities(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    u = activity.users_in_cities(ev, geo)
    return u.select("user_id", "act_city", "home_city", "travel_count",
                    F.array_join("travel_array", "|").alias("travel_array"),
                    _ntz("local_time").alias("local_time"))


STEPS = 6   # daily steps of the incremental checks


def _last_days(spark, lake) -> list[dt.date]:
    """The last days of the lake, one more than the steps that follow the first state."""
    return sorted(states.lake_days(spark, lake.ods))[-STEPS:]


def q_users_in_cities_incremental(spark, sf_dir):
    """Users mart through the incremental state: full build of all but the last days
    of the data, then one step per day, late rows included."""
    _, _, lake = _inputs(spark, sf_dir)
    root = new_scratch(spark, "users-state")
    days = _last_days(spark, lake)
    for run in [days[0], *[d + dt.timedelta(days=1) for d in days]]:
        state = jobs.update_users_state(spark, run, lake.ods, lake.geo, root)
    return _flat_users(activity.users_in_cities_from_state(state))


ORDER_COLUMNS = ("lat", "lon", "event.message_to")


def _lake_without_event_ids(spark, sf_dir):
    ev, _, lake = _inputs(spark, sf_dir)
    root = new_scratch(spark, "no-event-ids")
    ev.drop("event_id").write.partitionBy("date", "event_type").parquet(root)
    return lk.EventLake(root, tie_breakers=ORDER_COLUMNS), lake.geo


def q_users_in_cities_other_order(spark, sf_dir):
    """Users mart of a log without event ids: equal times are ordered by position and recipient."""
    log, geo = _lake_without_event_ids(spark, sf_dir)
    return _flat_users(jobs.users_in_cities_mart(spark, RUN_DATE, log, geo))


def q_users_in_cities_other_order_incremental(spark, sf_dir):
    """The same through the state, continued by the last days of the data at once."""
    log, geo = _lake_without_event_ids(spark, sf_dir)
    root = new_scratch(spark, "users-state")
    days = sorted(states.lake_days(spark, log.root))
    for run in (days[-STEPS], days[-1] + dt.timedelta(days=1)):
        state = jobs.update_users_state(spark, run, log, geo, root)
    return _flat_users(activity.users_in_cities_from_state(state))


def _flat_users(mart):
    return mart.select("user_id", "act_city", "home_city", "travel_count",
                       F.array_join("travel_array", "|").alias("travel_array"),
                       _ntz("local_time").alias("local_time"))


# ------------------------------------------------------------------ events mart

def q_events_by_zone_type(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return citystats.events_by_zone_type(ev, geo, RUN_DATE, 30)


def q_events_pivot_by_zone(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return citystats.events_pivot_by_zone(ev, geo, RUN_DATE, 7)


def q_event_stats_7d(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return citystats.event_counts(ev, geo, RUN_DATE, {"week": 7})


def q_event_stats_30d(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return citystats.event_counts(ev, geo, RUN_DATE, {"month": 30})


def q_zone_stats_zero_filled(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    c = citystats.event_counts(ev, geo, RUN_DATE, {"week": 7})
    cols = ["week_message", "week_reaction", "week_subscription"]
    return geo.select("zone_id").join(c, "zone_id", "left").select(
        "zone_id", *[F.coalesce(F.col(x), F.lit(0)).alias(x) for x in cols])


def q_first_message_in_period(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    f = citystats.first_message_in_period(ev, geo, EARLY_RUN, 7)
    return f.select("user_id", "event_id", _ntz("message_ts").alias("message_ts"), "zone_id")


def q_known_users_before(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return citystats.known_users_before(ev, HISTORY_BEFORE)


def q_new_users_by_zone(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    n = citystats.new_users_by_zone(ev, geo, MIX_RUN, {"period": MIX_DEPTH})
    return n.select("zone_id", F.col("period_user").alias("user"))


def q_run_calendar(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return ev.select("date").distinct().select(
        "date", F.month("date").alias("month"), F.weekofyear("date").alias("week"))


def q_events_in_cities(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return citystats.events_in_cities(ev, geo, RUN_DATE)


def q_events_in_cities_first_week(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return citystats.events_in_cities(ev, geo, EARLY_RUN)


def q_event_stats_30d_rollups(spark, sf_dir):
    """The 30-day counts as sums of daily rollups: all days of the period rolled up, then one more for each later day."""
    _, _, lake = _inputs(spark, sf_dir)
    root = new_scratch(spark, "rollups")
    for back in (2, 1, 0):
        run = lk.as_date(RUN_DATE) - dt.timedelta(days=back)
        counts, _ = jobs.update_rollups(spark, run, lake.ods, lake.geo, root)
    return citystats.counts_from_days(counts, RUN_DATE, {"month": 30})


def q_first_message_from_rollups(spark, sf_dir):
    """Each sender's first message of the 30 days before the run, from the daily firsts."""
    _, geo, lake = _inputs(spark, sf_dir)
    _, firsts = jobs.update_rollups(spark, RUN_DATE, lake.ods, lake.geo, new_scratch(spark, "rollups"))
    first = firsts.groupBy("user_id").agg(F.min_by(F.struct("event_id", "message_ts", "lat", "lon"),
                                                   F.struct("message_ts", "event_id")).alias("f")).select("user_id", "f.*")
    return with_nearest_city(first, geo, out="n").select("user_id", "event_id", _ntz("message_ts").alias("message_ts"),
                                                         F.col("n.zone_id").alias("zone_id"))


# ------------------------------------------------------------------ matches mart

def q_contact_pairs(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return matches.contact_pairs(ev)


def q_user_channels(spark, sf_dir):
    ev, _, _ = _inputs(spark, sf_dir)
    return matches.user_channels(ev).select(
        "user_id", F.array_join("sub_channels_array", ",").alias("channels"))


def q_subscriber_profile(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    p = matches.subscriber_profile(ev, geo)
    return p.select("user_id", F.array_join("sub_channels_array", ",").alias("channels"),
                    "city_id", "last_message_lat", "last_message_lon",
                    _ntz("local_time").alias("local_time"))


def q_subscriber_profile_by_message(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    p = matches.subscriber_profile(ev, geo, location_from="message")
    return p.select("user_id", F.array_join("sub_channels_array", ",").alias("channels"),
                    "city_id", "last_message_lat", "last_message_lon",
                    _ntz("local_time").alias("local_time"))


def _profile(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    return ev, matches.subscriber_profile(ev, geo)


def q_shared_channel_pairs(spark, sf_dir):
    _, p = _profile(spark, sf_dir)
    return matches.nearby_pairs_unordered(p, 1.0).select("a", "b")


def q_nearby_user_pairs(spark, sf_dir):
    _, p = _profile(spark, sf_dir)
    return matches.nearby_user_pairs(p, 1.0).select(
        "user_left", "user_right", F.round("distance_km", 6).alias("distance_km"),
        "zone_id", _ntz("local_time").alias("local_time"))


def q_pairs_without_contact(spark, sf_dir):
    ev, p = _profile(spark, sf_dir)
    kept = matches.pairs_without_contact(matches.nearby_pairs_unordered(p, 1.0),
                                         matches.contacted_unordered(ev))
    return matches._directed(kept).select("user_left", "user_right")


def q_users_matches(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    m = matches.users_matches(ev, geo, RUN_DATE)
    return m.select("user_left", "user_right", "processed_dttm", "zone_id",
                    _ntz("local_time").alias("local_time"))


def q_users_matches_incremental(spark, sf_dir):
    """Matches mart from pairs continued day by day: users who moved or subscribed meet all others again."""
    _, _, lake = _inputs(spark, sf_dir)
    root = new_scratch(spark, "matches-states")
    days = _last_days(spark, lake)
    for run in [days[0], *[d + dt.timedelta(days=1) for d in days]]:
        mart = jobs.users_matches_mart(spark, run, lake.ods, lake.geo, **{
            f"{n}_state": f"{root}/{n}" for n in ("contacts", "subscriptions", "pairs")})
    return _flat_matches(mart)


def q_near_pairs_of_changed_users(spark, sf_dir):
    """The delta distance join: pairs of the users with a subscription on the last day that has one."""
    ev, geo, _ = _inputs(spark, sf_dir)
    state = matches.subscription_state(ev)
    profile = materialized(matches.positions(state), "positions")
    subs = ev.where((F.col("event_type") == "subscription") & F.col("event.user").isNotNull())
    last = subs.agg(F.max("date")).first()[0]
    some = profile.join(matches.subscription_state(subs.where(F.col("date") == F.lit(last))), "user_id", "left_semi")
    return matches.near_pairs_of(some, profile).select("a", "b", F.round("distance_km", 6).alias("distance_km"))


# ------------------------------------------------------------------ sinks

def q_stg_to_ods_roundtrip(spark, sf_dir):
    """Replay the daily increment for every day of the data, read the ODS back.

    The days are independent loads, so several run at a time. One day has a
    column that the others lack; it must still be there.
    """
    _, _, lake = _inputs(spark, sf_dir)
    root = new_scratch(spark, "ods-replay")
    stg, ods = f"{root}/stg", f"{root}/events"
    odd = F.col("date") == F.lit(lk.as_date(PARTITION_DAY))
    every = spark.read.parquet(lake.stg)
    every.where(~odd).write.partitionBy("date").parquet(stg)
    (every.where(odd).withColumn("device", F.lit("phone")).write.mode("append").partitionBy("date").parquet(stg))
    days = [r["date"] for r in every.select("date").distinct().orderBy("date").collect()]  # partition values
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda d: load_increment(spark, d + dt.timedelta(days=1), stg, ods), days))
    if "device" not in lk.scan_date_partition(spark, ods, PARTITION_DAY).columns:
        raise AssertionError("the load dropped a column")
    back = lk.scan_events(spark, ods)
    return back.select("event_id", "date", "event_type", "lat", "lon", *_flat_event_cols())


def q_stg_to_ods_missing_day(spark, sf_dir):
    """A day that STG no longer has: the load is refused and the loaded day stays."""
    _, _, lake = _inputs(spark, sf_dir)
    root = new_scratch(spark, "ods-missing")
    run = lk.as_date(PARTITION_DAY) + dt.timedelta(days=1)
    load_increment(spark, run, lake.stg, f"{root}/events")
    rest = f"{root}/stg"
    (spark.read.parquet(lake.stg).where(F.col("date") != F.lit(lk.as_date(PARTITION_DAY)))
     .write.partitionBy("date").parquet(rest))
    refused = False
    try:
        load_increment(spark, run, rest, f"{root}/events")
    except AnalysisException:
        refused = True
    return (lk.scan_events(spark, f"{root}/events").groupBy("date", "event_type")
            .agg(F.count("*").alias("n")).withColumn("refused", F.lit(refused)))


def q_scan_events_string_ts(spark, sf_dir):
    """A lake whose times are strings (some of them bad) and whose channels are, too."""
    ev, _, _ = _inputs(spark, sf_dir)
    root = new_scratch(spark, "string-lake")
    text = F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(F.col("event.message_ts").cast("string"))
    event = (F.col("event").withField("message_ts", text)
             .withField("subscription_channel", F.col("event.subscription_channel").cast("string")))
    ev.withColumn("event", event).write.partitionBy("date", "event_type").parquet(root)
    return lk.scan_events(spark, root).select("event_id", _ntz("event.message_ts").alias("message_ts"),
                                              F.col("event.subscription_channel").alias("channel"))


def q_scan_events_drifting(spark, sf_dir):
    """A lake whose days were written by three producers: times and ids as strings, no coordinates, or as usual."""
    ev, _, _ = _inputs(spark, sf_dir)
    root = new_scratch(spark, "drifting-lake")
    kind = F.dayofmonth("date") % 3
    text = F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(F.col("event.message_ts").cast("string"))
    event = F.col("event").withField("message_ts", text)
    for c in ("message_from", "message_to", "subscription_channel"):
        event = event.withField(c, F.col(f"event.{c}").cast("string"))
    for k, part in ((0, ev), (1, ev.withColumn("event", event).withColumn("event_id", F.col("event_id").cast("string"))),
                    (2, ev.drop("lat", "lon"))):
        part.where(kind == k).write.mode("append").partitionBy("date", "event_type").parquet(root)
    back = lk.scan_events(spark, root, reconcile=True)
    return back.select("event_id", "date", "event_type", "lat", "lon", *_flat_event_cols())


def q_geo_handbook_from_csv(spark, sf_dir):
    """The one-off load of the dimension from CSV."""
    _, geo, _ = _inputs(spark, sf_dir)
    root = new_scratch(spark, "handbook")
    geo.write.option("header", True).csv(f"{root}/csv")
    return lk.read_geo_handbook(spark, lk.geo_handbook_from_csv(spark, f"{root}/csv", f"{root}/parquet"))


def q_nearest_city_rewritten_handbook(spark, sf_dir):
    """The nearest city after the handbook at the same path got more cities."""
    ev, geo, _ = _inputs(spark, sf_dir)
    path = new_scratch(spark, "handbook") + "/geo"
    geo.write.parquet(path)
    points = ev.select("event_id", "lat", "lon")
    with_nearest_city(points, lk.read_geo_handbook(spark, path), out="n")
    more = geo.unionByName(geo.select((F.col("zone_id") + 100).alias("zone_id"), "city",   # names may repeat
                                      (F.col("lat") + 0.5).alias("lat"), (F.col("lon") + 3).alias("lon"), "tz"))
    more.write.parquet(path + "-new")
    spark.read.parquet(path + "-new").write.mode("overwrite").parquet(path)
    n = with_nearest_city(points, lk.read_geo_handbook(spark, path), out="n")
    return n.select("event_id", F.col("n.zone_id").alias("zone_id"))


# ------------------------------------------------------------------ daily run

def _daily(spark, sf_dir, build: Callable) -> DataFrame:
    """The mart that ``build(run date, root)`` makes at the end of these runs, read back.

    A run on all but the last days; one on the day after, of which STG holds
    only a part of the rows; none for some days (as if lost); one after the
    last day of the data; then the part is loaded again with all its rows and
    the last run repeated. Every state is continued, none rebuilt.
    """
    _, _, lake = _inputs(spark, sf_dir)
    root = new_scratch(spark, "daily")
    stg, ods = f"{root}/stg", f"{root}/ods"
    every = spark.read.parquet(lake.stg)
    days = _last_days(spark, lake)
    since = F.col("date") >= F.lit(days[0])
    every.where(~since).write.partitionBy("date", "event_type").parquet(ods)
    every.where(since & ((F.col("date") > F.lit(days[0])) | (F.col("event_id") % 2 == 0))).write.partitionBy("date").parquet(stg)
    runs = [d + dt.timedelta(days=1) for d in days]
    build(days[0], root)
    load_increment(spark, runs[0], stg, ods)
    build(runs[0], root)
    for run in runs[1:]:
        load_increment(spark, run, stg, ods)
    build(runs[-1], root)
    whole = f"{root}/stg-whole"
    every.where(F.col("date") == F.lit(days[0])).write.partitionBy("date").parquet(whole)
    load_increment(spark, runs[0], whole, ods)
    return spark.read.parquet(build(runs[-1], root))


def q_run_daily_users(spark, sf_dir):
    _, _, lake = _inputs(spark, sf_dir)
    return _flat_users(_daily(spark, sf_dir, lambda run, root: jobs.build_users_in_cities(
        spark, run, f"{root}/ods", lake.geo, f"{root}/mart", state_root=f"{root}/state")))


def q_run_daily_events(spark, sf_dir):
    _, _, lake = _inputs(spark, sf_dir)
    return _daily(spark, sf_dir, lambda run, root: jobs.build_events_in_cities(
        spark, run, f"{root}/ods", lake.geo, f"{root}/mart", state_root=f"{root}/state", rollups=f"{root}/rollups"))


def q_run_daily_matches(spark, sf_dir):
    _, _, lake = _inputs(spark, sf_dir)
    return _flat_matches(_daily(spark, sf_dir, lambda run, root: jobs.build_users_matches(
        spark, run, f"{root}/ods", lake.geo, f"{root}/mart",
        **{f"{n}_state": f"{root}/{n}" for n in ("contacts", "subscriptions", "pairs")})))


def _flat_matches(mart):
    return mart.select("user_left", "user_right", "processed_dttm", "zone_id", _ntz("local_time").alias("local_time"))


def q_mart_snapshot_roundtrip(spark, sf_dir):
    ev, geo, _ = _inputs(spark, sf_dir)
    root = new_scratch(spark, "cdm") + "/users_in_cities"
    write_snapshot(activity.users_in_cities(ev, geo), root, RUN_DATE)
    back = spark.read.parquet(root).where(F.col("date") == F.lit(lk.as_date(RUN_DATE)))
    return back.select("user_id", "act_city", "home_city", "travel_count",
                       F.array_join("travel_array", "|").alias("travel_array"),
                       _ntz("local_time").alias("local_time"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
