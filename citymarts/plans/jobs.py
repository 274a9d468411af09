"""Job entry points: the daily increment and the three mart builds.

Each job takes a session (it never creates or stops one, except in ``main``),
reads the ODS lake and the city dimension by path, and overwrites the
``date=<run_date>`` snapshot of its mart. ``run_daily`` runs them in the
pipeline's order. From the command line (e.g. under spark-submit):

    python -m citymarts.plans.jobs increment <run_date> <stg_root> <ods_root>
    python -m citymarts.plans.jobs users|events|matches <run_date> <ods_root> <geo_path> <mart_root>

Optional trailing arguments switch on the incremental states: ``users`` takes
``<users_state>``, ``events`` takes ``<first_seen_state> <rollups>``, ``matches`` takes
``<contacts_state> <subscriptions_state> <pairs_state>``. ``--rebuild`` makes the states anew;
``--as-of`` (users, matches) and ``--require-complete`` (events) are options of
the marts; ``--tie-breakers=<column>,...`` orders messages of equal times where
the log has no event key.

The states (``plans.states``) know which lake days they were made of: after a
lost run or a re-load of any earlier day the next run continues the newest
state that still fits.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
import uuid
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from citymarts.functions.geo import fingerprint
from citymarts.operators import activity, citystats, matches
from citymarts.plans import states
from citymarts.session import ensure_utc, materialized, move, read_text, remove, write_text
from citymarts.sources.lake import EventLake, as_date, filter_history_before, period, read_geo_handbook, scan_date_range
from citymarts.sources.sinks import load_increment, write_snapshot


@dataclass(frozen=True)
class Paths:
    stg_events: str
    ods_events: str | EventLake
    geo_handbook: str
    users_in_cities: str
    events_in_cities: str
    users_matches: str
    users_state: str | None = None        # optional incremental state for the users mart
    first_seen_state: str | None = None   # optional incremental state for the events mart
    contacts_state: str | None = None     # optional incremental states for the matches mart
    subscriptions_state: str | None = None
    pairs_state: str | None = None        # needs both of the matches mart's other states
    rollups: str | None = None            # optional daily rollups for the events mart


def _inputs(spark: SparkSession, run_date, ods_root: str | EventLake, geo_path: str, as_of: bool):
    lake = EventLake.of(ods_root)
    ensure_utc(spark)
    ev = lake.scan(spark)
    if as_of:   # only history strictly before the run date (partition-pruned)
        ev = filter_history_before(ev, run_date)
    return ev, read_geo_handbook(spark, geo_path)


def users_in_cities_mart(spark, run_date, ods_root, geo_path, as_of=False,
                         state_root: str | None = None, rebuild: bool = False) -> DataFrame:
    """All history, or with ``as_of`` that before the run date. ``state_root``
    reads the mart off the incremental users state, which implies ``as_of``."""
    if state_root:
        return activity.users_in_cities_from_state(
            update_users_state(spark, run_date, ods_root, geo_path, state_root, rebuild))
    ev, geo = _inputs(spark, run_date, ods_root, geo_path, as_of)
    return activity.users_in_cities(ev, geo)


def update_users_state(spark: SparkSession, run_date, ods_root: str | EventLake, geo_path: str,
                       state_root: str, rebuild: bool = False, days: states.LakeDays | None = None) -> DataFrame:
    """The users-mart state over messages before ``run_date``.

    With an earlier state only the lake days since are read and located. Late
    rows are looked for first; without any, no other day is read.
    """
    lake = EventLake.of(ods_root)
    ensure_utc(spark)
    geo = read_geo_handbook(spark, geo_path)
    days = states.lake_days(spark, lake.root) if days is None else days
    past = sorted(d for d in days if d < as_date(run_date))
    made_with = {"geo": fingerprint(geo)} | _order(lake)

    def sent(some: list[dt.date] | None = None) -> DataFrame:
        return activity.sent_messages(lake.scan(spark, past if some is None else some))

    def located(messages: DataFrame) -> DataFrame:
        return activity.located_messages(messages, geo)

    def full(some: list[dt.date]) -> DataFrame:
        messages = sent(some)
        return activity.advance_users_state(None, located(messages), hot=activity.hot_users(messages))

    def step(state: DataFrame, start: dt.date, since: list[dt.date]) -> DataFrame:
        return advanced_users(state, sent(since), partial(_earlier_users, spark, state_root, days, past, made_with), sent, located)

    return states.advance(spark, state_root, run_date, days, full, step, rebuild, made_with)


def _earlier_users(spark, state_root, days, past, made_with, since: dt.date) -> tuple[DataFrame | None, list[dt.date]]:
    """The newest state made of lake days before ``since``, and the days from there on."""
    start = states.newest(spark, state_root, since, days, made_with)
    if start is None:
        return None, past
    return spark.read.parquet(states.dated(state_root, start)), [d for d in past if d >= start]


def advanced_users(state: DataFrame, new: DataFrame, earlier, located, locate=None) -> DataFrame:
    """``activity.advance_users_state`` with late rows replayed from an earlier state.

    Users whose new messages all follow their state's last one are advanced.
    The others are replayed from ``earlier(day of the first late time)``: a state
    and the days after it, of which ``located(days)`` gives the messages. Those that
    are late for that state, too, and those with a message without a time (it
    precedes all others) are rebuilt from all days, without a state. No part
    that has no users gets into the plan, and as every user is in one part only,
    all go through one advance.

    With ``locate`` the messages given are not located yet: those that the
    advance takes are picked and written first, then located and counted by user.
    """
    late = materialized(activity.late_users(state, new), "late-users")
    first = late.agg(F.count(F.lit(1)).alias("n"), F.min(F.to_date("since")).alias("since"),
                     F.count_if(F.col("since").isNull()).alias("timeless")).first()
    if not first.n:
        return _advanced(state, new, locate)
    bases, messages = [activity.only(state, late, "left_anti")], [activity.only(new, late, "left_anti")]
    timed, rest = late.where("since is not null"), late.where("since is null")
    former, after = earlier(first.since) if first.since is not None else (None, [])
    if former is None:
        rest = late
    else:
        former, replayed = (activity.only(df, timed, "left_semi") for df in (former, located(after)))
        still = materialized(activity.late_users(former, replayed), "late-users")
        bases.append(activity.only(former, still, "left_anti"))
        messages.append(activity.only(replayed, still, "left_anti"))
        rest = None if still.isEmpty() and not first.timeless else rest.unionByName(still)
    if rest is not None:
        messages.append(activity.only(located(), rest, "left_semi"))
    picked = reduce(DataFrame.unionByName, messages)
    return _advanced(reduce(DataFrame.unionByName, bases), materialized(picked, "step-messages") if locate else picked, locate)


def _advanced(state: DataFrame, messages: DataFrame, locate) -> DataFrame:
    if locate is None:
        return activity.advance_users_state(state, messages)
    return activity.advance_users_state(state, locate(messages), hot=activity.hot_users(messages))


def _order(lake: EventLake) -> dict[str, str]:
    return {"tie_breakers": ",".join(lake.tie_breakers)} if lake.tie_breakers else {}


def _logged(spark, run_date, ods_root, state_root, whole, keys, rebuild, days) -> DataFrame:
    """The state of ``whole(events)``, a log by ``keys``."""
    lake = EventLake.of(ods_root)
    ensure_utc(spark)
    days = states.lake_days(spark, lake.root) if days is None else days
    return states.append(spark, state_root, run_date, days, lambda some: whole(lake.scan(spark, some)), keys, rebuild, _order(lake))


def update_first_seen(spark: SparkSession, run_date, ods_root: str | EventLake, state_root: str,
                      rebuild: bool = False, days: states.LakeDays | None = None) -> DataFrame:
    """Each user's first day over history before ``run_date`` (``user_id, first_date``).

    Days come in order, so a known user's first day stays; only new users are written.
    """
    return _logged(spark, run_date, ods_root, state_root, lambda ev: citystats.first_seen(ev, run_date), ["user_id"], rebuild, days)


def update_contacts(spark: SparkSession, run_date, ods_root: str | EventLake, state_root: str,
                    rebuild: bool = False, days: states.LakeDays | None = None) -> DataFrame:
    """Unordered pairs (``lo, hi``) that exchanged a message before ``run_date``; only new pairs are written."""
    return _logged(spark, run_date, ods_root, state_root, matches.contacted_unordered, ["lo", "hi"], rebuild, days)


def update_subscriptions(spark: SparkSession, run_date, ods_root: str | EventLake, state_root: str,
                         rebuild: bool = False, days: states.LakeDays | None = None) -> DataFrame:
    """Per subscriber channel set and latest subscription row, history before ``run_date``."""
    lake = EventLake.of(ods_root)
    ensure_utc(spark)
    days = states.lake_days(spark, lake.root) if days is None else days
    of = lambda some: matches.subscription_state(lake.scan(spark, some))
    return states.advance(spark, state_root, run_date, days, of, lambda state, start, since: matches.merge_subscription_states(
        state, of(since)), rebuild, _order(lake))


def update_pairs(spark: SparkSession, run_date, ods_root: str | EventLake, pairs_root: str, contacts_state: str,
                 subscriptions_state: str, radius_km: float = 1.0, rebuild: bool = False,
                 days: states.LakeDays | None = None) -> DataFrame:
    """Near pairs of co-subscribers before ``run_date`` (``matches.pairs_state``).

    An earlier state of the pairs is continued from the subscriptions' state of
    the same day: users with a subscription since are compared with it, and
    those whose channels or position changed meet all others again.
    """
    lake = EventLake.of(ods_root)
    ensure_utc(spark)
    days = states.lake_days(spark, lake.root) if days is None else days
    contacts = update_contacts(spark, run_date, ods_root, contacts_state, rebuild, days)
    profile = matches.positions(update_subscriptions(spark, run_date, ods_root, subscriptions_state, rebuild, days))

    def step(pairs: DataFrame, start: dt.date, since: list[dt.date]) -> DataFrame:
        new = lake.scan(spark, since)
        before = matches.positions(spark.read.parquet(states.dated(subscriptions_state, start)))
        changed = materialized(matches.changed_positions(before, profile, matches.subscription_state(new)), "changed")
        return matches.advance_pairs(pairs, changed, profile, matches.contacted_unordered(new), contacts, radius_km)

    return states.advance(spark, pairs_root, run_date, days, lambda _: matches.pairs_state(profile, contacts, radius_km), step,
                          rebuild, {"radius_km": repr(radius_km)} | _order(lake),
                          lambda day: states.valid(spark, subscriptions_state, day, days, _order(lake)))


_DAY_TABLES = {"counts": "zone_id int, event_type string, n long, batch string, date date",
               "firsts": "user_id long, event_id {kind}, message_ts timestamp, lat double, lon double, batch string, date date"}


def update_rollups(spark: SparkSession, run_date, ods_root: str | EventLake, geo_path: str, root: str,
                   days: states.LakeDays | None = None) -> tuple[DataFrame, DataFrame]:
    """``day_counts`` and ``day_firsts`` of the mart's longest period before ``run_date``.

    Of the lake only the days are read whose rollup is missing or was made of
    other files (or with another city dimension): as a rule one a run. A
    re-loaded day is rolled up again, and the window slides by leaving days
    out. ``{root}/days.json`` names the batch that holds each day's rollup.
    """
    lake = EventLake.of(ods_root)
    ensure_utc(spark)
    geo = read_geo_handbook(spark, geo_path)
    days = states.lake_days(spark, lake.root) if days is None else days
    first, last = period(run_date, max(citystats.MART_DEPTHS.values()))
    mark = " ".join([fingerprint(geo), *lake.tie_breakers])
    wanted = {d.isoformat(): f"{s} {mark}" for d, s in days.items() if first <= d <= last}
    index = json.loads(read_text(spark, f"{root}/days.json") or "{}")
    stale = sorted(as_date(d) for d, s in wanted.items() if index.get(d, [None])[0] != s)
    if stale:
        batch, new = uuid.uuid4().hex[:12], lake.scan(spark, stale)
        for name, table in (("counts", citystats.day_counts(new, geo)), ("firsts", citystats.day_firsts(new))):
            table.write.partitionBy("date").parquet(f"{root}/{name}/batch={batch}")
        index |= {d.isoformat(): [wanted[d.isoformat()], batch] for d in stale}
        write_text(spark, f"{root}/days-{batch}.json", json.dumps(index, sort_keys=True))
        remove(spark, f"{root}/days.json")
        move(spark, f"{root}/days-{batch}.json", f"{root}/days.json")
    held = [f"{index[d][1]} {d}" for d in wanted]          # at most the days of the period
    kind = lake.scan(spark, sorted(days)[-1:]).schema["event_id"].dataType.simpleString()
    tables = []
    for name, schema in _DAY_TABLES.items():
        schema = schema.format(kind=kind)
        rows = spark.read.schema(schema).parquet(f"{root}/{name}") if held else spark.createDataFrame([], schema)
        tables.append(rows.where(F.concat_ws(" ", "batch", F.col("date").cast("string")).isin(held)).drop("batch"))
    return tables[0], tables[1]


def users_in_cities_mart(spark, run_date, ods_root, geo_path, as_of=False,
                         state_root: str | None = None, rebuild: bool = False) -> DataFrame:
    """All history, or with ``as_of`` that before the run date. ``state_root``
    reads the mart off the incremental users state, which implies ``as_of``."""
    if state_root:
        return activity.users_in_cities_from_state(
            update_users_state(spark, run_date, ods_root, geo_path, state_root, rebuild))
    ev, geo = _inputs(spark, run_date, ods_root, geo_path, as_of)
    return activity.users_in_cities(ev, geo)


def events_in_cities_mart(spark, run_date, ods_root, geo_path,
                          state_root: str | None = None, rollups: str | None = None,
                          require_complete: bool = False, rebuild: bool = False) -> DataFrame:
    """``require_complete`` fails the run (listing the days) if any day of the
    30-day period has no partition, instead of counting it as zero. With the
    first-seen state and the rollups only new and changed days are read."""
    lake = EventLake.of(ods_root)
    ensure_utc(spark)
    geo = read_geo_handbook(spark, geo_path)
    days = states.lake_days(spark, lake.root) if state_root or rollups else None
    # with both, the lake is not scanned: its schema is all that is asked for
    ev = lake.scan(spark, sorted(days)[-1:] if state_root and rollups else None)
    if require_complete:
        scan_date_range(lake.scan(spark), run_date, max(citystats.MART_DEPTHS.values()), require_complete=True)
    seen = update_first_seen(spark, run_date, ods_root, state_root, rebuild, days) if state_root else None
    rolled = update_rollups(spark, run_date, ods_root, geo_path, rollups, days) if rollups else None
    return citystats.events_in_cities(ev, geo, run_date, seen, rolled)


def users_matches_mart(spark, run_date, ods_root, geo_path, as_of=False,
                       contacts_state: str | None = None, subscriptions_state: str | None = None,
                       pairs_state: str | None = None, rebuild: bool = False) -> DataFrame:
    """All history, or with ``as_of`` that before the run date. A state implies
    ``as_of``, so contacts, profiles and pairs always cover the same period.
    With ``pairs_state`` (and both others) the pairs are continued from it."""
    lake = EventLake.of(ods_root)
    as_of = as_of or bool(contacts_state or subscriptions_state)
    if pairs_state and not (contacts_state and subscriptions_state):
        raise ValueError("pairs_state needs contacts_state and subscriptions_state")
    days = states.lake_days(spark, lake.root) if contacts_state or subscriptions_state else None
    if pairs_state:
        pairs = update_pairs(spark, run_date, ods_root, pairs_state, contacts_state, subscriptions_state, rebuild=rebuild, days=days)
        subs = spark.read.parquet(states.dated(subscriptions_state, run_date))
        profile = matches.subscriber_profile(None, read_geo_handbook(spark, geo_path), state=subs)
        return matches.users_matches_from_pairs(pairs, materialized(profile, "profile"), run_date)
    ev, geo = _inputs(spark, run_date, ods_root, geo_path, as_of)
    contacts = (update_contacts(spark, run_date, ods_root, contacts_state, rebuild, days)
                if contacts_state else None)
    subs = (update_subscriptions(spark, run_date, ods_root, subscriptions_state, rebuild, days)
            if subscriptions_state else None)
    return matches.users_matches(ev, geo, run_date, contacts=contacts, subscriptions=subs)


def build_users_in_cities(spark, run_date, ods_root, geo_path, mart_root, **options) -> str:
    return write_snapshot(users_in_cities_mart(spark, run_date, ods_root, geo_path, **options),
                          mart_root, run_date)


def build_events_in_cities(spark, run_date, ods_root, geo_path, mart_root, **options) -> str:
    return write_snapshot(events_in_cities_mart(spark, run_date, ods_root, geo_path, **options),
                          mart_root, run_date)


def build_users_matches(spark, run_date, ods_root, geo_path, mart_root, **options) -> str:
    return write_snapshot(users_matches_mart(spark, run_date, ods_root, geo_path, **options),
                          mart_root, run_date)


def run_daily(spark: SparkSession, run_date, paths: Paths, rebuild: bool = False,
              as_of: bool = False, require_complete: bool = False) -> dict[str, str]:
    """Increment of the previous day, then the three marts, in pipeline order.

    ``rebuild`` makes the states anew from the lake (re-loaded days are
    noticed without it); ``as_of`` and ``require_complete`` are those of the marts.
    """
    ods = EventLake.of(paths.ods_events).root
    day = load_increment(spark, run_date, paths.stg_events, ods)
    lake = (spark, run_date, paths.ods_events, paths.geo_handbook)
    return {
        "increment": f"{ods}/date={day.isoformat()}",
        "users_in_cities": build_users_in_cities(
            *lake, paths.users_in_cities, as_of=as_of, state_root=paths.users_state, rebuild=rebuild),
        "events_in_cities": build_events_in_cities(
            *lake, paths.events_in_cities, state_root=paths.first_seen_state, rollups=paths.rollups,
            require_complete=require_complete, rebuild=rebuild),
        "users_matches": build_users_matches(
            *lake, paths.users_matches, as_of=as_of, contacts_state=paths.contacts_state,
            subscriptions_state=paths.subscriptions_state, pairs_state=paths.pairs_state, rebuild=rebuild),
    }


FLAGS = {"--rebuild": "rebuild", "--as-of": "as_of", "--require-complete": "require_complete"}
ORDER = "--tie-breakers="


def main(argv: list[str]) -> int:
    from pyspark import SparkConf, SparkContext
    flags = {FLAGS[a]: True for a in argv if a in FLAGS}
    order = tuple(c for a in argv if a.startswith(ORDER) for c in a.removeprefix(ORDER).split(","))
    job, run_date, *args = [a for a in argv if a not in FLAGS and not a.startswith(ORDER)]
    builder = SparkSession.builder.appName(f"citymarts-{job}/date={run_date}")
    SparkContext._ensure_initialized()      # JVM-backed conf: sees spark-submit's --master
    if SparkConf().get("spark.master", None) is None:     # plain `python -m`: run locally
        builder = builder.master("local[*]").config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    try:
        if job == "increment":
            load_increment(spark, run_date, *args)
        else:
            ods, geo, mart, *roots = args
            ods = EventLake(ods, tie_breakers=order)
            if job == "users":
                build_users_in_cities(spark, run_date, ods, geo, mart, **dict(zip(("state_root",), roots)), **flags)
            elif job == "events":
                build_events_in_cities(spark, run_date, ods, geo, mart, **dict(zip(("state_root", "rollups"), roots)), **flags)
            elif job == "matches":
                build_users_matches(spark, run_date, ods, geo, mart, **dict(zip(
                    ("contacts_state", "subscriptions_state", "pairs_state"), roots)), **flags)
            else:
                raise SystemExit(f"unknown job {job!r}")
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
