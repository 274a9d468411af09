"""Events mart: messages, reactions, subscriptions and new users per city.

A period is ``[run_date - depth, run_date - 1]``. The mart needs a 7- and a
30-day view; both come out of **one** scan of the longest period and one
aggregate with conditional counts (no second scan, no pivot job). New users:
the earliest day a user appears in any role (a hash aggregate over the
history before the run date) decides "known before the period" for every
depth at once; the first message per period comes from the 30-day scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citymarts.functions.geo import with_nearest_city
from citymarts.sources.lake import as_date, in_period, period

# The event types, in mart column order.
EVENT_TYPES = ["message", "reaction", "subscription"]

MART_DEPTHS = {"week": 7, "month": 30}


def _zoned(df: DataFrame, geo: DataFrame) -> DataFrame:
    return with_nearest_city(df, geo, out="_near").withColumn("zone_id", F.col("_near.zone_id")) \
        .drop("_near")


def events_by_zone_type(events: DataFrame, geo: DataFrame, run_date, depth: int) -> DataFrame:
    """``zone_id, event_type, n``: events of the period per nearest zone and type."""
    ev = events.where(in_period(run_date, depth)).select("event_type", "lat", "lon")
    return _zoned(ev, geo).groupBy("zone_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


def events_pivot_by_zone(events: DataFrame, geo: DataFrame, run_date, depth: int) -> DataFrame:
    """``zone_id, message, reaction, subscription``; a type absent in a zone is NULL.

    The pivot values are fixed, so the schema does not depend on the data and
    no extra job is run to discover them.
    """
    ev = events.where(in_period(run_date, depth)).select("event_type", "lat", "lon")
    return _zoned(ev, geo).groupBy("zone_id").pivot("event_type", EVENT_TYPES) \
        .agg(F.count(F.lit(1)))


def event_counts(events: DataFrame, geo: DataFrame, run_date,
                 depths: dict[str, int] | None = None) -> DataFrame:
    """``zone_id, <prefix>_<type>...`` for several period lengths in one pass."""
    depths = depths or MART_DEPTHS
    longest = max(depths.values())
    ev = events.where(in_period(run_date, longest)).select("date", "event_type", "lat", "lon")
    aggs = []
    for prefix, depth in depths.items():
        first, _ = period(run_date, depth)
        for t in EVENT_TYPES:
            aggs.append(F.count_if((F.col("event_type") == t) & (F.col("date") >= F.lit(first)))
                        .alias(f"{prefix}_{t}"))
    return _zoned(ev, geo).groupBy("zone_id").agg(*aggs)


def day_counts(events: DataFrame, geo: DataFrame) -> DataFrame:
    """``date, zone_id, event_type, n``: the daily rollup behind the period counts."""
    return (_zoned(events.select("date", "event_type", "lat", "lon"), geo)
            .groupBy("date", "zone_id", "event_type").agg(F.count(F.lit(1)).alias("n")))


def day_firsts(events: DataFrame) -> DataFrame:
    """``date, user_id, event_id, message_ts, lat, lon``: each sender's first message of each lake day."""
    first = F.min_by(F.struct("event_id", "message_ts", "lat", "lon"), F.struct("message_ts", "event_id"))
    return _sent(events).groupBy("date", "user_id").agg(first.alias("_f")).select("date", "user_id", "_f.*")


def counts_from_days(days: DataFrame, run_date, depths: dict[str, int] | None = None) -> DataFrame:
    """``event_counts`` as sums of ``day_counts``."""
    depths = depths or MART_DEPTHS
    n = lambda t, depth: F.sum(F.when((F.col("event_type") == t)
                                      & (F.col("date") >= F.lit(period(run_date, depth)[0])), F.col("n")).otherwise(0))
    return days.where(in_period(run_date, max(depths.values()))).groupBy("zone_id").agg(
        *[n(t, depth).alias(f"{prefix}_{t}") for prefix, depth in depths.items() for t in EVENT_TYPES])


def _sent(events: DataFrame) -> DataFrame:
    """Messages with a sender: ``date, user_id, event_id, message_ts, lat, lon``."""
    return (events.where((F.col("event_type") == "message") & F.col("event.message_from").isNotNull())
            .select("date", F.col("event.message_from").alias("user_id"), "event_id",
                    F.col("event.message_ts").cast("timestamp").alias("message_ts"), "lat", "lon"))


def _role_rows(events: DataFrame, run_date) -> DataFrame:
    """``user_id, date``: one row per (event, user in any role) before the run date."""
    roles = F.array(F.col("event.message_from"), F.col("event.message_to"),
                    F.col("event.user").try_cast("bigint"))
    ev = events.where(F.col("date") < F.lit(as_date(run_date)))
    return (ev.select("date", F.explode(roles).alias("user_id"))
            .where(F.col("user_id").isNotNull()))


def first_seen(events: DataFrame, before) -> DataFrame:
    """``user_id, first_date``: the first day each user appears in any role before ``before``.

    A hash aggregate (fixed-width ``min``) that combines map-side.
    """
    return _role_rows(events, before).groupBy("user_id").agg(F.min("date").alias("first_date"))


def known_users_before(events: DataFrame, before) -> DataFrame:
    """``user_id`` of everyone seen as sender, recipient or subscriber before ``before``."""
    return _role_rows(events, before).select("user_id").distinct()


def first_message_in_period(events: DataFrame, geo: DataFrame, run_date,
                            depth: int) -> DataFrame:
    """``user_id, event_id, message_ts, zone_id``: each sender's first message of the period."""
    m = (events.where(in_period(run_date, depth) & (F.col("event_type") == "message")
                      & F.col("event.message_from").isNotNull())
         .select(F.col("event.message_from").alias("user_id"), "event_id",
                 F.col("event.message_ts").cast("timestamp").alias("message_ts"), "lat", "lon"))
    first = m.groupBy("user_id").agg(
        F.min_by(F.struct("event_id", "message_ts", "lat", "lon"),
                 F.struct("message_ts", "event_id")).alias("_f")).select("user_id", "_f.*")
    return _zoned(first, geo).drop("lat", "lon")


def new_users_by_zone(events: DataFrame, geo: DataFrame, run_date,
                      depths: dict[str, int] | None = None,
                      seen: DataFrame | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """``zone_id, <prefix>_user``: senders new in the period, at their first message.

    New = first message inside the period by a user not seen before the period
    as sender, recipient or subscriber. The first day each user was seen in any
    role is a hash aggregate (fixed-width ``min(date)``) over the history; the
    first message of each period comes from one aggregate over the longest
    period's messages only; both are keyed by user, so the join needs no
    further shuffle of the history. ``seen`` may supply that first-seen table
    (``user_id, first_date`` for all history before the run date), e.g. the
    incrementally maintained state of ``plans.jobs.update_first_seen``, which
    replaces the scan of the whole history. ``firsts`` may supply ``day_firsts``
    of the period's days, which replace the scan of its messages: the first
    message of a period is the first among those of its days.
    """
    depths = depths or {"week": 7, "month": 30}
    if seen is None:
        seen = first_seen(events, run_date)
    seen = seen.select("user_id", F.col("first_date").alias("_seen"))
    longest = max(depths.values())
    msgs = (_sent(events) if firsts is None else firsts).where(in_period(run_date, longest))
    chrono = F.struct("message_ts", "event_id")
    aggs = []
    for prefix, depth in depths.items():
        hit = F.col("date") >= F.lit(period(run_date, depth)[0])
        aggs.append(F.min_by(F.struct("lat", "lon"), F.when(hit, chrono)).alias(f"_p_{prefix}"))
    per_user = msgs.groupBy("user_id").agg(*aggs).join(seen, "user_id")
    firsts = F.array(*[
        F.struct(F.lit(prefix).alias("k"), F.col(f"_p_{prefix}.lat").alias("lat"),
                 F.col(f"_p_{prefix}.lon").alias("lon"),
                 (F.col(f"_p_{prefix}").isNotNull()
                  & (F.col("_seen") >= F.lit(period(run_date, depth)[0]))).alias("is_new"))
        for prefix, depth in depths.items()])
    new = (per_user.select(F.explode(firsts).alias("_x")).select("_x.*")
           .where(F.col("is_new")))
    return _zoned(new, geo).groupBy("zone_id").agg(
        *[F.count_if(F.col("k") == prefix).alias(f"{prefix}_user") for prefix in depths])


def run_calendar(run_date) -> tuple[int, int]:
    """(month, ISO week) of a run date."""
    d = as_date(run_date)
    return d.month, d.isocalendar()[1]


def events_in_cities(events: DataFrame, geo: DataFrame, run_date,
                     seen: DataFrame | None = None, days: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Mart: every zone once with week/month event and new-user counts, zeros for none.

    Columns: ``month, week, zone_id, week_message, week_reaction,
    week_subscription, week_user, month_message, month_subscription,
    month_reaction, month_user``. Zone-less events count nowhere. ``days`` may
    supply the daily rollups (``day_counts``, ``day_firsts``) of the period.
    """
    d = F.lit(as_date(run_date))
    day_n, firsts = days or (None, None)
    counts = (event_counts(events, geo, run_date, MART_DEPTHS) if day_n is None
              else counts_from_days(day_n, run_date, MART_DEPTHS))
    users = new_users_by_zone(events, geo, run_date, MART_DEPTHS, seen, firsts)
    cols = ["week_message", "week_reaction", "week_subscription", "week_user",
            "month_message", "month_subscription", "month_reaction", "month_user"]
    mart = (geo.select("zone_id").join(counts, "zone_id", "left").join(users, "zone_id", "left"))
    return mart.select(F.month(d).alias("month"), F.weekofyear(d).alias("week"), "zone_id",
                       *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in cols])
