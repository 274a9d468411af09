"""Users mart: where each user is, lives and has travelled.

Chronology is ``(message_ts, event_id)``: the event id breaks timestamp ties,
so every ordering below is total and results are deterministic. The event id
may have any type that has an order, e.g. a struct of other columns
(``tie_breakers`` of ``sources.lake.scan_events``).

A NULL sender is a group of its own, and a message without a time counts as
the sender's earliest; neither is lost.

Skew: the only ordered computation (``city_runs``) windows over
``(user_id, time bucket)`` and then stitches bucket boundaries with a second
window over one row per bucket, so a hot user is spread over as many tasks as
it has active buckets. Per-user results are aggregates that combine map-side
(``count``, ``count_distinct``, ``max``, ``collect_list``), so a user holding
a third of all messages costs one pre-aggregated row per map task. The state's
advance spreads only the users that it is told are hot (``hot_users``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from citymarts.functions.geo import with_nearest_city
from citymarts.session import materialized
from citymarts.sources import sinks

ORDER = ("message_ts", "event_id")


def _chrono() -> Column:
    return F.struct(*[F.col(c) for c in ORDER])


def messages_in_cities(events: DataFrame, geo: DataFrame) -> DataFrame:
    """All messages of all history with the sender and the nearest city.

    ``user_id, event_id, message_ts, day, zone_id, city, tz``; city NULL when
    the message has no coordinates.
    """
    return located_messages(sent_messages(events), geo)


def sent_messages(events: DataFrame) -> DataFrame:
    """All messages with the sender, not yet located: ``user_id, event_id, message_ts, lat, lon``."""
    return (events.where(F.col("event_type") == "message")
            .select(F.col("event.message_from").alias("user_id"), "event_id",
                    F.col("event.message_ts").cast("timestamp").alias("message_ts"),
                    "lat", "lon"))


def located_messages(sent: DataFrame, geo: DataFrame) -> DataFrame:
    """``messages_in_cities`` of ``sent_messages``."""
    m = with_nearest_city(sent, geo, out="_near")
    return m.select("user_id", "event_id", "message_ts",
                    F.to_date("message_ts").alias("day"),
                    F.col("_near.zone_id").alias("zone_id"),
                    F.col("_near.city").alias("city"), F.col("_near.tz").alias("tz"))


def latest_message_per_user(messages: DataFrame) -> DataFrame:
    """Latest message per user: ``user_id, event_id, message_ts, city, tz``."""
    last = F.max_by(F.struct("event_id", "message_ts", "city", "tz"), _chrono())
    return (messages.groupBy("user_id").agg(last.alias("_l"))
            .select("user_id", "_l.*"))


def last_city(messages: DataFrame) -> DataFrame:
    """``user_id, act_city, tz, local_time``: city and local time of the latest message."""
    lm = latest_message_per_user(messages)
    return lm.select("user_id", F.col("city").alias("act_city"), "tz",
                     F.from_utc_timestamp("message_ts", F.col("tz")).alias("local_time"))


# Bucket of the messages without a time: before all others, as a descending order puts them last.
_NO_TIME = -(1 << 60)


def _known(user: str = "user_id") -> list[Column]:
    """Non-null keys for a user id, so that a NULL sender keeps its group in joins and windows."""
    return [F.coalesce(F.col(user), F.lit(0)).alias("_u"), F.col(user).isNull().alias("_un")]


def bucket_partitioned(messages: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """Messages with ``_u``, ``_un`` (sender, NULL sender) and their time bucket ``_b``,
    hash-partitioned on these.

    A user's messages land in as many partitions as the user has active
    buckets, so no single task receives a hot user's whole history. Messages
    without a time have a bucket of their own, the earliest.
    """
    us = int(bucket_seconds) * 1_000_000
    m = messages.select("*", *_known()).withColumn("_b", F.coalesce(
        F.floor(F.unix_micros("message_ts") / F.lit(us)), F.lit(_NO_TIME)))
    return sinks.bucket_partitioned(m, _BUCKET)


_BUCKET = ["_u", "_un", "_b"]


def _buckets(messages: DataFrame, bucket_seconds: int) -> tuple[DataFrame, DataFrame]:
    """(messages with their labels inside the bucket, per-(user, bucket) summaries).

    Level 1 windows over (user, bucket) on the explicitly hash-partitioned
    messages and also yields each bucket's earliest city and flag total, so
    the bucket summary is just the bucket's latest row. Level 2 windows over
    one row per (user, bucket) and yields, per bucket, the flag of its last
    message (against the first message of the next non-empty bucket), the
    number of flags in all later buckets and whether it is the user's latest
    bucket. Only the summaries are shuffled back to the messages. Where both
    sides use the same columns, one shuffle of the messages serves both.
    """
    m = bucket_partitioned(messages, bucket_seconds)
    desc = [F.col(c).desc() for c in ORDER]
    w1 = Window.partitionBy(*_BUCKET).orderBy(*desc)
    whole = w1.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    m = m.withColumns({
        "_nxt": F.lag(F.struct(F.col("city").alias("c")), 1).over(w1),
        "_rn": F.row_number().over(w1),                       # 1 = bucket's latest message
        "_first": F.last("city").over(whole)})                # bucket's earliest city
    m = m.withColumn("_f", F.when(F.col("city") != F.col("_nxt.c"), 1).otherwise(0))
    m = m.withColumns({
        "_s": F.sum("_f").over(w1.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_nf": F.sum("_f").over(whole)})

    extra = [c for c in messages.columns if c not in ("user_id",)]
    # one row per (user, bucket): its latest message, no aggregation needed
    s = m.where(F.col("_rn") == 1).select(
        "user_id", *_BUCKET, "_first", F.struct(*extra).alias("_lastm"), "_nf")
    w2 = Window.partitionBy("_u", "_un").orderBy(F.col("_b").desc())
    s = s.withColumn("_nb", F.lag(F.struct(F.col("_first").alias("c")), 1).over(w2))
    s = s.withColumn("_bf", F.when(F.col("_lastm.city") != F.col("_nb.c"), 1).otherwise(0))
    s = s.withColumn("_later", F.coalesce(
        F.sum(F.col("_nf") + F.col("_bf")).over(w2.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    s = s.withColumn("_latest", F.lag("_b", 1).over(w2).isNull())
    s = s.withColumn("_earliest", F.lead("_b", 1).over(w2).isNull())

    return m, s


def _bucketed_runs(messages: DataFrame, bucket_seconds: int) -> tuple[DataFrame, DataFrame]:
    """(per-message runs, per-(user, bucket) summaries)."""
    m, s = _buckets(messages, bucket_seconds)
    r = m.join(s.select(*_BUCKET, "_nb", "_bf", "_later"), _BUCKET)
    return r.select(*messages.columns, *_labels()), s


def _labels() -> list[Column]:
    """Next city, flag and run label of a message joined with its bucket's summary."""
    last_in_bucket = F.col("_nxt").isNull()
    return [F.when(last_in_bucket, F.col("_nb.c")).otherwise(F.col("_nxt.c")).alias("next_city"),
            F.when(last_in_bucket, F.col("_bf")).otherwise(F.col("_f")).alias("flag"),
            (F.col("_s") + F.col("_bf") + F.col("_later")).cast("bigint").alias("seq_label")]


def city_runs(messages: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """Gaps and islands over each user's messages, latest first.

    ``next_city`` is the city of the chronologically next message (a lag over
    descending time). ``flag`` is 1 when both cities are known and differ.
    ``seq_label`` is the running sum of flags from the latest message down,
    i.e. the number of city changes at or after this message. Input needs
    ``user_id, event_id, message_ts, city``; other columns are carried.
    """
    return _bucketed_runs(messages, bucket_seconds)[0]


def city_stays(runs: DataFrame) -> DataFrame:
    """Per (user, city, run): distinct message days and the latest message."""
    return runs.groupBy("user_id", "city", "seq_label").agg(
        F.count_distinct("day").alias("days_of_stay"),
        F.max("message_ts").alias("max_ts"),
        F.max("event_id").alias("_max_eid"))      # fixed-width buffers: hash aggregate


def long_stays(stays: DataFrame, min_days: int = 27) -> DataFrame:
    """Stays with more than ``min_days`` distinct message days."""
    return stays.where(F.col("days_of_stay") > min_days)


def home_city(runs: DataFrame, min_days: int = 27) -> DataFrame:
    """``user_id, home_city``: city of the latest stay longer than ``min_days`` days.

    A run is broken only by another city, not by days without messages. Stays
    whose city is unknown never qualify. Users without a long stay are absent.
    """
    st = long_stays(city_stays(runs.where(F.col("city").isNotNull())), min_days)
    latest = F.struct("max_ts", "_max_eid")      # equal max_ts: larger event id wins
    return st.groupBy("user_id").agg(F.max_by("city", latest).alias("home_city"))


def travels(runs: DataFrame) -> DataFrame:
    """``user_id, travel_count, travel_array`` over flagged messages (NULL sender: a group too).

    ``travel_array`` lists the cities departed from, oldest first (the current
    city is never in it). Users without a change are absent.
    """
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in ORDER], F.col("city")))),
        lambda x: x["city"])
    return (runs.where(F.col("flag") == 1).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("travel_count"), ordered.alias("travel_array")))


def users_in_cities(events: DataFrame, geo: DataFrame, min_days: int = 27,
                    bucket_seconds: int = 3600) -> DataFrame:
    """Mart: ``user_id, act_city, home_city, travel_count, travel_array, local_time``.

    Every part derives from one shuffle of the messages by (user, bucket) and
    one pass over the labelled messages: a run ends with its flagged message,
    so each stay holds at most one travel, and the user's latest message marks
    one stay with the current city and its local time.
    """
    msgs = messages_in_cities(events, geo).select("user_id", "event_id", "message_ts", "city", "tz")
    m, buckets = _buckets(msgs, bucket_seconds)
    # both sides use every shuffled column (the time zone, too), so that the messages' exchange is reused
    r = m.join(buckets.select(*_BUCKET, "_nb", "_bf", "_later", "_latest", F.col("_lastm.tz").alias("_tz")), _BUCKET)
    is_last = F.col("_latest") & (F.col("_rn") == 1)
    local = F.from_utc_timestamp("message_ts", F.coalesce("tz", "_tz"))
    runs = r.select("_u", "_un", "event_id", "message_ts", F.to_date("message_ts").alias("day"), "city", *_labels(),
                    F.when(is_last, 1).alias("last"), F.when(is_last, local).alias("local_time"))
    # fixed-width buffers (hash aggregate): a stay's only flagged message has its own time and id
    left = F.col("flag") == 1
    stays = runs.groupBy("_u", "_un", "city", "seq_label").agg(
        F.count_distinct("day").alias("days"), F.max("message_ts").alias("max_ts"),
        F.max("event_id").alias("max_eid"), F.max(F.when(left, 1)).alias("left"),
        F.max(F.when(left, F.col("message_ts"))).alias("left_ts"),
        F.max(F.when(left, F.col("event_id"))).alias("left_id"),
        F.max("last").alias("last"), F.max("local_time").alias("local_time"))
    known = ~F.col("_un")                                # metrics are those of known users
    home = known & F.col("city").isNotNull() & (F.col("days") > min_days)
    departed = F.struct("left_ts", "left_id", "city")
    per_user = stays.groupBy("_u", "_un").agg(
        F.max(F.when(F.col("last") == 1, F.col("city"))).alias("act_city"),
        F.max_by("city", F.when(home, F.struct("max_ts", "max_eid"))).alias("home_city"),
        F.count(F.when(known, F.col("left"))).alias("n"),
        F.array_sort(F.collect_list(F.when(known & (F.col("left") == 1), departed))).alias("departed"),
        F.max("local_time").alias("local_time"))
    return per_user.select(
        F.when(known, F.col("_u")).alias("user_id"), "act_city", "home_city",
        F.when(F.col("n") > 0, F.col("n")).alias("travel_count"),
        F.when(F.col("n") > 0, F.transform("departed", lambda x: x["city"])).alias("travel_array"), "local_time")


# ---------------------------------------------------------------- incremental state

def _qualifies(g, min_days: int) -> Column:
    return g["city"].isNotNull() & (g["days"] > min_days)


def _best(arr: Column, min_days: int) -> Column:
    """Latest qualifying stay of a group array, as struct(max_ts, max_eid, city)."""
    return F.array_max(F.transform(
        F.filter(arr, lambda g: _qualifies(g, min_days)),
        lambda g: F.struct(g["max_ts"].alias("max_ts"), g["max_eid"].alias("max_eid"),
                           g["city"].alias("city"))))


def _types(messages: DataFrame) -> tuple[str, str, str, str]:
    """Types of a state's last message, travels, stay groups and home, for the type of the event ids."""
    eid = messages.schema["event_id"].dataType.simpleString()
    return (f"struct<message_ts:timestamp,event_id:{eid},city:string,tz:string>",
            f"array<struct<message_ts:timestamp,event_id:{eid},city:string>>",
            f"array<struct<city:string,days:bigint,first_day:date,last_day:date,max_ts:timestamp,max_eid:{eid}>>",
            f"struct<max_ts:timestamp,max_eid:{eid},city:string>")


def _merge_groups(a: Column, b: Column) -> Column:
    """Merge stay groups by city (NULL is a key too); ``b`` is later than ``a``.

    Days add, but for one that both hold: the last of ``a`` and the first of ``b``.
    """
    def step(acc, g):
        same = lambda x: x["city"].eqNullSafe(g["city"])
        merged = F.transform(acc, lambda x: F.when(same(x), F.struct(
            x["city"].alias("city"),
            (x["days"] + g["days"] - F.coalesce((x["last_day"] == g["first_day"]).cast("bigint"), F.lit(0))).alias("days"),
            F.least(x["first_day"], g["first_day"]).alias("first_day"),
            F.greatest(x["last_day"], g["last_day"]).alias("last_day"),
            F.greatest(x["max_ts"], g["max_ts"]).alias("max_ts"),
            F.greatest(x["max_eid"], g["max_eid"]).alias("max_eid"))).otherwise(x))
        return F.when(F.exists(acc, same), merged).otherwise(F.concat(acc, F.array(g)))
    return F.aggregate(b, a, step)


def late_users(state: DataFrame, messages: DataFrame) -> DataFrame:
    """``user_id, since`` of those with new messages that are not all later than their state's last one.

    ``since`` is the time of the first new message; a message without a time
    is never later and makes it NULL. A NULL sender is a user, too.
    """
    first = messages.groupBy("user_id").agg(F.min(_chrono()).alias("_first"))
    last = state.select(F.col("user_id").alias("_su"), F.struct(*[F.col(f"last.{c}") for c in ORDER]).alias("_last"))
    return (first.join(last, F.col("user_id").eqNullSafe(F.col("_su")))
            .where(F.col("_first.message_ts").isNull() | (F.col("_first") <= F.col("_last")))
            .select("user_id", F.col("_first.message_ts").alias("since")))


# A user with more messages than these in one advance is spread over tasks.
HOT_USER_MESSAGES = 100_000


def hot_users(messages: DataFrame, limit: int | None = None) -> DataFrame:
    """``user_id`` of those with more than ``limit`` messages (default ``HOT_USER_MESSAGES``), counted once.

    At most one in ``limit`` messages has such a row. A NULL sender is a user, too.
    """
    n = messages.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return materialized(n.where(F.col("n") > (HOT_USER_MESSAGES if limit is None else limit)).select("user_id"), "hot-users")


def only(df: DataFrame, users: DataFrame, how: str) -> DataFrame:
    """``df`` semi- or anti-joined with ``users``; a NULL user is one, too."""
    u = users.select(F.col("user_id").alias("_ou"))
    return df.join(u, df["user_id"].eqNullSafe(u["_ou"]), how)


def advance_users_state(state: DataFrame | None, messages: DataFrame, min_days: int = 27,
                        bucket_seconds: int = 3600, history: DataFrame | None = None,
                        hot: DataFrame | None = None) -> DataFrame:
    """Users-mart state after appending ``messages``.

    State per user: ``last`` message, ``travels`` (flagged messages, oldest
    first), ``open`` stay groups of the current run (city, distinct days,
    latest message), ``home`` (latest closed stay longer than ``min_days``) and
    ``min_days`` itself. The new messages get the bucketed run labels; their
    earliest run joins the state's open run unless the state's last message is
    flagged against the first new city. ``state=None`` with all history is the
    full build.

    ``history``: all messages, the new ones included. Users whose new messages
    are not all later than their state (late rows) are rebuilt from it; without
    it such messages are an error of the caller.

    ``hot`` (``hot_users`` of the messages): only these users are spread over
    tasks by time buckets; all messages of any other are labelled and aggregated
    in one task after a single shuffle by user. By default, all are spread.
    """
    if state is not None and history is not None:
        late = late_users(state, messages)
        ontime = _advance(only(state, late, "left_anti"), only(messages, late, "left_anti"),
                          min_days, bucket_seconds, hot)
        return ontime.unionByName(_advance(None, only(history, late, "left_semi"), min_days, bucket_seconds, hot))
    return _advance(state, messages, min_days, bucket_seconds, hot)


_USER = ["_u", "_un"]


def _spread_rows(msgs: DataFrame, bucket_seconds: int) -> DataFrame:
    """Messages with their labels, the user's ``last`` message and those of its ``first`` city, by time buckets."""
    m, buckets = _buckets(msgs, bucket_seconds)
    # both sides use every shuffled column, so that the messages are read, located and shuffled once
    r = m.join(buckets.select(*_BUCKET, "_nb", "_bf", "_later", "_latest", "_earliest",
                              F.col("_lastm.tz").alias("_tz"), F.col("_lastm.day").alias("_day")), _BUCKET)
    is_last = F.col("_latest") & (F.col("_rn") == 1)
    same = lambda c: F.when(is_last, F.coalesce(c, f"_{c}")).otherwise(F.col(c)).alias(c)
    return r.select(*_USER, "event_id", "message_ts", same("day"), "city", same("tz"), *_labels()[1:], F.when(is_last, 1).alias("last"),
                    F.when(F.col("_earliest") & F.col("city").eqNullSafe(F.col("_first")), 1).alias("first"))


def _rows_by_user(msgs: DataFrame) -> DataFrame:
    """The same for users with few messages each: one window over all that a user has."""
    w = Window.partitionBy(*_USER).orderBy(*[F.col(c).desc() for c in ORDER])
    m = msgs.select(*_known(), "event_id", "message_ts", "day", "city", "tz")
    m = m.select("*", F.when(F.col("city") != F.lag("city").over(w), 1).otherwise(0).alias("flag"),
                 F.when(F.row_number().over(w) == 1, 1).alias("last"),
                 F.when(F.lead(F.lit(1)).over(w).isNull(), 1).alias("first"))
    label = F.sum("flag").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint")
    return m.select(*_USER, "event_id", "message_ts", "day", "city", "tz", "flag", label.alias("seq_label"), "last", "first")


def _increments(messages: DataFrame, min_days: int, bucket_seconds: int, hot: DataFrame | None) -> DataFrame:
    """What the messages add to each user's state. Hot users have a plan of their own, so that the others' needs one shuffle only."""
    msgs = messages.select("user_id", "event_id", "message_ts", "day", "city", "tz")
    if hot is None:
        return _increment(_spread_rows(msgs, bucket_seconds), min_days)
    if hot.isEmpty():
        return _increment(_rows_by_user(msgs), min_days)
    return _increment(_rows_by_user(only(msgs, hot, "left_anti")), min_days).unionByName(
        _increment(_spread_rows(only(msgs, hot, "left_semi"), bucket_seconds), min_days))


def _increment(rows: DataFrame, min_days: int) -> DataFrame:
    user, stay = _USER, [*_USER, "seq_label", "city"]
    # fixed-width buffers (hash aggregate) over the messages; names are compared over a stay's days only
    left, last = F.col("flag") == 1, F.col("last") == 1
    days = rows.groupBy(*stay, "day", "tz").agg(
        F.max("message_ts").alias("max_ts"), F.max("event_id").alias("max_eid"), F.max(F.when(left, 1)).alias("left"),
        F.max(F.when(left, F.col("message_ts"))).alias("left_ts"), F.max(F.when(left, F.col("event_id"))).alias("left_id"),
        F.max("last").alias("last"), F.max(F.when(last, F.col("message_ts"))).alias("last_ts"),
        F.max(F.when(last, F.col("event_id"))).alias("last_id"), F.max("first").alias("first"))
    grp = days.groupBy(*stay).agg(
        F.count_distinct("day").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        *[F.max(c).alias(c) for c in ("max_ts", "max_eid", "left", "left_ts", "left_id", "last", "last_ts", "last_id", "first")],
        F.max(F.when(last, F.col("tz"))).alias("last_tz"))
    gstruct = F.struct("city", "days", "first_day", "last_day", "max_ts", "max_eid")
    event = lambda k, *more: F.struct(F.col(f"{k}_ts").alias("message_ts"), F.col(f"{k}_id").alias("event_id"), "city", *more)
    # a run ends with its flagged message, so a stay holds at most one travel
    inc = grp.withColumn("L", F.max("seq_label").over(Window.partitionBy(*user))).groupBy(*user).agg(
        F.first("L").alias("L"),
        F.collect_list(F.when(F.col("seq_label") == 0, gstruct)).alias("inc_open"),
        F.collect_list(F.when(F.col("seq_label") == F.col("L"), gstruct)).alias("inc_first"),
        F.max(F.when((F.col("seq_label") > 0) & (F.col("seq_label") < F.col("L"))
                     & F.col("city").isNotNull() & (F.col("days") > min_days),
                     F.struct("max_ts", "max_eid", "city"))).alias("inc_mid"),
        F.max(F.when(last, event("last", F.col("last_tz").alias("tz")))).alias("inc_last"),
        F.max(F.when((F.col("first") == 1) & (F.col("seq_label") == F.col("L")), F.struct("city"))).alias("_fc"),
        F.array_sort(F.collect_list(F.when(F.col("left") == 1, event("left")))).alias("inc_travels"))
    return inc.select("*", F.when(~F.col("_un"), F.col("_u")).alias("user_id"), F.col("_fc.city").alias("inc_first_city")).drop(*user, "_fc")


def _advance(state: DataFrame | None, messages: DataFrame, min_days: int, bucket_seconds: int,
             hot: DataFrame | None = None) -> DataFrame:
    inc = _increments(messages, min_days, bucket_seconds, hot)
    last, trips, groups, home = _types(messages)
    if state is None:
        st = inc.select("user_id").where(F.lit(False)).select(
            "user_id", *[F.lit(None).cast(kind).alias(c) for c, kind in
                         (("last", last), ("travels", trips), ("open", groups), ("home", home))])
    else:
        differs = F.raise_error(F.lit(f"the users state was built with other min_days than {min_days}"))
        st = state.where(F.when(F.col("min_days") == min_days, True).otherwise(differs)).drop("min_days")
    # null-safe: the NULL-sender group stays one row across increments
    j = (st.withColumnRenamed("user_id", "_su")
         .join(inc, F.col("_su").eqNullSafe(F.col("user_id")), "full")
         .withColumn("user_id", F.coalesce("user_id", "_su")).drop("_su"))
    has_inc, has_st = F.col("inc_last").isNotNull(), F.col("last").isNotNull()
    f0 = (has_inc & has_st & F.col("last.city").isNotNull()
          & F.col("inc_first_city").isNotNull()
          & (F.col("last.city") != F.col("inc_first_city")))
    empty_g, empty_t = F.array().cast(groups), F.array().cast(trips)
    j = j.withColumn("_f0", f0)
    merged_first = F.when(F.col("_f0") | ~has_st, F.col("inc_first")).otherwise(
        _merge_groups(F.coalesce(F.col("open"), empty_g), F.col("inc_first")))
    j = j.withColumn("_mf", merged_first)
    new_open = (F.when(~has_inc, F.col("open"))
                .when(F.col("L") == 0, F.col("_mf")).otherwise(F.col("inc_open")))
    closed = F.concat(F.when(F.col("_f0"), F.col("open")).otherwise(empty_g),
                      F.when(has_inc & (F.col("L") > 0), F.col("_mf")).otherwise(empty_g))
    home = F.array_max(F.array_compact(F.array(F.col("home"), _best(closed, min_days),
                                               F.col("inc_mid"))))
    travels = F.concat(
        F.coalesce(F.col("travels"), empty_t),
        F.when(F.col("_f0"), F.array(F.struct(F.col("last.message_ts").alias("message_ts"),
                                              F.col("last.event_id").alias("event_id"),
                                              F.col("last.city").alias("city"))))
        .otherwise(empty_t),
        F.coalesce(F.col("inc_travels"), empty_t))
    return j.select("user_id", F.coalesce("inc_last", "last").alias("last"),
                    travels.alias("travels"), F.coalesce(new_open, empty_g).alias("open"),
                    home.alias("home"), F.lit(min_days).alias("min_days"))


def users_in_cities_from_state(state: DataFrame) -> DataFrame:
    """The users mart read off a users state (see ``advance_users_state``).

    As in the mart, a NULL sender has a latest message but no home and travels.
    """
    home = F.array_max(F.array_compact(F.array(F.col("home"), F.array_max(F.transform(
        F.filter("open", lambda g: g["city"].isNotNull() & (g["days"] > F.col("min_days"))),
        lambda g: F.struct(g["max_ts"].alias("max_ts"), g["max_eid"].alias("max_eid"),
                           g["city"].alias("city")))))))
    n = F.size("travels")
    some = F.col("user_id").isNotNull() & (n > 0)
    return state.select(
        "user_id", F.col("last.city").alias("act_city"),
        F.when(F.col("user_id").isNotNull(), home["city"]).alias("home_city"),
        F.when(some, n.cast("bigint")).alias("travel_count"),
        F.when(some, F.transform("travels", lambda x: x["city"])).alias("travel_array"),
        F.from_utc_timestamp("last.message_ts", F.col("last.tz")).alias("local_time"))
