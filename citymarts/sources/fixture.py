"""Social-event inputs derived from the driver's test tables.

``social_events`` maps the generic ``events`` table onto the event-log model
(nested ``event`` struct, coordinates, three event types, ``date``);
``geo_handbook`` maps ``nation`` onto a 25-city dimension. The same mapping is
written as SQL in ``citymarts.plans.oracle`` so that DuckDB can re-derive it.
``materialize_lake`` writes both as the partitioned STG / ODS layers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from citymarts.session import ensure_utc, new_scratch

# Time zone of each fixture region (n_regionkey 0..4).
REGION_TZ = ["UTC", "America/New_York", "Asia/Tokyo", "Europe/Moscow", "Australia/Sydney"]


def geo_handbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone_id int, city string, lat double, lon double, tz string``."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    tz = F.element_at(F.array(*[F.lit(t) for t in REGION_TZ]), F.col("n_regionkey") + 1)
    return n.select(
        F.col("n_nationkey").cast("int").alias("zone_id"),
        F.col("n_name").alias("city"),
        (F.lit(-60) + 5 * F.col("n_nationkey")).cast("double").alias("lat"),
        (F.lit(-150) + 12 * F.col("n_nationkey")).cast("double").alias("lon"),
        tz.alias("tz"))


def social_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log: ``event_id, event struct, lat, lon, event_type, date``.

    It holds what real logs hold: messages without a sender or a time, equal
    times, two spellings of a subscriber's id ("7" and "07"), and late rows (a
    partition after the message's day).
    """
    ensure_utc(spark)
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    signup = F.col("event_type") == "signup"
    etype = (F.when(signup & (F.col("event_id") % 2 == 0), "reaction")
             .when(signup, "subscription").otherwise("message"))
    hz = (F.when(F.col("user_id") % 3 == 0, F.col("user_id") % 5)
          .otherwise((F.col("user_id") + F.expr("dayofmonth(ts) div 10")) % 25))
    no_pos = F.col("event_id") % 97 == 0
    lat = F.when(~no_pos, F.expr("CAST(-60 + 5 * _hz + (event_id % 10) * 0.002 AS DOUBLE)"))
    lon = F.when(~no_pos, (F.lit(-150) + 12 * F.col("_hz")).cast("double"))
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    t = e.select("event_id", "ts", "user_id", "props", etype.alias("_type"), hz.alias("_hz"))
    msg, sub = F.col("_type") == "message", F.col("_type") == "subscription"
    i = F.col("event_id")
    time = F.when(i % 61 == 0, F.lit(None)).when(i % 10 < 3, F.date_trunc("hour", "ts")).otherwise(F.col("ts"))
    user = F.col("user_id").cast("string")
    event = F.struct(
        F.when(msg & (i % 53 != 0), F.col("user_id")).alias("message_from"),
        F.when(msg, F.col("user_id") + 15 * (1 + F.col("event_id") % 2)).alias("message_to"),
        time.cast("timestamp").alias("message_ts"),
        F.when(sub, F.when(i % 4 == 1, F.concat(F.lit("0"), user)).otherwise(user)).alias("user"),
        F.when(sub, k % 20).alias("subscription_channel"))
    day = F.to_date("ts")
    return t.select(
        "event_id", event.alias("event"), lat.alias("lat"), lon.alias("lon"),
        F.col("_type").alias("event_type"), F.when(i % 71 == 0, F.date_add(day, 1)).otherwise(day).alias("date"))


@dataclass(frozen=True)
class Lake:
    stg: str   # STG events, partitioned by date (event_type is a data column)
    ods: str   # ODS events, partitioned by date / event_type
    geo: str   # city dimension


_LAKES: dict[tuple[str, str], Lake] = {}


def materialize_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Write STG, ODS and the dimension once per session and data directory."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _LAKES:
        return _LAKES[key]
    root = new_scratch(spark, "lake")
    ev = social_events(spark, sf_dir)
    # a hash of the event beside the day, so that a day is not one task and one file
    spread = F.pmod(F.xxhash64("event_id"), F.lit(4))
    (ev.repartition("date", spread).write.mode("overwrite")
       .partitionBy("date").parquet(f"{root}/stg/events"))
    stg = spark.read.parquet(f"{root}/stg/events")     # STG -> ODS, as the pipeline does
    (stg.repartition("date", "event_type", spread).write.mode("overwrite")
        .partitionBy("date", "event_type").parquet(f"{root}/ods/events"))
    geo_handbook(spark, sf_dir).coalesce(1).write.mode("overwrite").parquet(f"{root}/geo_handbook")
    lake = Lake(f"{root}/stg/events", f"{root}/ods/events", f"{root}/geo_handbook")
    _LAKES[key] = lake
    return lake
