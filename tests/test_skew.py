"""A user holding a third of all messages is split across tasks, with exact results."""

from __future__ import annotations

import random

from pyspark.sql import Window, functions as F

from citymarts.operators import activity
from conftest import make_events, make_geo, ts

CITIES = {"A": (0.0, 0.0), "B": (10.0, 10.0), "C": (20.0, 20.0)}


def _rows():
    rnd = random.Random(5)
    rows, eid = [], 0
    for i in range(3000):                           # hot user 0: one message a minute
        c = "AB"[(i // 200) % 2] if i % 37 else None
        lat, lon = CITIES[c] if c else (None, None)
        rows.append({"event_type": "message", "message_from": 0, "ts": ts("2024-01-01", i * 60),
                     "lat": lat, "lon": lon, "event_id": eid})
        eid += 1
    for u in range(1, 201):                         # 200 ordinary users, 30 messages each
        for j in range(30):
            c = rnd.choice("ABC")
            lat, lon = CITIES[c]
            rows.append({"event_type": "message", "message_from": u,
                         "ts": ts("2024-01-01", rnd.randrange(0, 3 * 86400)),
                         "lat": lat, "lon": lon, "event_id": eid})
            eid += 1
    return rows


def test_hot_user_is_split_and_exact(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        geo = make_geo(spark, [(1, "A", 0.0, 0.0, "UTC"), (2, "B", 10.0, 10.0, "UTC"),
                               (3, "C", 20.0, 20.0, "UTC")])
        ev = make_events(spark, _rows())
        msgs = activity.messages_in_cities(ev, geo).select(
            "user_id", "event_id", "message_ts", "day", "city")
        hot = (activity.bucket_partitioned(msgs, 3600).where("user_id = 0")
               .groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(hot) >= 6                          # 50 hourly buckets over 8 partitions
        assert max(r["count"] for r in hot) <= 3000 / 3

        got = activity.city_runs(msgs, 3600).select("event_id", "next_city", "flag", "seq_label")
        w = Window.partitionBy("user_id").orderBy(F.desc("message_ts"), F.desc("event_id"))
        flag = F.when(F.col("city") != F.col("next_city"), 1).otherwise(0)
        ref = (msgs.withColumn("next_city", F.lag("city").over(w))
               .withColumn("flag", flag)
               .withColumn("seq_label", F.sum("flag").over(
                   w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint"))
               .select("event_id", "next_city", "flag", "seq_label"))
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_pair_key_is_salted_and_exact(spark):
    from citymarts.functions.geo import haversine_km
    from citymarts.operators import matches
    rnd = random.Random(9)
    prof = [(u, [1, 2] if u % 3 else [1], 45.0 + rnd.uniform(0, 0.004), 7.0 + rnd.uniform(0, 0.004),
             1, None) for u in range(300)]                    # one dense cell, shared channel
    prof += [(1000 + u, [rnd.randint(3, 9)], rnd.uniform(-60, 60), rnd.uniform(-170, 170), 2, None)
             for u in range(300)]
    p = spark.createDataFrame(prof, "user_id bigint, sub_channels_array array<bigint>, "
                                    "last_message_lat double, last_message_lon double, "
                                    "city_id int, local_time timestamp")
    salted = matches.nearby_pairs_unordered(p, 1.0, hot_key_users=40)
    plain = matches.nearby_pairs_unordered(p, 1.0, hot_key_users=10 ** 9)
    d = haversine_km("x.last_message_lat", "x.last_message_lon",
                     "y.last_message_lat", "y.last_message_lon")
    brute = (p.alias("x").join(p.alias("y"), F.col("x.user_id") < F.col("y.user_id"))
             .where((d < 1.0) & F.arrays_overlap("x.sub_channels_array", "y.sub_channels_array"))
             .select(F.col("x.user_id").alias("a"), F.col("y.user_id").alias("b")))
    for got in (salted, plain):
        got = got.select("a", "b")
        assert got.exceptAll(brute).count() == 0 and brute.exceptAll(got).count() == 0
    assert brute.count() > 40000
