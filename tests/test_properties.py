"""Properties of the marts on the sf0.01 fixture."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from citymarts.operators import activity, citystats, matches
from citymarts.plans.catalog import RUN_DATE
from citymarts.sources import lake as lk
from citymarts.sources.fixture import materialize_lake
from conftest import SF_CHECK


@pytest.fixture(scope="module")
def inputs(spark):
    lake = materialize_lake(spark, SF_CHECK)
    return lk.scan_events(spark, lake.ods), lk.read_geo_handbook(spark, lake.geo)


def test_pairs_symmetric_no_self(inputs):
    ev, geo = inputs
    m = matches.users_matches(ev, geo, RUN_DATE).select("user_left", "user_right")
    assert m.where("user_left = user_right").count() == 0
    swapped = m.select(F.col("user_right").alias("user_left"), F.col("user_left").alias("user_right"))
    assert m.exceptAll(swapped).count() == 0
    assert m.count() == m.distinct().count() > 0


def test_or_anti_join_equals_unordered_anti_join(inputs):
    ev, geo = inputs
    pairs = matches.nearby_user_pairs(matches.subscriber_profile(ev, geo), 1.0)
    c = matches.contact_pairs(ev)
    or_form = pairs.join(c, ((F.col("user_left") == F.col("message_from"))
                             & (F.col("user_right") == F.col("message_to")))
                         | ((F.col("user_left") == F.col("message_to"))
                            & (F.col("user_right") == F.col("message_from"))), "left_anti")
    ours = matches.users_matches(ev, geo, RUN_DATE)
    a = or_form.select("user_left", "user_right")
    b = ours.select("user_left", "user_right")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_travel_count_is_array_size(inputs):
    ev, geo = inputs
    u = activity.users_in_cities(ev, geo)
    assert u.where(F.col("travel_count") != F.size("travel_array")).count() == 0
    assert u.where(F.col("travel_count").isNull() != F.col("travel_array").isNull()).count() == 0
    assert u.count() == u.select("user_id").distinct().count()


def test_every_zone_once(inputs):
    ev, geo = inputs
    e = citystats.events_in_cities(ev, geo, RUN_DATE)
    assert e.count() == geo.count() == e.select("zone_id").distinct().count()


@pytest.mark.parametrize("parts", [3, 11])
def test_shuffle_partition_invariance(spark, inputs, parts):
    ev, geo = inputs
    base = activity.users_in_cities(ev, geo).collect()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        again = activity.users_in_cities(ev, geo).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    key = lambda r: (r["user_id"] is None, r["user_id"] or 0)
    assert sorted(base, key=key) == sorted(again, key=key)
