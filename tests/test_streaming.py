"""The streaming increment: exactly-once catch-up over new STG days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from citymarts.session import new_scratch
from citymarts.sources.fixture import materialize_lake
from citymarts.sources.lake import scan_events
from citymarts.streaming.increment import run_increment_stream
from conftest import SF_SMOKE


def test_stream_catches_up_exactly_once(spark):
    lake = materialize_lake(spark, SF_SMOKE)
    root = new_scratch(spark, "test-stream")
    stg, ods, ckpt = f"{root}/stg", f"{root}/ods", f"{root}/ckpt"
    src = spark.read.parquet(lake.stg)
    cut = F.lit(dt.date(2024, 1, 20))
    src.where(F.col("date") < cut).write.partitionBy("date").parquet(stg)
    run_increment_stream(spark, stg, ods, ckpt)
    first = scan_events(spark, ods)
    assert first.count() == src.where(F.col("date") < cut).count()
    src.where(F.col("date") >= cut).write.mode("append").partitionBy("date").parquet(stg)
    run_increment_stream(spark, stg, ods, ckpt)      # only the new files
    back = scan_events(spark, ods)
    assert back.count() == src.count()
    assert back.select("event_id").distinct().count() == src.count()
    assert back.where("event_type = 'message'").count() == \
        src.where("event_type = 'message'").count()
