"""The STG -> ODS increment as a Structured Streaming job.

``readStream`` over the date-partitioned STG folder tells which days have new
files (the stream checkpoint records what was read); every such day is then
loaded by the batch ``load_increment``, which replaces the whole day. So a
retried micro-batch, a re-written STG day or a second run never duplicates
rows. Use the ``availableNow`` trigger for a scheduled catch-up, or a
processing-time trigger to follow STG continuously.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from citymarts.sources.sinks import load_increment

_DAY = StructType([StructField("date", DateType())])   # the partition column is all the stream needs


def start_increment_stream(spark: SparkSession, stg_root: str, ods_root: str,
                           checkpoint_location: str, available_now: bool = True,
                           processing_time: str = "1 hour",
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; the caller waits on / stops the returned query."""
    reader = spark.readStream.schema(_DAY)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def load(batch: DataFrame, _id: int) -> None:
        for r in batch.select("date").distinct().orderBy("date").collect():   # days, not rows
            load_increment(batch.sparkSession, r.date + dt.timedelta(days=1), stg_root, ods_root)
    writer = (reader.parquet(stg_root).writeStream.foreachBatch(load)
              .option("checkpointLocation", checkpoint_location))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()


def run_increment_stream(spark: SparkSession, stg_root: str, ods_root: str,
                         checkpoint_location: str) -> None:
    """Catch up on all new STG files, then return."""
    start_increment_stream(spark, stg_root, ods_root, checkpoint_location).awaitTermination()
