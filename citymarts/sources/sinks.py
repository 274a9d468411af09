"""Writes: the daily STG -> ODS increment, snapshots published whole; partitioning by keys."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from citymarts.session import child_names, move, path_exists, remove, write_text
from citymarts.sources.lake import as_date, scan_date_partition


def load_increment(spark: SparkSession, run_date, stg_root: str, ods_root: str) -> dt.date:
    """Copy day ``run_date - 1`` from STG into ``{ods}/date=<day>/event_type=...``.

    A static overwrite of the date directory: a re-load replaces the whole day,
    so an event type that vanished from the source does not linger. The day's
    own folder is read, so it keeps all its columns, and a day that STG does
    not have fails the load before anything is written. One scan, no shuffle.
    """
    day = as_date(run_date) - dt.timedelta(days=1)
    publish(scan_date_partition(spark, stg_root, day), f"{ods_root}/date={day.isoformat()}", partition_by=["event_type"])
    return day


def write_snapshot(df: DataFrame, root: str, run_date) -> str:
    """Replace the ``date=<run_date>`` snapshot of a mart."""
    return publish(df, f"{root}/date={as_date(run_date).isoformat()}")


def publish(df: DataFrame, path: str, notes: dict[str, str] | None = None, partition_by: list[str] | None = None) -> str:
    """Write ``df`` beside ``path`` and put it in its place once it is whole.

    A write that fails or is killed leaves the former table as it was; what it
    has written stays in a folder that Spark's readers skip and goes with the
    next publication there. The switch is two renames: the former table steps
    aside before the new one takes its name, and a run that dies in between
    finds it put back by the next ``publish`` (or ``restore``). ``notes`` are
    small text files in the table's folder, also skipped by readers.
    """
    spark = df.sparkSession
    parent, name = _beside(path)
    restore(spark, path)
    for left in child_names(spark, parent):
        if left.startswith(f"_new-{name}-"):
            remove(spark, f"{parent}/{left}")
    tag = uuid.uuid4().hex[:12]
    staged, former = f"{parent}/_new-{name}-{tag}", f"{parent}/_old-{name}-{tag}"
    write = df.write.partitionBy(*partition_by) if partition_by else df.write
    write.parquet(staged)
    for file, text in (notes or {}).items():
        write_text(spark, f"{staged}/{file}", text)
    if path_exists(spark, path):
        move(spark, path, former)
    move(spark, staged, path)
    remove(spark, former)
    return path


def _beside(path: str) -> tuple[str, str]:
    """The folder above and the name; without "=", or readers would take what carries it for a partition."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name.replace("=", "-")


def restore(spark: SparkSession, path: str) -> None:
    """Put back a table that stepped aside for one that never came; drop former ones that were replaced."""
    parent, name = _beside(path)
    for former in sorted(n for n in child_names(spark, parent) if n.startswith(f"_old-{name}-")):
        if path_exists(spark, path):
            remove(spark, f"{parent}/{former}")
        else:
            move(spark, f"{parent}/{former}", path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_partitioned(df: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """Hash-partition into exactly ``n`` partitions (default: shuffle partitions)."""
    return df.repartition(n or shuffle_partitions(df.sparkSession), *keys)
