"""Scans of the event lake and the city dimension.

Periods are expressed as predicates on the ``date`` partition column, so
Catalyst prunes partitions (``PartitionFilters``) instead of the caller
building path lists; a missing day yields no rows rather than a failure,
unless ``require_complete`` asks for a check.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

from citymarts.functions.geo import checked, remember
from citymarts.session import child_names, folder_state

FOOTERS_AT_A_TIME = 16   # days whose schemas are looked up side by side

EVENT_STRUCT = StructType([
    StructField("message_from", LongType()),
    StructField("message_to", LongType()),
    StructField("message_ts", TimestampType()),
    StructField("user", StringType()),
    StructField("subscription_channel", LongType()),
])

# ODS layout: data columns, then the partition columns date / event_type.
ODS_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("event", EVENT_STRUCT),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("date", DateType()),
    StructField("event_type", StringType()),
])

GEO_SCHEMA = StructType([
    StructField("zone_id", IntegerType()),
    StructField("city", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("tz", StringType()),
])


def as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def period(run_date, depth: int) -> tuple[dt.date, dt.date]:
    """``[run_date - depth, run_date - 1]`` as (first day, last day)."""
    d = as_date(run_date)
    return d - dt.timedelta(days=depth), d - dt.timedelta(days=1)


def _type_of(df: DataFrame, path: str) -> str | None:
    """The type of column ``path`` (``a`` or ``a.b``), or None where the files lack it."""
    holder, _, name = path.rpartition(".")
    fields = df.schema[holder].dataType if holder and holder in df.columns else df.schema
    if (holder and holder not in df.columns) or name not in fields.names:
        return None
    return fields[name].dataType.simpleString()


def _field(df: DataFrame, path: str, kind: str | None) -> Column:
    """Column ``path`` with the type ``kind``; NULL where the files lack it.

    A value that cannot be cast gives NULL. ``kind`` None keeps the file's own type.
    """
    own = _type_of(df, path)
    if own is None:
        return F.lit(None).cast(kind or "bigint")
    return F.col(path) if kind in (None, own) else F.col(path).try_cast(kind)


def scan_events(spark: SparkSession, root: str, days: list[dt.date] | None = None, reconcile: bool = False,
                tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Whole ODS table with partition discovery (``date``, ``event_type``), or some ``days`` of it.

    The files' own schema is read: ``message_ts`` may be a string (a bad one
    gives NULL), ids may be strings, the channel is an opaque key of any type,
    and ``event_id`` may be missing. With ``days`` only the folders of these
    days are listed and read, whatever the lake holds besides.

    Without ``reconcile`` one file's schema stands for all. With it every day's
    own schema is looked up (a footer a day), days of equal schemas are read
    together, and each group is brought to the types above; a column that a day
    lacks is NULL there, and a channel of several types becomes a string. Days
    whose schemas differ from file to file are not taken apart.

    ``tie_breakers`` names columns of the files (``a`` or ``a.b``) that order
    messages of equal times where the log has no event key: ``event_id`` is
    then that column, or a struct of them in this order.
    """
    if days is None and reconcile:
        days = sorted(as_date(n.removeprefix("date=")) for n in child_names(spark, root) if n.startswith("date="))
    if days is None:
        groups = [spark.read.parquet(root)]
    elif not days:
        groups = [spark.read.parquet(root).limit(0)]
    else:
        read = lambda some: spark.read.option("basePath", root).parquet(*[_day_path(root, d) for d in some])
        groups = [read(some) for some in (_by_schema(spark, root, days) if reconcile else [days])]
    channels = {_type_of(df, "event.subscription_channel") for df in groups} - {None}
    channel = "string" if len(channels) > 1 else next(iter(channels), None)
    return reduce(DataFrame.unionByName, [_normal(df, channel, tie_breakers) for df in groups])


def _day_path(root: str, day: dt.date) -> str:
    return f"{root}/date={day.isoformat()}"


def _by_schema(spark: SparkSession, root: str, days: list[dt.date]) -> list[list[dt.date]]:
    """The days by the schema of their files."""
    found: dict[str, list[dt.date]] = {}
    with ThreadPoolExecutor(FOOTERS_AT_A_TIME) as pool:
        for day, schema in zip(days, pool.map(lambda d: spark.read.parquet(_day_path(root, d)).schema.simpleString(), days)):
            found.setdefault(schema, []).append(day)
    return list(found.values())


def _normal(df: DataFrame, channel: str | None, tie_breakers: Sequence[str]) -> DataFrame:
    """``df`` in the columns and types of the event log."""
    event = F.struct(
        _field(df, "event.message_from", "bigint").alias("message_from"),
        _field(df, "event.message_to", "bigint").alias("message_to"),
        _field(df, "event.message_ts", "timestamp").alias("message_ts"),
        _field(df, "event.user", "string").alias("user"),
        _field(df, "event.subscription_channel", channel).alias("subscription_channel"))
    order = [_field(df, c, None) for c in tie_breakers]
    key = (F.struct(*[c.alias(f"t{i}") for i, c in enumerate(order)]) if len(order) > 1 else
           order[0] if order else _field(df, "event_id", "bigint"))
    return df.select(key.alias("event_id"), event.alias("event"),
                     _field(df, "lat", "double").alias("lat"), _field(df, "lon", "double").alias("lon"),
                     _field(df, "date", "date").alias("date"),
                     _field(df, "event_type", "string").alias("event_type"))


@dataclass(frozen=True)
class EventLake:
    """An ODS folder and how the jobs read it: day by day schemas, and the order of equal times."""

    root: str
    reconcile: bool = True
    tie_breakers: tuple[str, ...] = ()

    @staticmethod
    def of(lake: str | EventLake) -> EventLake:
        return lake if isinstance(lake, EventLake) else EventLake(lake)

    def scan(self, spark: SparkSession, days: list[dt.date] | None = None) -> DataFrame:
        return scan_events(spark, self.root, days, self.reconcile, self.tie_breakers)


def scan_date_partition(spark: SparkSession, root: str, day) -> DataFrame:
    """One ``date=`` partition by its own path: the ``date`` column is absent, all
    columns of that day are there, and a missing day raises at once."""
    return spark.read.parquet(f"{root}/date={as_date(day).isoformat()}")


def in_period(run_date, depth: int) -> Column:
    first, last = period(run_date, depth)
    return (F.col("date") >= F.lit(first)) & (F.col("date") <= F.lit(last))


def scan_date_range(events: DataFrame, run_date, depth: int,
                    require_complete: bool = False) -> DataFrame:
    """Events of the ``depth`` days before ``run_date`` (run date excluded)."""
    out = events.where(in_period(run_date, depth))
    if require_complete:
        _check_complete(out, run_date, depth)
    return out


def scan_message_range(events: DataFrame, run_date, depth: int,
                       require_complete: bool = False) -> DataFrame:
    """Same period, ``event_type = 'message'`` partitions only."""
    out = events.where(in_period(run_date, depth) & (F.col("event_type") == "message"))
    if require_complete:
        _check_complete(out, run_date, depth)
    return out


def _check_complete(df: DataFrame, run_date, depth: int) -> None:
    first, last = period(run_date, depth)
    days = df.select("date").distinct()   # partition-only: answered from metadata
    want = df.sparkSession.range(depth).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
    missing = sorted(r["date"].isoformat() for r in want.join(days, "date", "left_anti").collect())
    if missing:
        raise FileNotFoundError(f"missing event partitions: {', '.join(missing)}")


def filter_history_before(events: DataFrame, before) -> DataFrame:
    """Rows strictly before ``before`` (a date)."""
    return events.where(F.col("date") < F.lit(as_date(before)))


def validate_geo(geo: DataFrame) -> DataFrame:
    """Fail the job if ``zone_id`` repeats (joins on it would fan out); names may repeat."""
    dup = F.count(F.lit(1)) != F.count_distinct("zone_id")
    check = geo.agg(F.when(dup, F.raise_error(F.lit("geo_handbook: zone_id not unique")))
                    .otherwise(F.lit(True)).alias("ok"))
    return geo.where(check.scalar())


_CHECKED: dict[tuple[str, str], str] = {}   # digests of the dimensions read so far, by path and files


def read_geo_handbook(spark: SparkSession, path: str) -> DataFrame:
    """The city dimension. That ``zone_id`` is unique is checked, and its content digested, once for the files as they are."""
    geo = spark.read.schema(GEO_SCHEMA).parquet(path)
    key = path, folder_state(spark, path)
    if key not in _CHECKED:
        _CHECKED[key] = checked(geo)
    return remember(geo, _CHECKED[key])


def geo_handbook_from_csv(spark: SparkSession, csv_path: str, out_path: str,
                          sep: str = ",") -> str:
    """One-off load of the city dimension from CSV (header row) into Parquet."""
    df = spark.read.schema(GEO_SCHEMA).option("header", True).option("sep", sep).csv(csv_path)
    df.coalesce(1).write.mode("overwrite").parquet(out_path)
    return out_path
