"""Session helpers: UTC pinning, shared scratch folders, recommended config.

All marts are computed in UTC: event timestamps are UTC instants and the
local times of the marts are derived per row from the city's time zone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins at runtime (broadcast
# conversion, partition coalescing, skew-join splitting); on a cluster set
# ``spark.sql.shuffle.partitions`` high (AQE coalesces small ones) so that a
# shuffle partition stays far below executor memory at the full data volume.
SCALE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(master: str = "local[*]", app_name: str = "citymarts",
                  shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own session instead."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone (a runtime SQL conf) to UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local (test) session without one gets its
    own folder under /tmp. A cluster session without the setting is an error:
    a machine-local folder would not be visible to other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
        import tempfile
        d = tempfile.mkdtemp(prefix="citymarts-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def new_scratch(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused folder below the shared folder."""
    return f"{shared_dir(spark)}/citymarts/{tag}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder: computed once for all its consumers, without lineage."""
    path = new_scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system and path object of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any file system that Spark reads."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def folder_state(spark: SparkSession, path: str) -> str:
    """Names, lengths and times of the files in a folder (or of the file itself)."""
    fs, p = _fs(spark, path)
    return ";".join(sorted(f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(p)))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small text file, or None where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not exist."""
    fs, p = _fs(spark, target)
    fs.mkdirs(p.getParent())
    if fs.exists(p) or not fs.rename(_fs(spark, source)[1], p):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
