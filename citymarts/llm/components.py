"""Connected components of a link table by contraction, with joins only.

Each round points every node to its smallest neighbour (or to itself), flattens
these trees by pointer doubling, and replaces the links by those between
roots. At least half of the linked nodes vanish in a round, so the rounds grow
with the logarithm of the nodes; a node with very many links only takes part
in a partially aggregated minimum and in joins. Every round is written to the
shared folder, so lost executors cost no more than the current round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citymarts.session import new_scratch


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, without lineage."""
    spark = df.sparkSession
    path = new_scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node in ``links``; the component is its smallest id.

    Links to oneself, repeated links and either direction are allowed; links
    with a NULL end are ignored.
    """
    edges = written(_ordered(links.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy(F.col("a").alias("id"))
                         .agg(F.least(F.first("a"), F.min("b")).alias("root")), "parents")
        while True:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("top"))
            flat = written(parent.join(up, "root").select("id", F.col("top").alias("root"),
                                                          (F.col("top") != F.col("root")).alias("moved")), "parents")
            parent = flat.select("id", "root")
            if flat.where("moved").isEmpty():
                break
        up = parent.select(F.col("id").alias("component"), F.col("root").alias("top"))
        labels = (parent.withColumnRenamed("root", "component") if labels is None else
                  written(labels.join(up, "component", "left")
                          .select("id", F.coalesce("top", "component").alias("component")), "labels"))
        ends = lambda c: parent.select(F.col("id").alias(c), F.col("root").alias(f"r{c}"))
        edges = written(_ordered(edges.join(ends("a"), "a").join(ends("b"), "b")
                                 .select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels


def _ordered(links: DataFrame) -> DataFrame:
    return (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                         (F.col("a") < F.col("b")).alias("x"), (F.col("a") > F.col("b")).alias("y"))
            .where("x or y").select("a", "b").distinct())
