"""Prefix trie of conversations by collapse of whole sequences.

1. Turns are put in order and reduced to the digest of role and text and the
   text's bytes. A prefix's key is the exclusive or of two 64-bit hashes of its
   (position, digest) pairs, so keys are running totals.
2. Identical conversations collapse into one weighted sequence, kept through
   its smallest id, with the list of its ends (their ids).
3. A sequence whose key is a proper prefix of another is no leaf (anti join).
4. Weighted prefixes of the distinct sequences are aggregated to nodes.

Sums over subtrees need no pair of node and ancestor: every node belongs to
the smallest leaf below it. The nodes of a leaf form the lower end of its path,
so a node's sum is that of all leaves below it less what its own leaf holds
above it.

No step gathers a conversation or a group: turns are ordered by ranges, running
totals go over spans of ``SPAN`` positions with the spans' totals added, and
ends are hashed as a stream of pieces of at most ``ENDS`` ids.

Defined results: rows with a NULL conversation id take no part; a NULL turn
comes first; a NULL role or text is empty; equal turns are ordered by the
digest of role and text, repeated rows are repeated turns. A conversation
without turns ends at the root. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from citymarts.llm.components import written

SPAN = 1024     # positions whose running totals one task holds together
ENDS = 12       # ends go in pieces of ids that share all but so many low bits

_KEY = ["at", "k1", "k2"]


def ordered(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv``, ``at`` (from 1), ``digest``, ``bytes``: one row for each turn, in order.

    Equal rows are counted first; then ranges of (conversation, turn) are
    numbered on their own and the rows of earlier ranges added.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    runs = (df.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"),
                      F.octet_length(text).cast("long").alias("bytes"))
            .where("conv is not null").groupBy("conv", "turn", "digest", "bytes").agg(F.count("*").alias("n")))
    ranges = written(runs.repartitionByRange("conv", "turn", "digest").withColumn("part", F.spark_partition_id()), "turns")
    by = ["conv", "part"]
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (ranges.groupBy(*by).agg(F.sum("n").alias("size"))
             .select(*by, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")))
    upto = Window.partitionBy(*by).orderBy("turn", "digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("before") + F.col("upto")
    return (ranges.withColumn("upto", F.sum("n").over(upto)).join(sizes, by)
            .select("conv", F.explode(F.sequence(last - F.col("n") + 1, last)).alias("at"), "digest", "bytes"))


def rebuilt(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations that start like the first one of their group.

    Conversation c takes the first h turns of conversation ``c - c % group``
    (all if fewer, none if absent), then its own after its first h; h is the
    CRC-32 of c in decimal, modulo ``most``.
    """
    h = F.crc32(F.encode(F.col("conv").cast("string"), "utf-8")) % most
    lengths = turns.groupBy("conv").agg(F.max("at").alias("length"))
    convs = lengths.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), h.alias("h"))
    bases = lengths.select(F.col("conv").alias("base"), F.col("length").alias("base_length"))
    convs = written(convs.join(bases, "base", "left")
                    .withColumn("taken", F.least("h", F.coalesce("base_length", F.lit(0)))).drop("base_length"), "conversations")
    own = (turns.join(convs, "conv").where(F.col("at") > F.col("h"))
           .select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "digest", "bytes"))
    heads = turns.where((F.col("at") < most) & (F.col("conv") % group == 0)).withColumnRenamed("conv", "base")
    head = convs.join(heads, "base").where(F.col("at") <= F.col("taken")).select("conv", "at", "digest", "bytes")
    return own.unionByName(head), convs.select("conv")


def _running(rows: DataFrame, key: list[str], columns: list[str], total, add) -> DataFrame:
    """``columns`` as running totals along ``at`` within ``key``, the row's own value included."""
    by = [*key, "span"]
    rows = rows.withColumn("span", F.expr(f"(at - 1) div {SPAN}"))
    earlier = Window.partitionBy(*key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*by).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (rows.groupBy(*by).agg(*[total(c).alias(c) for c in columns])
             .select(*by, *[F.coalesce(total(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in columns]))
    out = rows.withColumns({c: total(c).over(upto) for c in columns}).join(spans, by)
    return out.withColumns({c: add(F.col(c), F.col(f"_{c}")) for c in columns}).drop("span", *[f"_{c}" for c in columns])


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each sequence's pieces, which come in order; holds one piece at a time."""
    key, digest = None, None
    for pdf in batches:
        out = []
        for at, k1, k2, text in zip(pdf["at"], pdf["k1"], pdf["k2"], pdf["ids"]):
            if (at, k1, k2) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (at, k1, k2), hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        yield pd.DataFrame(out, columns=[*_KEY, "ends"])
    if key is not None:
        yield pd.DataFrame([(*key, digest.hexdigest())], columns=[*_KEY, "ends"])


def _ends(sequences: DataFrame) -> DataFrame:
    """``at, k1, k2, ends``: the digest of the comma-joined ids that end there, in ascending order."""
    pieces = (sequences.groupBy(*_KEY, F.shiftright("conv", ENDS).alias("piece"))
              .agg(F.concat_ws(",", F.array_sort(F.collect_list("conv")).cast("array<string>")).alias("ids")))
    return (pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece").select(*_KEY, "ids")
            .mapInPandas(_streamed, "at long, k1 long, k2 long, ends string"))


def trie(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The nodes of the trie over ``turns`` (conv, at, digest, bytes).

    ``conversations`` (conv) may name conversations without turns, too. Per
    node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` and ``digest`` of its last turn.
    """
    spark = turns.sparkSession
    xor = lambda a, b: a.bitwiseXOR(b)
    tags = {f"x{i}": F.xxhash64(F.lit(i), "at", "digest") for i in (1, 2)}
    rows = turns.withColumns(tags).withColumns({"k1": F.col("x1"), "k2": F.col("x2")})
    prefixes = written(_running(rows, ["conv"], ["k1", "k2"], F.bit_xor, xor), "prefixes")
    whole = prefixes.groupBy("conv").agg(F.max("at").alias("at"), F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2"))
    if conversations is not None:
        zero = F.lit(0).cast("long")
        whole = conversations.join(whole, "conv", "left").select("conv", *[F.coalesce(c, zero).alias(c) for c in _KEY])
    whole = written(whole, "sequences")
    collapsed = whole.groupBy(*_KEY).agg(F.min("conv").alias("conv"), F.count("*").alias("weight"))
    paths = written(prefixes.join(collapsed.select("conv", "weight", F.col("at").alias("length")), "conv")
                    .select("conv", "weight", "length", *_KEY, xor(F.col("k1"), F.col("x1")).alias("p1"),
                            xor(F.col("k2"), F.col("x2")).alias("p2"), "digest", "bytes"), "paths")
    proper = paths.where("at < length").select(*_KEY).distinct()
    leaves = collapsed.where("at > 0").join(proper, _KEY, "left_anti").select("conv")
    paths = paths.join(leaves.withColumn("leaf", F.lit(True)), "conv", "left")
    nodes = (paths.groupBy(*_KEY).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.min(F.when(F.col("leaf"), F.col("conv"))).alias("owner"),
        F.count("leaf").alias("n_leaves"), *[F.first(c).alias(c) for c in ("p1", "p2", "digest", "bytes")])
        .withColumn("value", (F.col("n_convs") - 1) * F.col("bytes")).withColumn("above", F.col("value")))
    nodes = written(_running(nodes, ["owner"], ["above"], F.sum, lambda a, b: a + b)
                    .withColumn("above", F.col("above") - F.col("value")), "nodes")

    # what a node gathers: the sums of the leaves below it, its children, its ends
    held = nodes.groupBy(F.col("owner").alias("conv")).agg(F.sum("value").alias("held"))
    below = paths.where("leaf").select("conv", *_KEY).join(held, "conv").select(*_KEY, "held")
    children = nodes.select((F.col("at") - 1).alias("at"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.lit(1).alias("child"))
    ends = written(_ends(whole), "ends")
    own = nodes.drop("value", "owner", "bytes")
    every = (own.unionByName(below, True).unionByName(children, True).unionByName(ends, True)
             .where("at > 0").groupBy(*_KEY)
             .agg(*[F.max(c).alias(c) for c in own.columns if c not in _KEY], F.max("ends").alias("ends"),
                  F.count("child").alias("n_children"), F.sum("held").alias("held")))
    top = whole.agg(F.count("*").alias("n"), F.min("conv").alias("first")).first()     # one row
    if not top.n:
        return _named(every, F.lit(None).cast("long"))
    upper = nodes.select((F.col("at") + 1).alias("at"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("parent"))
    deeper = every.where("at > 1").join(upper, ["at", "p1", "p2"])
    first = every.where("at = 1").withColumn("parent", F.lit(top.first).cast("long"))
    sums = nodes.agg(F.sum("value").alias("saved"), F.count_if(F.col("at") == 1).alias("children")).first()
    n_leaves = max(1, leaves.count())
    end = ends.where("at = 0").select("ends").first()
    root = spark.createDataFrame(
        [(0, top.first, None, top.n, sums.children, n_leaves, sums.saved or 0, end.ends if end else None, None)],
        "at long, conv_id long, parent long, n_convs long, n_children long, n_leaves long, held long, ends string, digest string")
    return _named(deeper.unionByName(first).unionByName(root.withColumn("above", F.lit(0)), True), F.col("parent"))


def _named(nodes: DataFrame, parent: Column) -> DataFrame:
    return nodes.select(
        "conv_id", F.col("at").cast("long").alias("depth"), parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("held") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "digest")


def with_texts(nodes: DataFrame, df: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes of ``trie`` with the role and text of their last turn (NULL at the root)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.select(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
                      role.alias("role"), text.alias("text")).dropDuplicates(["digest"])
    return nodes.join(turns, "digest", "left")


#: The query's contract in DuckDB SQL: prefixes as strings of digests, subtrees by comparing all nodes.
SQL = """
    WITH steps AS (SELECT i, list_reduce(list_prepend(CAST(i AS UBIGINT), CAST(range(8) AS UBIGINT[])),
                       lambda a, b: xor(a >> 1, CASE WHEN a % 2 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END)) AS v
                   FROM range(256) r(i)),
         tab AS (SELECT list(v ORDER BY i) AS tab FROM steps),
         t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos, digest, bytes
               FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
                            sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
                     FROM conversations WHERE conv_id IS NOT NULL)),
         convs AS (SELECT c, c - c % 5 AS base,
                          xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
                                  list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS UBIGINT))),
                              lambda a, b: xor(a >> 8, tab[CAST(xor(a, b) % 256 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 9 AS h
                   FROM (SELECT DISTINCT c FROM t), tab),
         turns AS (SELECT convs.c, 0 AS own, pos, digest, bytes FROM convs JOIN t ON t.c = convs.base AND pos <= h
                   UNION ALL SELECT t.c, 1, pos, digest, bytes FROM convs JOIN t ON t.c = convs.c AND pos > h),
         line AS (SELECT c, row_number() OVER w AS d, bytes, string_agg(digest, '') OVER w AS k
                  FROM turns WINDOW w AS (PARTITION BY c ORDER BY own, pos ROWS UNBOUNDED PRECEDING)),
         every AS (SELECT c, d, k, bytes FROM line UNION ALL SELECT c, 0, '', 0 FROM convs),
         ends AS (SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
                  FROM (SELECT c, arg_max(k, d) AS k FROM every GROUP BY c) GROUP BY k),
         node AS (SELECT k, min(c) AS conv_id, min(d) AS depth, count(*) AS n, (count(*) - 1) * min(bytes) AS saved,
                         CASE WHEN min(d) > 0 THEN left(k, length(k) - 64) END AS p FROM every GROUP BY k),
         kids AS (SELECT p, count(*) AS n FROM node WHERE p IS NOT NULL GROUP BY p),
         tree AS (SELECT a.k, sum(b.saved) AS saved, count(*) FILTER (WHERE b.k NOT IN (SELECT p FROM kids)) AS leaves
                  FROM node a JOIN node b ON starts_with(b.k, a.k) GROUP BY a.k)
    SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
           tree.leaves AS n_leaves, CAST(tree.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM node JOIN tree USING (k) LEFT JOIN node up ON up.k = node.p LEFT JOIN kids ON kids.p = node.k LEFT JOIN ends ON ends.k = node.k"""
