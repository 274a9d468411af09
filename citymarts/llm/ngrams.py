"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Words (letters, digits, lower case) are taken five at a time; a shorter text
is one shingle. Documents with equal shingle sets form a class and are
compared once. Each class gets ``TREES`` labels of ``LEVELS`` MinHash values; by label, a
tree is a prefix trie, and classes under one of its nodes are candidates. Every
class begins at full depth, and its matched prefixes are shortened until the
recall expected reaches the target. How far that is depends on the class: the
sizes of two sets leave only some similarities, and the least of them that is
a link tells the depth at which the two must meet (a set of four shingles has
no link other than at 4/5, one of seven none below 6/7, and one of three only
copies). A class takes part at the depths that its possible partners need, no
others, so short texts stop at long prefixes and long ones at shorter ones.

Only chains of candidates are made, one link per class and node; their
components bring candidates together, so that a text is shipped once. Large
components are split into blocks of classes, compared block by block. There,
all pairs whose equal MinHash values leave a link possible, whether they share
a node or not, are verified on their whole shingle sets.
A task returns link counts and a spanning forest, never the links.

Shingles are compared by 64-bit hashes, so two different shingles count as
equal with a chance of about 2^-64.

Defined results: NULL and blank texts have no shingles and link with nothing;
so do rows with a NULL id, whose component is NULL. Repeated rows are copies.
Rows of one id with different texts are rows of their own, with their own links
and component, and each stays or goes by itself. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from citymarts.llm.components import connected_components, written
from citymarts.llm.embeddings import forest

WORDS = 5
THRESHOLD = 0.8
TARGET = 0.999       # recall of links
TREES, LEVELS = 32, 8
MARGIN = 0.15        # six standard deviations of the similarity that equal MinHash values tell
BLOCK_CLASSES, BLOCK_SIZE = 512, 2_000_000  # classes and shingles in a block of a large component
CACHED = 200_000     # words whose hash a Python worker remembers

_WORD = re.compile(r"\w+")
_rng = np.random.default_rng(20240101)
_POSITION = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_A = (_rng.integers(1, 1 << 32, TREES * LEVELS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, TREES * LEVELS, dtype=np.uint64).astype(np.uint32)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = _WORD.findall((text or "").lower())
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(h) < WORDS:
        if not len(h):
            return h
        return _mixed((h * _POSITION[:len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    total = h[:len(h) - WORDS + 1] * _POSITION[0]
    for k in range(1, WORDS):
        total = total + h[k:len(h) - WORDS + 1 + k] * _POSITION[k]
    return np.unique(_mixed(total))


def labels(sets: np.ndarray) -> np.ndarray:
    """The MinHash values of a shingle set, tree by tree (16 bits each)."""
    low = np.full(TREES * LEVELS, 0xFFFFFFFF, np.uint32)
    x = sets.astype(np.uint32)
    for start in range(0, len(x), 2048):
        part = x[start:start + 2048]
        np.minimum(low, (_A[:, None] * part[None] + _B[:, None]).min(1), out=low)
    return (low ^ (low >> np.uint32(16))).astype(np.uint16).reshape(TREES, LEVELS)


def chance(similarity: float | np.ndarray, depth: int) -> float | np.ndarray:
    """Chance that two sets of this similarity share a node of this depth in any tree."""
    return 1 - (1 - similarity ** depth) ** TREES


def nodes(label: np.ndarray, depth: int) -> np.ndarray:
    """A number for the node of this depth in each tree; ``label`` may hold many documents."""
    x = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), label.shape[:-1]).copy()
    for k in range(depth):
        x = _mixed(x * np.uint64(0x9E3779B97F4A7C15) + label[..., k].astype(np.uint64) + np.uint64(1))
    return x


@lru_cache(100_000)
def stops(size: int, threshold: float, target: float) -> tuple[int, ...]:
    """The depths at which a set of this size meets others, longest prefix first; none if it can have no links."""
    unit, t = 10_000_000, round(threshold * 10_000_000)
    other = np.arange(max(1, size * t // unit), size * unit // max(t, 1) + 2)
    common = -(-t * (size + other) // (unit + t))             # shingles that a link needs at least
    common = common[(fits := common <= np.minimum(size, other) - (other == size))]  # two sets of all the same are one class
    least = common / (size + other[fits] - common)
    found: list[int] = []
    for depth in range(LEVELS, 0, -1):
        reached = chance(least, depth) >= target if depth > 1 else np.ones(len(least), bool)
        if reached.any():
            found.append(depth)
        least = least[~reached]
    return tuple(found)


# -- tasks -------------------------------------------------------------------

def _signing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for i, same, text in zip(pdf["id"], pdf["same"], pdf["text"]):
            s = shingles(text)
            if len(s):
                rows.append((i, same, xxhash.xxh3_128_digest(s.tobytes()), len(s), labels(s).tobytes()))
        yield pd.DataFrame(rows, columns=["id", "same", "set", "size", "label"])


def _labels(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(data), np.uint16).reshape(len(data), TREES, LEVELS)


def _placing(threshold: float, target: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The nodes of every class at the depths that it takes part at."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            label, rep = _labels(list(pdf["label"])), pdf["rep"].to_numpy()
            at = [stops(n, threshold, target) for n in pdf["size"].tolist()]
            for depth in sorted({d for s in at for d in s}):
                here = np.array([depth in s for s in at])
                found = nodes(label[here], depth)
                yield pd.DataFrame({"node": found.astype(np.int64).ravel(), "rep": np.repeat(rep[here], TREES)})
    return run


def compare(left: pd.DataFrame, right: pd.DataFrame | None,
            threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other row, similarity) of the links within ``left``, or between ``left`` and ``right``."""
    sets_l = [shingles(t) for t in left["text"]]
    sets_r = sets_l if right is None else [shingles(t) for t in right["text"]]
    if not sets_l or not sets_r:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    flat = lambda x: _labels(list(x["label"])).reshape(len(x), -1)
    label_l = flat(left)
    label_r = label_l if right is None else flat(right)
    least = (threshold - MARGIN) * TREES * LEVELS
    n_r = np.array([len(s) for s in sets_r])
    every, at = np.unique(np.concatenate(sets_r), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(n_r)])
    hit = np.zeros(len(every) + 1, bool)
    rows, others, similar = [], [], []
    for i, s in enumerate(sets_l):
        j = np.flatnonzero(np.count_nonzero(label_r == label_l[i], axis=1) >= least)
        if right is None:
            j = j[j > i]
        small, large = np.minimum(n_r[j], len(s)), np.maximum(n_r[j], len(s))
        j = j[small >= threshold * large]
        if not len(j):
            continue
        own = np.searchsorted(every, s)
        own = own[every[np.minimum(own, len(every) - 1)] == s]
        hit[own] = True
        # shingles of the candidates, one after another, and how many of them are the row's own
        lengths = n_r[j]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1]) + np.repeat(starts[j] - (ends - lengths), lengths)
        common = np.add.reduceat(hit[at[place]].astype(np.int64), ends - lengths)
        hit[own] = False
        # in whole numbers of tenths of a millionth, so that a similarity of exactly the threshold is a link
        union = len(s) + lengths - common
        linked = common * 10_000_000 >= round(threshold * 10_000_000) * union
        rows.append(np.full(int(linked.sum()), i))
        others.append(j[linked])
        similar.append(common[linked] / union[linked])
    if not rows:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(rows), np.concatenate(others), np.concatenate(similar)


def _verifying(threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows come sorted by block pair; ``side`` tells a pair's left block (0) from its right one (1)."""
    def one(rows: list[tuple]) -> pd.DataFrame:
        pdf = pd.DataFrame(rows, columns=["rep", "weight", "label", "text", "side", "both"]).drop_duplicates(["rep", "side"])
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        i, j, _ = compare(left, None if pdf["both"].iloc[0] else right, threshold)
        right = left if pdf["both"].iloc[0] else right
        a, b = left["rep"].to_numpy()[i], right["rep"].to_numpy()[j]
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = at[:len(a)], at[len(a):]
        n = len(ids)
        weights = (np.bincount(x, right["weight"].to_numpy()[j], n) + np.bincount(y, left["weight"].to_numpy()[i], n))
        return pd.DataFrame({"rep": ids, "links": weights.astype(np.int64), "root": ids[forest(x, y, n)] if n else ids})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for pdf in batches:
                yield from pdf.itertuples(index=False, name=None)
        out, size = [], 0
        for _, group in groupby(rows(), key=lambda r: r[:3]):
            found = one([r[3:] for r in group])
            if len(found):
                out.append(found)
                size += len(found)
            if size > 10_000:
                yield pd.concat(out)
                out, size = [], 0
        if out:
            yield pd.concat(out)
    return run


# -- the operator ------------------------------------------------------------

def _candidates(classes: DataFrame, threshold: float, target: float) -> DataFrame:
    """(a, b): links that hold together the classes under each node."""
    under = written(classes.select("label", "size", "rep").mapInPandas(_placing(threshold, target), "node long, rep long"), "nodes")
    shared = under.groupBy("node").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count("*").alias("n")).where("n > 1")
    shared = written(shared, "shared-nodes")
    more = under.join(shared.where("n > 2").select("node", "a"), "node").select("a", F.col("rep").alias("b"))
    return shared.select("a", "b").unionByName(more).where("a <> b").distinct()


def _verified(texts: DataFrame, classes: DataFrame, threshold: float, target: float) -> DataFrame:
    parts = connected_components(_candidates(classes, threshold, target)).withColumnRenamed("id", "rep")
    members = written(classes.join(parts, "rep").select("rep", "id", "same", "weight", "size", "label", "component"), "members")
    blocks = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("size") / BLOCK_SIZE)).cast("int").alias("blocks"))
    placed = (members.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
              .join(texts, ["id", "same"]))
    block = F.explode(F.expr("sequence(0, blocks - 1)"))
    pairs = placed.withColumn("other", block).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "weight", "label", "text",
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), (F.col("own") == F.col("other")).alias("both"))
    dealt = pairs.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return written(dealt.mapInPandas(_verifying(threshold), "rep long, links long, root long"), "ngram-links")


def _grouped(rows: DataFrame, threshold: float, target: float) -> DataFrame:
    """``id, same, n_links, group`` of the rows (id, same, text) that have shingles, one for each (id, same).

    ``same`` tells the texts of one id apart. A class of equal sets is numbered
    when it is written, so ids play no part in telling classes apart.
    """
    signed = written(rows.where("id is not null").mapInPandas(
        _signing, "id long, same long, set binary, size int, label binary"), "signatures")
    classes = (signed.groupBy("set").agg(F.min(F.struct("id", "same")).alias("first"), F.count("*").alias("weight"),
                                         F.first("size").alias("size"), F.first("label").alias("label"))
               .select("set", "first.id", "first.same", "weight", "size", "label", F.monotonically_increasing_id().alias("rep")))
    classes = written(classes, "classes")
    found = _verified(rows, classes, threshold, target)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per_class = (classes.select("set", "rep", "weight").join(links, "rep", "left")
                 .join(parts.withColumnRenamed("id", "rep"), "rep", "left")
                 .select("set", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("group")))
    return written(signed.select("id", "same", "set").distinct().join(per_class, "set").drop("set"), "grouped")


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("same", F.xxhash64("text"))


def join(df: DataFrame, threshold: float = THRESHOLD, target: float = TARGET, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly, copies included) and ``component_id`` (its smallest id)."""
    rows = _rows(df, id_col, text_col)
    grouped = _grouped(rows, threshold, target)
    smallest = grouped.groupBy("group").agg(F.min("id").alias("component_id"))
    known = grouped.join(smallest, "group").select("id", "same", "n_links", "component_id")
    # rows without shingles are not grouped
    return (rows.select("id", "same").join(known, ["id", "same"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id")))


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    target: float = TARGET) -> DataFrame:
    """One row of each group of near copies (that with the smallest id), and all rows without shingles, with all columns."""
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    i, t = names[df.columns.index(id_col)], names[df.columns.index(text_col)]
    grouped = _grouped(_rows(rows, i, t), threshold, target)
    first = grouped.groupBy("group").agg(F.min(F.struct("id", "same")).alias("first"))
    flags = (grouped.join(first, "group")
             .select("id", "same", F.struct("id", "same").eqNullSafe(F.col("first")).alias("stays")))
    told = rows.withColumns({"_id": F.col(i).cast("long"), "_same": F.xxhash64(F.col(t).cast("string"))})
    told = told.join(flags, (told["_id"] == flags["id"]) & (told["_same"] == flags["same"]), "left")
    kept = told.where("stays").dropDuplicates(["_id", "_same"]).select(*names)
    return kept.unionByName(told.where("stays is null").select(*names)).toDF(*df.columns)
