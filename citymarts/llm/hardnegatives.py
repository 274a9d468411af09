"""Hard-negative mining by threshold joins in the manner of L2AP.

Vectors are compared by the integer inner product of ``floor(scale * x)``.
Rows of the same label and vector form a class and are compared once; a class
keeps its smallest ids, as many as a result can name.

Two joins of the anchors' classes with all classes, in blocks:

1. *positives*: the highest scores inside the anchor's own label;
2. *negatives*: for each positive score p the highest scores between ``low``
   and ``high`` per cent of p among the other labels (a window).

A task holds one block of classes and one of anchors. Its inverted index lists
the vectors by groups of dimensions, those with the least mass first. For a
threshold t, a vector's leading groups are left out of the lists as long as
their norm times the anchor's stays below t: they cannot reach t alone. Scores
are accumulated from the last group to the first; what remains of a pair is
bounded by the product of the remaining norms, and pairs that cannot reach t
any more are dropped. Survivors are completed with the groups left out. A task
starts with a high threshold and lowers it for the anchors whose windows are
not full yet, down to the bound of the window, so nothing is missed: results
are exact.

Defined results: rows with a NULL id, label or vector or a NULL or non-finite
component take no part, nor do rows whose integer vector has a squared length
of 2^62 or more (its scores may not fit a long). A component that a shorter
vector lacks counts as 0. Repeated rows (equal id, label and vector) count
once; rows of one id with other contents are rows of their own, and each of an
anchor's is mined. Ties go to the smaller id. An anchor without positives, or
with a positive that no window reaches (a negative score), yields no row. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from citymarts.llm.components import written

ROWS, ANCHORS = 8192, 2048     # classes and anchors of a task
TOGETHER = 128                 # anchors whose scores are accumulated side by side
GROUP = 8                      # dimensions of a group
SPARSE = 0.25                  # below this share of live pairs they are listed one by one
FIRST, LOWER, LAST = 0.9, 0.75, 0.05   # thresholds as shares of the largest possible score
EXACT = 1 << 52                # squared length up to which doubles hold every partial sum


class BlockIndex:
    """Inverted index over a block of integer vectors (one per row)."""

    def __init__(self, rows: np.ndarray):
        mass = (rows.astype(np.float64) ** 2).sum(0)
        self.order = np.argsort(mass, kind="stable")
        self.rows = rows[:, self.order]
        self.cuts = [*range(0, rows.shape[1], GROUP), rows.shape[1]] if rows.shape[1] else [0]
        self.norms = self._norms(self.rows)

    def _norms(self, x: np.ndarray) -> np.ndarray:
        """Norm of the leading groups: column g covers the groups before g."""
        square = np.cumsum(x.astype(np.float64) ** 2, 1)
        square = np.concatenate([np.zeros((len(x), 1)), square], 1)
        return np.sqrt(square[:, self.cuts])

    def search(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (anchor, row, score) whose score is at least the anchor's threshold."""
        x, nx = anchors[:, self.order], self._norms(anchors[:, self.order])
        bound = least.astype(np.float64) - 1e-6 * np.abs(least) - 0.5   # rounding of the norms loses no pair
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(nx[:, -1] > 0, bound / nx[:, -1], np.where(bound > 0, np.inf, -np.inf)).min(initial=np.inf)
        left_out = (self.norms < ratio).sum(1) - 1      # groups before the first that is listed
        left_out = np.where(self.norms[:, -1] < ratio, len(self.cuts), np.maximum(left_out, 0))
        by = np.argsort(left_out, kind="stable")        # the list of group g is a prefix
        listed = np.searchsorted(left_out[by], np.arange(len(self.cuts)), side="right")
        n = int(listed[-1])
        y, ny, out = self.rows[by[:n]], self.norms[by[:n]], left_out[by[:n]]
        score = np.zeros((len(x), n), y.dtype)
        pairs = None
        for g in range(len(self.cuts) - 2, -1, -1):
            a, b, m = self.cuts[g], self.cuts[g + 1], int(listed[g])
            if pairs is None:
                score[:, :m] += x[:, a:b] @ y[:m, a:b].T
                live = score + nx[:, np.maximum(out, g)] * ny[np.arange(n), np.maximum(out, g)] >= bound[:, None]
                if live.mean() < SPARSE:
                    pairs = np.nonzero(live)
                    total = score[pairs]
            else:
                i, j = pairs
                on = j < m
                total[on] += np.einsum("ij,ij->i", x[i[on], a:b], y[j[on], a:b])
                rest = np.maximum(out[j], g)
                live = total + nx[i, rest] * ny[j, rest] >= bound[i]
                pairs, total = (i[live], j[live]), total[live]
        if pairs is None:
            rest = out if len(self.cuts) > 1 else np.zeros(n, int)
            pairs = np.nonzero(score + nx[:, rest] * ny[np.arange(n), rest] >= bound[:, None])
            total = score[pairs]
        i, j = pairs
        for g in range(int(out.max(initial=0))):        # the groups left out complete the score
            on = out[j] > g
            a, b = self.cuts[g], self.cuts[g + 1]
            total[on] += np.einsum("ij,ij->i", x[i[on], a:b], y[j[on], a:b])
        good = total >= least[i]
        return i[good], by[j[good]], total[good]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _both(rows: pd.DataFrame, anchors: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Matrices of rows and anchors, in doubles where these are exact."""
    width = max(map(len, [*rows["vec"], *anchors["vec"]]), default=0)
    y, x = _matrix(rows["vec"], width), _matrix(anchors["vec"], width)
    large = max(float((m.astype(np.float64) ** 2).sum(1).max(initial=0)) for m in (x, y))
    return (y.astype(np.float64), x.astype(np.float64)) if large < EXACT else (y, x)


def _lowered(index: BlockIndex, x: np.ndarray, most: np.ndarray, floor: np.ndarray,
             full: Callable[[int, np.ndarray, np.ndarray], bool]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores) of all rows from a threshold that makes ``full`` true, or from ``floor`` on."""
    open_, share = np.arange(len(x)), FIRST
    while len(open_):
        least = np.maximum(floor[open_], np.ceil(most[open_] * share)) if share > LAST else floor[open_]
        i, j, score = index.search(x[open_], least)
        by = np.argsort(i, kind="stable")
        cuts = np.searchsorted(i[by], np.arange(len(open_) + 1))
        again = []
        for k, anchor in enumerate(open_):
            part = by[cuts[k]:cuts[k + 1]]
            if least[k] <= floor[anchor] or full(anchor, j[part], score[part]):
                yield anchor, j[part], score[part]
            else:
                again.append(anchor)
        open_, share = np.array(again, int), share * LOWER


NOTHING = -float(1 << 62)      # below every score


def _best(score: np.ndarray, row: np.ndarray, ids: list, most: int) -> list[tuple[int, int, int]]:
    """The first ``most`` (score, id, row): higher scores first, then smaller ids."""
    if not len(score):
        return []
    cut = np.partition(score, max(0, len(score) - most))[max(0, len(score) - most)]
    keep = score >= cut                               # every row names at least one id
    found = sorted((-int(s), int(v), int(j)) for s, j in zip(score[keep], row[keep]) for v in ids[j])
    return [(-s, v, j) for s, v, j in found[:most]]


def _positives(most: int) -> Callable:
    def run(key, rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            y, x = _both(rows, anchors)
            index, ids = BlockIndex(y), rows["ids"].tolist()
            names, keys, named = rows["key"].tolist(), anchors["key"].tolist(), np.array([*map(len, ids)])
            largest = index.norms[:, -1].max()
            for s in range(0, len(x), TOGETHER):
                part = x[s:s + TOGETHER]
                top = np.sqrt((part.astype(np.float64) ** 2).sum(1)) * largest
                for k, j, score in _lowered(index, part, top, np.full(len(part), NOTHING),
                                            lambda k, j, _: named[j].sum() >= most):
                    out += [(keys[s + k], v, p, names[r] == keys[s + k]) for p, v, r in _best(score, j, ids, most)]
        return pd.DataFrame(out, columns=["key", "id", "score", "own"])
    return run


def _negatives(most: int, low: int, high: int) -> Callable:
    def run(key, rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            y, x = _both(rows, anchors)
            index, ids = BlockIndex(y), rows["ids"].tolist()
            kinds, _ = pd.factorize(pd.concat([rows["label"], anchors["label"]]))
            kind, own = kinds[:len(rows)], kinds[len(rows):]
            keys, windows = anchors["key"].tolist(), [sorted(map(int, w)) for w in anchors["windows"]]
            named = np.array([*map(len, ids)])

            def inside(k: int, w: int, j: np.ndarray, score: np.ndarray) -> np.ndarray:
                return (kind[j] != own[k]) & (100 * score <= high * w) & (100 * score >= low * w)

            for s in range(0, len(x), TOGETHER):
                part = x[s:s + TOGETHER]
                top = np.array([max(w) for w in windows[s:s + TOGETHER]], float) * high / 100
                floor = np.array([np.ceil(min(w) * low / 100) for w in windows[s:s + TOGETHER]])
                full = lambda k, j, score: all(
                    named[j[inside(s + k, w, j, score)]].sum() >= most for w in windows[s + k])
                for k, j, score in _lowered(index, part, np.maximum(top, floor), floor, full):
                    for w in windows[s + k]:
                        fits = inside(s + k, w, j, score)
                        out += [(keys[s + k], w, v, p) for p, v, _ in _best(score[fits], j[fits], ids, most)]
        return pd.DataFrame(out, columns=["key", "window", "id", "score"])
    return run


def _first(df: DataFrame, keys: list[str], order: list, most: int, rank: str = "_rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= most)


def mine(df: DataFrame, anchors: Column | None = None, positives: int = 5, negatives: int = 5, low: int = 80,
         high: int = 100, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` tells which ids are anchors (all, if None); it may use the
    column ``id``. Windows reach from ``low`` to ``high`` per cent (integers of
    at least 0) of the positive's score.
    """
    whole = F.expr(f"transform(v, x -> floor({scale}D * x))")
    good = F.expr("id is not null and label is not null and v is not null and "
                  "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and "
                  f"aggregate(v, 0D, (a, x) -> a + pow(double(floor({scale}D * greatest(least(x, 1e13D), -1e13D))), 2D)) "
                  f"< {float(1 << 62)}D")
    rows = (df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                      F.col(vec_col).cast("array<double>").alias("v"))
            .where(good).select("id", "label", whole.alias("vec"))
            # the label is part of the key, so classes and anchors are told apart by the key alone
            .withColumn("key", F.sha2(F.to_json(F.struct("label", "vec")), 256)))
    named = rows.select("key", "id").distinct()
    smallest = (_first(named, ["key"], ["id"], max(positives + 1, negatives)).groupBy("key")
                .agg(F.array_sort(F.collect_list("id")).alias("ids")))       # a bounded list
    classes = written(rows.groupBy("key").agg(F.first("label").alias("label"), F.first("vec").alias("vec"))
                      .join(smallest, "key"), "negatives-classes")
    asked = named.where(F.lit(True) if anchors is None else anchors).select("key", F.col("id").alias("anchor_id"))
    asking = written(classes.join(asked.select("key").distinct(), "key", "left_semi").select("key", "label", "vec"),
                     "negatives-anchors")

    part = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blocks = lambda c, most: F.greatest(F.lit(1), F.ceil(F.sum(c) / most)).cast("int")

    def joined(left: DataFrame, right: DataFrame, keys: list[str], task: Callable, schema: str, tag: str) -> DataFrame:
        one, none = F.lit(1), F.lit(0)
        counts = (left.select(*keys, one.alias("r"), none.alias("a")).unionByName(right.select(*keys, none.alias("r"), one.alias("a")))
                  .groupBy(*keys).agg(blocks("r", ROWS).alias("nr"), blocks("a", ANCHORS).alias("na"), F.sum("a").alias("a")))
        if keys:
            left, right = (side.join(counts.where("a > 0").drop("a"), keys) for side in (left, right))
        else:
            n = counts.first()                          # two numbers
            left, right = (side.withColumns({"nr": F.lit(n.nr), "na": F.lit(n.na)}) for side in (left, right))
        rows = left.withColumn("rb", part("nr")).withColumn("ab", every("na")).drop("nr", "na")
        ask = right.withColumn("ab", part("na")).withColumn("rb", every("nr")).drop("nr", "na")
        by = [*keys, "rb", "ab"]
        return written(rows.groupBy(*by).cogroup(ask.groupBy(*by)).applyInPandas(task, schema), tag)

    kind = dict(rows.dtypes)["id"]
    found = joined(classes, asking, ["label"], _positives(positives + 1), f"key string, id {kind}, score long, own boolean",
                   "negatives-positives")
    best = F.desc("score"), "id"
    positive = written(_first(found, ["key"], [*best], positives + 1).drop("_rank"), "negatives-best")
    # the windows of a class: one for each score among its positives that a window can reach
    windows = (positive.where("score >= 0").groupBy("key").agg(F.array_sort(F.collect_set("score")).alias("windows")))
    hit = joined(classes, asking.join(windows, "key"), [],
                 _negatives(negatives, low, high), f"key string, window long, id {kind}, score long", "negatives-found")
    hit = _first(hit, ["key", "window"], [*best], negatives, "rank").select(
        "key", F.col("window").alias("positive_score"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    # an anchor is not its own positive; without it, the first ones are its
    others = asked.join(positive, "key").where(~(F.col("own") & (F.col("id") == F.col("anchor_id"))))
    chosen = _first(others, ["key", "anchor_id"], [*best], positives).select(
        "key", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return chosen.join(hit, ["key", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: The query's contract in DuckDB SQL: every anchor is compared with every row.
SQL = """
    WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
               FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
                      CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
               FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
         p AS (SELECT a, b, score FROM s WHERE same
               QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
    SELECT p.a AS anchor_id, p.b AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank,
           s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
    QUALIFY rank <= 5"""
