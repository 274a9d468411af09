"""Embedding near-dedup: product quantisation with exact rerank.

The index: k-means cells (inverted lists) and, for the residual to the cell's
centre, one code per subspace; both codebooks are fitted on a bounded sample
(``SAMPLE`` vectors), every vector is indexed. A vector is sent as a query to
every cell that can hold a partner: with a distance of at most r between
partners, a partner's cell has its bisector with the query's own cell within
r of the query. In a cell, table look-ups give the asymmetric distance between
query and code; by the triangle inequality a partner's lies within r plus the
code's own error. What passes is compared by cosine in double precision. Both
bounds are exact, so no link is lost to the index; tests compare with brute
force.

Equal vectors of a label are compared once, with their number as weight. Large
cells are split into blocks of index rows and of queries. A task returns link
counts and a spanning forest of its links, never the links themselves.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components, and rows with a NULL label, link with nothing and are their own
component; so does a row with a NULL id, whose component is NULL and which is
not kept. Vectors of different lengths do not link. Repeated rows count as
other vectors. Rows of one id with different vectors share their links. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from citymarts.llm.components import connected_components, written

SAMPLE = 8192        # vectors on which the codebooks are fitted
MAX_CELLS = 1024
CODES = 256          # codes of a subspace
SUBSPACES = 8
INDEX_BLOCK, QUERY_BLOCK = 1024, 2048
SLACK = 1e-6         # for rounding in the two bounds


# -- codebooks ---------------------------------------------------------------

def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of ``x``; deterministic, empty clusters keep their centre."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = _distances(x, centres).argmin(1)
        n = np.bincount(near, minlength=len(centres))
        for j in range(x.shape[1]):
            total = np.bincount(near, x[:, j], len(centres))
            centres[:, j] = np.where(n > 0, total / np.maximum(n, 1), centres[:, j])
    return centres


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances between rows."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None], 0)


class Codebook:
    """Cell centres and residual codes for vectors of one length."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.centres = k_means(sample, cells)
        residual = sample - self.centres[_distances(sample, self.centres).argmin(1)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.codes = [k_means(residual[:, p], CODES) for p in self.parts]
        self.apart = np.sqrt(_distances(self.centres, self.centres))

    def place(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Cell, cells to probe, codes and code error of each (unit) vector."""
        d = _distances(x, self.centres)
        cell = d.argmin(1)
        # distance to the bisector of the own and the other cell's centre
        margin = (d - d[np.arange(len(x)), cell][:, None]) / np.maximum(2 * self.apart[cell], 1e-12)
        probes = [np.flatnonzero(m <= radius + SLACK) for m in margin]
        residual = x - self.centres[cell]
        codes = np.stack([_distances(residual[:, p], c).argmin(1) for p, c in zip(self.parts, self.codes)], 1)
        error = sum(((residual[:, p] - c[codes[:, m]]) ** 2).sum(1)
                    for m, (p, c) in enumerate(zip(self.parts, self.codes)))
        return cell, probes, codes.astype(np.uint8), np.sqrt(error)

    def near(self, cell: int, queries: np.ndarray, codes: np.ndarray, error: np.ndarray,
             radius: float) -> np.ndarray:
        """Which (query, index row) pairs the look-up distances allow."""
        residual = queries - self.centres[cell]
        total = np.zeros((len(queries), len(codes)))
        for m, (p, c) in enumerate(zip(self.parts, self.codes)):
            total += _distances(residual[:, p], c)[:, codes[:, m]]
        return np.sqrt(total) <= radius + error[None] + SLACK


def _vector(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.float32 if len(data) == 4 * dim else np.float64).astype(np.float64)


def _packed(v: np.ndarray) -> bytes:
    short = v.astype(np.float32)
    return (short if (short == v).all() else v).tobytes()


# -- tasks -------------------------------------------------------------------

PLACED = "id long, label string, dim int, weight long, vec binary, code binary, error double, cell int, probes array<int>"


def _placing(books, radius: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                raw = np.array([np.asarray(v, np.float64) for v in part["v"]])
                unit = raw / np.sqrt((raw * raw).sum(1))[:, None]
                out = part[["id", "label", "dim", "weight"]].copy()
                out["vec"] = [_packed(v) for v in raw]
                book = books.value.get(dim)
                if book is None:  # a length that the sample does not hold: one cell, no codes
                    out["code"], out["error"], out["cell"], out["probes"] = b"", 0.0, 0, [[0]] * len(part)
                else:
                    cell, probes, codes, error = book.place(unit, radius)
                    out["code"], out["error"] = [c.tobytes() for c in codes], error
                    out["cell"], out["probes"] = cell.astype(np.int32), probes
                yield out
    return run


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component for the links ``a[i]``-``b[i]`` among ``n`` nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _matching(books, threshold: float, radius: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, y = pdf[pdf["query"]], pdf[~pdf["query"]]
        none = pd.DataFrame({"id": pd.Series([], dtype="int64"), "links": pd.Series([], dtype="int64"),
                             "root": pd.Series([], dtype="int64")})
        if q.empty or y.empty:
            return none
        dim, cell = int(pdf["dim"].iloc[0]), int(pdf["cell"].iloc[0])
        vy = np.array([_vector(v, dim) for v in y["vec"]])
        ny, iy, wy = np.sqrt((vy * vy).sum(1)), y["id"].to_numpy(), y["weight"].to_numpy()
        book = books.value.get(dim)
        codes = np.array([np.frombuffer(c, np.uint8) for c in y["code"]]) if book else None
        ids, links, left, right = [], [], [], []
        for start in range(0, len(q), 256):
            part = q.iloc[start:start + 256]
            vq = np.array([_vector(v, dim) for v in part["vec"]])
            nq, iq = np.sqrt((vq * vq).sum(1)), part["id"].to_numpy()
            near = (book.near(cell, vq / nq[:, None], codes, y["error"].to_numpy(), radius) if book
                    else np.ones((len(vq), len(vy)), bool))
            near &= iq[:, None] != iy[None]
            i, j = np.nonzero(near)
            same = np.einsum("ij,ij->i", vq[i], vy[j]) / (nq[i] * ny[j]) >= threshold
            i, j = i[same], j[same]
            ids.append(iq)
            links.append(np.bincount(i, wy[j], len(iq)).astype(np.int64))
            left.append(iq[i])
            right.append(iy[j])
        ids, links, left, right = map(np.concatenate, (ids, links, left, right))
        if not len(left):
            return none
        nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
        root = nodes[forest(at[:len(left)], at[len(left):], len(nodes))]
        found = links > 0
        return pd.concat([pd.DataFrame({"id": ids[found], "links": links[found], "root": ids[found]}),
                          pd.DataFrame({"id": nodes, "links": 0, "root": root})])
    return run


# -- the operator ------------------------------------------------------------

def near_duplicates(df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", cells: int | None = None) -> DataFrame:
    """Per row: id, number of other vectors linked, component id, whether it is kept."""
    spark = df.sparkSession
    sc = spark.sparkContext
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vec_col).cast("array<double>").alias("v"))
    good = F.expr("id is not null and label is not null and size(v) > 0 and "
                  "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and "
                  "exists(v, x -> x <> 0)")
    # a power of two brings the largest component near one without rounding
    scale = F.expr("pow(2D, floor(log2(array_max(transform(v, x -> abs(x))))))")
    rows = (rows.withColumn("good", F.coalesce(good, F.lit(False))).withColumn("scale", F.when(F.col("good"), scale))
            .withColumn("v", F.when(F.col("good"), F.expr("transform(v, x -> x / scale)"))).drop("scale")
            .withColumn("key", F.when(F.col("good"), F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256))))
    valid = rows.where("good")
    reps = written(valid.groupBy("label", "key").agg(F.min("id").alias("id"), F.count("*").alias("weight"),
                                                     F.first("v").alias("v"))
                   .withColumn("dim", F.size("v")), "vectors")
    n = reps.count()
    sample = reps.select("v", "dim").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    cells = cells or max(1, min(MAX_CELLS, int(math.sqrt(n) / 4)))
    books = {}
    for dim in {r.dim for r in sample}:
        x = np.array([r.v for r in sample if r.dim == dim])
        books[dim] = Codebook(x / np.sqrt((x * x).sum(1))[:, None], cells)
    books = sc.broadcast(books)  # at most SAMPLE vectors' worth of centres and codes

    placed = written(reps.select("id", "label", "dim", "weight", "v")
                     .mapInPandas(_placing(books, radius), PLACED), "placed")
    queries = placed.select("id", "label", "dim", "vec", F.explode("probes").alias("cell"))
    where = ["label", "dim", "cell"]
    size = lambda c, most: F.greatest(F.lit(1), F.ceil(F.sum(c) / most)).cast("int")
    blocks = (placed.select(*where, F.lit(1).alias("i"), F.lit(0).alias("q"))
              .unionByName(queries.select(*where, F.lit(0).alias("i"), F.lit(1).alias("q")))
              .groupBy(*where).agg(F.sum("i").alias("ni"), size("i", INDEX_BLOCK).alias("nb"),
                                   size("q", QUERY_BLOCK).alias("nq")).where("ni > 0").drop("ni"))
    spread = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = placed.join(blocks, where).select(
        *where, spread("nb").alias("ib"), every("nq").alias("qb"), F.lit(False).alias("query"),
        "id", "weight", "vec", "code", "error")
    asked = queries.join(blocks, where).select(
        *where, every("nb").alias("ib"), spread("nq").alias("qb"), F.lit(True).alias("query"),
        "id", F.lit(0).cast("long").alias("weight"), "vec", F.lit(b"").alias("code"), F.lit(0.0).alias("error"))
    found = written(index.unionByName(asked).groupBy(*where, "ib", "qb")
                    .applyInPandas(_matching(books, threshold, radius), "id long, links long, root long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))

    group = reps.select("label", "key", F.col("id").alias("rep"), "weight")
    out = (rows.select("id", "label", "key").join(group, ["label", "key"], "left")
           .join(links.withColumnRenamed("id", "rep"), "rep", "left")
           .join(parts.withColumnRenamed("id", "rep"), "rep", "left"))
    component = F.coalesce("component", "rep", "id")
    return out.select(F.col("id").alias(id_col),
                      (F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
