"""Hard negatives against a comparison of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from sqlcheck import assert_equals_sql

from citymarts.llm import hardnegatives
from conftest import SF_CHECK

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, positives=5, negatives=5, low=80, high=100, scale=256):
    good = sorted({(i, k, tuple(math.floor(scale * np.float64(np.float32(x))) for x in v)) for i, v, k in rows
                   if i is not None and v is not None and k is not None
                   and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for a in good:
        if not anchor(a[0]):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in good if b != a))
        for p, i, _ in [s for s in scored if s[2] == a[1]][:positives]:
            fits = [(n, j) for n, j, k in scored if k != a[1] and low * -p <= 100 * -n <= high * -p]
            out += [(a[0], i, r, j, -p, -n) for r, (n, j) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, anchor, schema=SCHEMA, **kw):
    return sorted(map(tuple, hardnegatives.mine(spark.createDataFrame(rows, schema), anchors=anchor, **kw).collect()))


def clustered(n, labels=3, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    v = centres[rng.integers(0, 4, n)] + 0.4 * rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    return [(i, [*map(float, x)], int(k)) for i, (x, k) in enumerate(zip(v, rng.integers(0, labels, n)))]


def test_equals_sql(spark):
    assert_equals_sql(spark, "op11_hard_negatives", SF_CHECK)


@pytest.mark.parametrize("rows,anchors", [(8192, 2048), (64, 7)])
def test_equals_brute_force(spark, monkeypatch, rows, anchors):
    monkeypatch.setattr(hardnegatives, "ROWS", rows)
    monkeypatch.setattr(hardnegatives, "ANCHORS", anchors)
    data = clustered(400)
    assert mined(spark, data, F.col("id") % 10 == 0) == brute(data, lambda i: i % 10 == 0)
    assert mined(spark, data, F.col("id") % 50 == 3, positives=2, negatives=7, low=50, high=90) == brute(
        data, lambda i: i % 50 == 3, 2, 7, 50, 90)


def test_hot_vector_ties_and_odd_rows(spark):
    data = clustered(60)
    hot = data[10][1]
    data += [(i, hot, 0) for i in range(1000, 1040)] + [(i, hot, 1) for i in range(2000, 2040)]
    data += data[:20]                                                    # repeated rows
    data += [(5, data[7][1], 2), (5, data[8][1], 1), (10, hot, 2)]       # one id, other contents
    data += [(None, hot, 1), (300, None, 1), (310, hot, None), (320, [0.0] * 12, 1), (330, [], 0), (340, hot[:5], 1),
             (350, [None] + hot[1:], 1), (360, [float("nan")] + hot[1:], 1), (370, [float("inf")] + hot[1:], 1),
             (380, [-x for x in hot], 1)]
    got = mined(spark, data, F.col("id") % 10 == 0)
    assert got == brute(data, lambda i: i % 10 == 0)
    assert any(r[0] == 1000 for r in got) and any(r[0] == 2030 for r in got)


def test_empty_large_and_clashing_columns(spark):
    assert mined(spark, [], None) == []
    big = [(1, [1e13, 0.0], 0), (2, [1e300, 1.0], 0), (3, [3.0, 4.0], 0), (4, [3.0, 4.0], 0), (5, [3.0, 3.5], 1)]
    exact = mined(spark, [r for r in big if r[0] > 2], None, "vec_id long, embedding array<double>, label int")
    assert mined(spark, big, None, "vec_id long, embedding array<double>, label int") == exact and len(exact) == 2
    wide = (spark.createDataFrame(clustered(80), SCHEMA)
            .withColumns({c: F.lit("x") for c in ("id", "key", "vec", "v", "ids", "windows", "rb", "ab", "all", "score")}))
    got = sorted(map(tuple, hardnegatives.mine(wide, anchors=F.col("id") < 5).collect()))
    assert got == brute(clustered(80), lambda i: i < 5)


def test_index_leaves_out_what_cannot_reach_the_threshold():
    rng = np.random.default_rng(0)
    rows = np.floor(256 * rng.normal(size=(500, 40)) * np.linspace(0.02, 1, 40))
    index = hardnegatives.BlockIndex(rows)
    x = rows[:9]
    every = x @ rows.T
    for share in (-1.0, 0.0, 0.3, 0.7, 0.95, 2.0):
        least = np.floor(share * (x * x).sum(1))
        i, j, score = index.search(x, least)
        assert {*zip(i.tolist(), j.tolist())} == {*zip(*map(np.ndarray.tolist, np.nonzero(every >= least[:, None])))}
        assert (score == every[i, j]).all()
