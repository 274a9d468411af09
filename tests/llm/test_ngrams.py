import random

import duckdb
import numpy as np

from citymarts.llm import ngrams
from citymarts.llm.queries import QUERIES
from conftest import SF_CHECK


def brute(rows, threshold=0.8):
    """{id: (n_links, component)} by comparing all pairs of shingle sets of strings."""
    import re

    def words5(t):
        w = re.findall(r"\w+", (t or "").lower())
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    sets = [words5(t) for _, t in rows]
    linked = {i: set() for i in range(len(rows))}
    where = {}
    for i, s in enumerate(sets):
        near = {j for x in s for j in where.get(x, ())}
        for j in near:
            n = len(s & sets[j])
            if n * 10 >= round(threshold * 10) * (len(s) + len(sets[j]) - n):
                linked[i].add(j)
                linked[j].add(i)
        for x in s:
            where.setdefault(x, []).append(i)
    out = {}
    for i in linked:
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[rows[i][0]] = (len(linked[i]), min(rows[j][0] for j in seen))
    return out


def test_query_equals_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from read_parquet('{SF_CHECK}/documents.parquet')").fetchall()
    got = {r.doc_id: (r.n_links, r.component_id) for r in QUERIES["op1_ngram_join"](spark, SF_CHECK).collect()}
    assert got == brute(docs)


def variants(n, words=60, seed=5):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 500)}" for _ in range(words)]
    for i in range(n):
        w = list(base)
        w[rnd.randrange(words)] = f"x{i}"
        yield " ".join(w)


def test_hot_group_in_blocks(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(variants(150))] + [(1000 + i, t) for i, t in enumerate(variants(40, 30, 6))]
    rows += [(2000 + i, rows[3][1]) for i in range(20)] + [(3000, "one two three"), (3001, "One two, three!"), (3002, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for size in (16, 512):
        monkeypatch.setattr(ngrams, "BLOCK_CLASSES", size)
        assert {r.doc_id: (r.n_links, r.component_id) for r in ngrams.join(df).collect()} == want
    assert {r.doc_id for r in ngrams.representatives(df).collect()} == {c for _, c in want.values()}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " .,; "), (4, "a b c d e f g"), (4, "a b c d e f g"), (5, "a b c d e f g"), (None, "a b c d e f g"),
            (6, "word " * 200_000), (7, "word " * 100_000), (8, "A, b. c d-e f g")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, rep string, component int")
    got = sorted(map(tuple, ngrams.join(df).collect()), key=str)
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 3, 4), (4, 3, 4), (5, 3, 4), (8, 3, 4), (None, 0, None), (6, 1, 6), (7, 1, 6)]
    assert got == sorted(want, key=str)
    kept = ngrams.representatives(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "None"]
    assert ngrams.join(df.limit(0)).count() == 0


def test_repeated_ids_with_other_texts_lose_no_document(spark):
    a, b = " ".join("abcdefgh"), " ".join("pqrstuvw")
    rows = [(1, a), (1, b), (2, b), (3, a), (3, None), (1, a), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_links, r.component_id) for r in ngrams.join(df).collect())
    assert got == [(1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 1, 1), (3, 0, 3), (3, 2, 1), (4, 0, 4)]
    kept = sorted((r.doc_id, r.text or "") for r in ngrams.representatives(df).collect())
    assert kept == [(1, a), (1, b), (3, ""), (4, "")]


def test_prefix_depth_and_estimate():
    assert ngrams.chance(0.8, 7) >= ngrams.TARGET > ngrams.chance(0.8, 8)
    rng = np.random.default_rng(2)
    found = []
    for _ in range(300):
        common = rng.integers(0, 1 << 63, 80, dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 1 << 63, 10, dtype=np.uint64)]) for _ in range(2))
        found.append((ngrams.nodes(ngrams.labels(a), 7) == ngrams.nodes(ngrams.labels(b), 7)).any())
    assert np.mean(found) >= 0.99
