import duckdb
import numpy as np
import pytest

from citymarts.llm import embeddings
from citymarts.llm.components import connected_components
from citymarts.llm.queries import QUERIES
from conftest import SF_SMOKE

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int"


def brute(rows, threshold=0.98):
    """(n_links, component) per position of ``rows`` by comparing all pairs."""
    def good(r):
        v = r[1]
        return (r[0] is not None and r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v)
                and any(v))
    linked = {i: set() for i in range(len(rows))}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if good(a) and good(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / np.sqrt(x @ x * (y @ y)) >= threshold:
                    linked[i].add(j)
                    linked[j].add(i)
    out = []
    for i in linked:
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((len(linked[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, l, "x", 1) for i, v, l in rows], SCHEMA)
    got = sorted(embeddings.near_duplicates(df, **kw).collect(), key=str)
    want = sorted(((r[0], n, c, r[0] == c and r[0] is not None) for r, (n, c) in zip(rows, brute(rows))), key=str)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(embeddings, "INDEX_BLOCK", 7)
    monkeypatch.setattr(embeddings, "QUERY_BLOCK", 11)


def test_equals_brute_force_with_hot_group(spark, small_blocks):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 16))
    rows = []
    for i in range(240):
        c = base[0] if i % 3 == 0 else base[i % 12]
        noise = rng.normal(size=16) * (0.02 if i % 2 else 0.14) * np.linalg.norm(c) / 4
        rows.append((i * 3 % 251, [float(np.float32(x)) for x in c + noise], int(i % 3 == 0)))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(30)]
    check(spark, rows, cells=9)


def test_odd_rows(spark):
    v = [0.5, -1.0, 2.0]
    check(spark, [(1, v, 1), (2, v, 1), (3, v, 2), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1),
                  (7, [0.5, None, 2.0], 1), (8, [float("nan"), 1.0, 1.0], 1), (9, [float("inf"), 1.0, 1.0], 1),
                  (10, v, None), (11, [1e30 * x for x in v], 1), (12, [1e-30 * x for x in v], 1), (13, v[:2], 1),
                  (14, [-x for x in v], 1), (None, v, 1)])


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_brute_force_with_full_recall(spark):
    rows = duckdb.sql(f"select vec_id, embedding, label from read_parquet('{SF_SMOKE}/embeddings.parquet')").fetchall()
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op3_embedding_neardup"](spark, SF_SMOKE).collect()}
    assert got == {r[0]: w for r, w in zip(rows, brute(rows))}


def test_components_of_chain_star_and_cycle(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(202, 201), (201, 203), (203, 202)]
    links += [(7, 7), (2, 1), (None, 3)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)} | {i: 201 for i in range(201, 204)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
