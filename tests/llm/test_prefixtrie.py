"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from sqlcheck import assert_equals_sql

from citymarts.llm import prefixtrie
from conftest import SF_CHECK

SCHEMA = "conv_id long, turn long, role string, text string"


def in_order(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
            convs[c].append((t is not None, t or 0, digest, (r, x)))
    return {c: [turn[3] for turn in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = [*convs.get(base, [])[:h], *own[h:]]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not kids[k]
    sha = lambda k: hashlib.sha256(",".join(str(c) for c in sorted(m for m in members[k] if len(convs[m]) == len(k))).encode())
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -10**9, len(m), kids[k], leaves[k], saved[k], sha(k).hexdigest())
                  for k, m in members.items())


def found(nodes):
    return sorted((r.conv_id, r.depth, -10**9 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in nodes.collect())


def made(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "é", "longer text", "", "b,c"])
    rows = []
    for c in range(-20, n):
        for t in range(rng.choice([1, 2, 3, 5, 12, 30])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", None, "assistant"]), word() if t else "hello"))
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(3)]       # a group of copies
    rows += [(c, 0, "user", "hello") for c in range(2000, 2050)]                               # proper prefixes of others
    rows += [(7777, 0, "user", "again")] * 40 + [(None, 1, "user", "x"), (7778, None, None, None)]
    return rows


def test_equals_sql(spark):
    assert_equals_sql(spark, "op12_prefix_trie", SF_CHECK)


@pytest.mark.parametrize("seed,span,ends", [(1, 1024, 12), (2, 3, 2)])
def test_equals_plain_trie(spark, monkeypatch, seed, span, ends):
    monkeypatch.setattr(prefixtrie, "SPAN", span)
    monkeypatch.setattr(prefixtrie, "ENDS", ends)
    rows = made(seed)
    turns = prefixtrie.ordered(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found(prefixtrie.trie(turns)) == brute(in_order(rows))
    assert found(prefixtrie.trie(*prefixtrie.rebuilt(turns))) == brute(rebuilt(in_order(rows)))


def test_no_rows_and_only_turnless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(prefixtrie.trie(prefixtrie.ordered(empty))) == []
    assert found(prefixtrie.trie(*prefixtrie.rebuilt(prefixtrie.ordered(empty)))) == []
    turnless = [(c, 0, "user", "x") for c in range(1, 200) if zlib.crc32(str(c).encode()) % 9 and c % 5]
    got = found(prefixtrie.trie(*prefixtrie.rebuilt(prefixtrie.ordered(spark.createDataFrame(turnless, SCHEMA)))))
    assert got == brute(rebuilt(in_order(turnless))) and len(got) == 1


def test_long_conversation_texts_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SPAN", 64)
    rows = [(1, t, "user", f"turn {t}") for t in range(700)] + [(2, t, "user", f"turn {t}") for t in range(500)]
    rows += [(3, 0, "user", "turn 0"), (3, 1, "user", "x" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("conv", "at", "digest", "bytes", "n", "part", "k1", "span", "weight")})
    nodes = prefixtrie.trie(prefixtrie.ordered(df))
    assert found(nodes) == brute(in_order(rows))
    texts = {(r.conv_id, r.depth): (r.role, r.text) for r in prefixtrie.with_texts(nodes, df).collect()}
    assert texts[1, 0] == (None, None) and texts[1, 700] == ("user", "turn 699") and texts[3, 2] == ("user", "x" * 200_000)
