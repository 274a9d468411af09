import itertools
import random

import numpy as np
import pytest

from citymarts.llm import ngrams
from test_ngrams import brute


def least(n, m, threshold):
    """Least similarity of two different sets of these sizes that is a link, by trying all."""
    all_ = [c / (n + m - c) for c in range(min(n, m) + 1) if not c == n == m]
    return min((s for s in all_ if s >= threshold - 1e-9), default=None)


@pytest.mark.parametrize("threshold, target", [(0.8, 0.999), (0.8, 0.99), (0.6, 0.999), (0.3, 0.99), (1.0, 0.999)])
def test_every_possible_link_meets_at_a_depth_of_both_that_reaches_the_target(threshold, target):
    for n, m in itertools.product(range(1, 60), repeat=2):
        s = least(n, m, threshold)
        if s is None:
            continue
        deep = max([d for d in range(1, ngrams.LEVELS + 1) if ngrams.chance(s, d) >= target], default=1)
        assert deep in ngrams.stops(n, threshold, target) and deep in ngrams.stops(m, threshold, target)


def test_classes_stop_at_different_depths():
    at = lambda n: ngrams.stops(n, 0.8, ngrams.TARGET)
    assert at(1) == at(3) == () and at(7) == (8,) and at(9) == (8, 7) and at(500) == (7,) and at(1_000_000) == (7,)
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (7, 500, 9, 2)]
    import pandas as pd
    pdf = pd.DataFrame({"label": [ngrams.labels(x).tobytes() for x in sets], "size": [len(x) for x in sets], "rep": range(4)})
    out = pd.concat(ngrams._placing(0.8, ngrams.TARGET)(iter([pdf, pdf[:0]])))
    assert out.groupby("rep").size().to_dict() == {0: 32, 1: 32, 2: 64}
    assert set(out[out.rep == 0].node) == set(ngrams.nodes(ngrams.labels(sets[0]), 8).astype(np.int64))
    assert set(out[out.rep == 1].node) == set(ngrams.nodes(ngrams.labels(sets[1]), 7).astype(np.int64))


def test_links_of_all_sizes_equal_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for k in range(400):
        words = [f"w{rnd.randrange(10_000)}" for _ in range(rnd.choice([1, 3, 5, 8, 9, 10, 11, 12, 13, 14, 16, 20, 30, 60]))]
        rows.append(" ".join(words))
        rows.append(" ".join(words[:-1] if k % 2 else words[1:]))
        rows.append(" ".join(words + [f"x{k}"]))
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (0.8, 0.6):
        got = {r.doc_id: (r.n_links, r.component_id) for r in ngrams.join(df, threshold).collect()}
        want = brute(rows, threshold)
        assert sum(n for n, _ in want.values()) > 300
        assert sum(got[i] != want[i] for i in want) <= 0.01 * len(rows)
