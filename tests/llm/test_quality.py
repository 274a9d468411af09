import numpy as np

from citymarts.llm import quality
from citymarts.llm.queries import QUERIES
from conftest import SF_CHECK


def test_held_out_labels(spark):
    """No gold label is used in training, so all of them are held out."""
    got = {r.doc_id: r for r in QUERIES["op9_quality"](spark, SF_CHECK).collect()}
    assert len(got) == 1000
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()
    junk = [(got[r.doc_id].p_low >= 0.5) == (r.quality == 0) for r in labels]
    toxic = [(got[r.doc_id].p_toxic >= 0.5) == (r.toxic == 1) for r in labels]
    clean = [got[r.doc_id].keep for r in labels if r.quality == 1 and r.toxic == 0]
    # some documents labelled as abuse hold no word of abuse at all
    assert np.mean(junk) > 0.98 and np.mean(toxic) > 0.94 and np.mean(clean) > 0.99


def test_label_model_finds_accurate_labellers():
    rng = np.random.default_rng(0)
    low = rng.random(4000) < 0.2
    votes = np.stack([np.where(rng.random(4000) < acc, low, ~low) for acc in (0.95, 0.9, 0.85, 0.6)], 1).astype(int)
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    found = quality.posteriors(patterns, n.astype(float))[at.ravel()] > 0.5
    assert (found == low).mean() > 0.95


def test_odd_rows(spark):
    good = "The river was calm and the boats went out early in the morning, as they always did. " * 5
    bad = "BUY!! NOW!! CHEAP!! *** $$$ ### &&& %%% " * 20
    rows = [(i, good, "x") for i in range(40)] + [(100 + i, bad, "x") for i in range(10)]
    rows += [(200, None, "x"), (201, "", "x"), (202, " \n\t ", "x"), (None, good, "x"), (300, bad * 2000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, votes string")
    got = {r.doc_id: r for r in quality.classify(df).collect()}
    assert all(got[i].keep for i in range(40)) and got[None].keep
    assert not any(got[i].keep for i in [*range(100, 110), 200, 201, 202, 300])
    assert got[200].p_low == 1.0 and got[200].p_toxic == 0.0
    assert quality.classify(df.limit(0)).count() == 0
