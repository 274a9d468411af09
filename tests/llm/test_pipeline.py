import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as p
import public_tokenizers
from citymarts.llm import linededup, quality
from citymarts.llm.components import written
from conftest import SF_SMOKE
from test_ngrams import brute


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the result of every stage."""
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    out = [docs]
    for name, stage in p.STAGES:
        out.append(written(stage(spark, out[-1], SF_SMOKE), "test"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_names(stages):
    assert [n for n, _ in p.STAGES] == ["quality", "lines", "near_duplicates", "decontaminate", "encode"]
    assert all(df.dtypes == stages[0].dtypes for df in stages[1:-1])


def test_quality_stage(stages):
    kept = sorted(r.doc_id for r in quality.classify(stages[0]).where("keep").collect())
    assert ids(stages[1]) == kept and len(kept) > 0.6 * stages[0].count()


def test_line_stage(stages):
    rows = stages[1].toPandas()
    con = duckdb.connect()
    con.register("documents", rows)
    whole = dict(zip(rows["doc_id"], rows["text"]))
    want = {i: t for i, t, _, n in con.execute(linededup.SQL).fetchall()
            if not n or t.strip() and len(t) >= p.LEAST_LEFT * len(whole[i])}
    assert 0 < len(want) < len(whole)
    got = {r.doc_id: r for r in stages[2].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_line_stage_keeps_what_loses_no_line(spark):
    shared = [f"{k} passage stands in several of the documents at once, as they share their boilerplate of old." for k in
              ("Now this very", "Here another long", "Last the third")]
    rows = [(1, "\n".join(["An opening of its own.", *shared])), (2, "\n".join(["Something else that opens it.", *shared])),
            (3, "\n".join(["A third one which is long enough by itself to be kept, since its own words outweigh the passages: "
                           + "one after another they go on and on. " * 12, *shared])),
            (4, None), (5, ""), (6, "  "), (7, shared[0]), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in p.drop_lines(spark, docs, SF_SMOKE).collect()}
    assert set(got) == {1, 3, 4, 5, 6, None}          # 2 keeps an opening only, 7 nothing
    assert got[1] == rows[0][1] and got[3] == rows[2][1].split("\n")[0] and got[4] is None


def test_near_duplicate_stage(stages):
    want = brute([(r.doc_id, r.text) for r in stages[2].collect()])
    assert ids(stages[3]) == sorted({c for _, c in want.values()})


def test_benchmark_stage(stages):
    items = [" ".join(r.text.lower().split()) for r in p.SparkSession.active().read.parquet(f"{SF_SMOKE}/benchmark.parquet").collect()]
    leaky = {r.doc_id for r in stages[3].collect() if any(x in " ".join(r.text.lower().split()) for x in items)}
    gone = set(ids(stages[3])) - set(ids(stages[4]))
    assert leaky <= gone and len(gone) <= len(leaky) + 2


def test_encode_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path(p.TOKENIZER))
    got = {r.doc_id: r for r in stages[5].collect()}
    for r in stages[4].collect():
        want = library.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].ids == want and got[r.doc_id].n_tokens == len(want)
        assert got[r.doc_id].decoded == library.decode(want, skip_special_tokens=False)
    assert len(got) == stages[4].count()


def test_odd_rows(spark):
    good = "The harbour lay quiet, and the fishermen told each other {} stories of the winter before they went home. "
    good = "".join(good.replace("{}", "{} " + w) for w in ("old", "sad", "long"))
    rows = [(i, good.replace("{}", f"{'abcdefgh'[i % 8]} {i}"), "en", "s", 1) for i in range(30)]
    rows += [(100, None, "en", "s", None), (101, "", None, None, 0), (None, good.replace("{}", "null") + " and more of it", "en", "s", 1), (3, rows[3][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, stages_schema := "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in p.STAGES:
        docs = written(stage(spark, docs, SF_SMOKE), "test-odd")
    assert {r.doc_id for r in docs.collect()} >= {None, 0}
    empty = spark.createDataFrame([], stages_schema)
    for _, stage in p.STAGES:
        empty = written(stage(spark, empty, SF_SMOKE), "test-empty")
    assert empty.count() == 0
