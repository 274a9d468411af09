"""Fertility rules: base counts and measures against plain versions, verdicts against labels."""

import math
import re
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

from citymarts.llm import fertility
from citymarts.llm.queries import QUERIES
from conftest import SF_CHECK

VOCABULARIES = (P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model"))
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


@pytest.fixture(scope="module")
def encoders():
    import base64

    import tiktoken
    with open(VOCABULARIES[0], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return (tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}),
            sentencepiece.SentencePieceProcessor(model_file=VOCABULARIES[2]))


def plain_measures(text, encoders):
    """Each word alone, one after the other."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tokens = [t for w in words for t in encoders[0].encode_ordinary(" " + w)]
    pieces = [p for w in words for p in encoders[1].encode(w)]
    chars, n = sum(map(len, words)), len(tokens)
    if not n:
        return (None,) * 4
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(tokens).values())
    return chars / n, chars / len(pieces), sum(map(encoders[1].is_byte, pieces)) / len(pieces), entropy


ODD = ["", None, "  \n\t ", "one", "a b c d e a b c d e", "x\n\nx\n x\nx\n \n \n", "#*$ %&|<> a\x1cb \x85 c d e", "日本語 テスト ж 😀 𐎠",
       "a\x0bb\x0cc\rd", "the end " * 40, "é́ ▁ <0x41> <|endoftext|> ' 's", " lead and trail ", "z" * 9000 + " " + "🜁" * 5000]


def test_base_counts_and_measures_of_odd_texts(spark, encoders, monkeypatch):
    monkeypatch.setattr(fertility, "SLICE_BYTES", 100)
    rows = [(i, t, "xx") for i, t in enumerate(ODD)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    got = fertility.rules(df, *VOCABULARIES).collect()
    assert len(got) == len(rows)
    for r in got:
        text = ODD[r.doc_id]
        assert tuple(r[c] for c in BASE) == base(text), text
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        if len(text or "") < 5000:
            want = plain_measures(text, encoders)
            assert [r[c] for c in fertility._MEASURES] == [w if w is None else pytest.approx(w) for w in want], text
        assert not (r.base_failed and r.kept)


def brute_kept(rows, reach=fertility.REACH):
    """Bands from sorted lists; rows: (family, n_tokens, base_failed, measures)."""
    groups = defaultdict(list)
    for family, n, failed, m in rows:
        if not failed:
            for key in ((family, int(math.log2(max(n, 1)))), (family,)):
                for name, x in m.items():
                    groups[key, name].append(math.floor(x / fertility.STEP))

    def band(key, name):
        x = sorted(groups[key, name])
        if len(x) < fertility.SUPPORT:
            return None
        q1, q3 = (next(v for i, v in enumerate(x, 1) if i >= len(x) * q) * fertility.STEP for q in (0.25, 0.75))
        room = max(q3 - q1, fertility.LEAST_RANGE[name]) * reach
        return q1 - room, q3 + room + fertility.STEP

    for family, n, failed, m in rows:
        kept = not failed
        for name, x in m.items():
            b = band((family, int(math.log2(max(n, 1)))), name) or (band((family,), name) if name != "token_entropy" else None)
            if kept and b and (x > b[1] or (x < b[0] and name != "fallback_share")):
                kept = False
        yield kept


def test_verdict_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    measured = fertility.measures(docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang"))), *VOCABULARIES)
    rows = fertility.judge(measured).select("family", "n_tokens", "base_failed", "kept", "n_words", *fertility._MEASURES).collect()
    want = [*brute_kept([(r.family, r.n_tokens, r.base_failed, {m: r[m] for m in fertility._MEASURES}) for r in rows])]
    assert [r.kept for r in rows] == want
    assert {r.family for r in rows} >= {"en", "de", "script LATIN"}


def test_base_counts_of_the_table_and_held_out_labels(spark):
    got = {r.doc_id: r for r in QUERIES["op13_fertility"](spark, SF_CHECK).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    assert all(tuple(got[i][c] for c in BASE) == base(t) for i, t in texts.items())
    labels = [r for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect() if not got[r.doc_id].base_failed]
    clean = [got[r.doc_id].kept for r in labels if r.quality == 1 and r.toxic == 0]
    poor = [got[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(clean) / len(clean) > 0.95 and sum(poor) / len(poor) < 0.35


def test_empty_table_clashing_columns_and_no_language(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert fertility.rules(empty, *VOCABULARIES).collect() == []
    text = "the quick brown fox jumps over the lazy dog and then some more words"
    df = spark.createDataFrame([(None, text), (1, text)], "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("id", "family", "size", "kept", "n_words", "measure", "bin")})
    got = fertility.rules(df, *VOCABULARIES, lang_col=None).collect()
    assert {r.doc_id for r in got} == {None, 1} and all(r.kept for r in got)
