import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citymarts.llm import bpe
from citymarts.llm.queries import QUERIES
from conftest import SF_SMOKE

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " \t\n", "Hello  world's it's 123 éà\n<|startoftext|> ok<|endoftext|>x", "日本語の長い文章です 🙂🙂",
       "İstanbul ΣΑΣ ΟΔΟΣ ǅ", "a" * 5000, "ab" * 3000 + "!?" * 2000, "x\u0085y​z w\x1cq", "é é ﬁ",
       "'re 'S 'LL don'T", "0123456789" * 20, "\x00\x01 �"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.ForcedBoundaryBPE(open(PATH, encoding="utf-8").read())


def test_equals_library(library, own):
    for text in ODD:
        want = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want, text[:50]
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_every_code_point(library, own):
    points = [*range(1, 0x3100), *range(0xA640, 0xAC00), *range(0xFB00, 0x10400)]
    for i in range(0, len(points), 64):
        text = "".join(f"a{chr(c)}b {chr(c)}1" for c in points[i:i + 64])
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(points[i])


def test_fragments_lose_nothing_and_cut_something(own):
    s = "thqxzjkéé".encode()
    word = "".join(own.symbols[b] for b in s)
    assert "".join(own.fragments(word)) == word and len(own.fragments(word)) > 1


def test_query_over_table(spark, library):
    got = {r.doc_id: r for r in QUERIES["op10_bpe"](spark, SF_SMOKE).collect()}
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_nulls_repeats_clashes_empty(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "hi", "b"), (1, "hi", "c"), (None, "", "d")],
                               "doc_id long, text string, ids string")
    rows = sorted((r.doc_id or 0, r.ids, r.decoded) for r in bpe.encode_decode(df, PATH).collect())
    assert rows[0][1:] == ([], "") and rows[1][1:] == ([], "") and rows[2] == rows[3]
    assert bpe.encode_decode(df.limit(0), PATH).count() == 0
