"""Quality rules from tokeniser fertility.

Every word of a whole text is encoded with public vocabularies (a byte-level
BPE for many languages and a BPE with byte fallback). A document's measures:

* ``chars_per_token`` for each vocabulary: code points in words over tokens,
  the inverse of fertility;
* ``fallback_share``: the share of byte-fallback tokens;
* ``token_entropy``: Shannon entropy, in bits, of the document's tokens.

Rejection bands come from all documents: per language (per script where a
document names no language) and size class (power of two of the tokens), a
measure may lie ``reach`` interquartile ranges outside the quartiles. Quartiles
are read off exact histograms (steps of ``STEP``), which add up over tasks, so
a group of any size is never collected and the bands do not depend on the
order of rows. A group with fewer than ``SUPPORT`` documents takes the bands of
its whole language, without that of the entropy, which grows with the size;
a language with fewer rejects nothing.

The base rules need no tokens: words ``[^\\x20\\x09-\\x0D]+``, their code points,
symbols, repeated lines and words in 5-word windows that the text holds twice.
Windows are found by a hash and confirmed word by word.

Defined results: NULL, empty and blank texts have no words and fail the base
rules; their measures are NULL. A NULL id is kept. Repeated rows give repeated
results and count each in the bands. A NULL or blank language means the script
that most letters belong to. A word beyond ``LONGEST`` code points is encoded
in parts of that length. An empty table gives an empty result. Other columns
are not read, so their names do not matter.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

from citymarts.llm.components import written

SYMBOLS = r"[#*$%&|<>]"
WORD = r"[^\x20\x09-\x0D]"
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5   # the base rules: words, per cent of repeated words, words of a window
REACH = 2.0            # interquartile ranges beyond the quartiles
LEAST_RANGE = {"chars_per_token": 0.01, "chars_per_piece": 0.01, "token_entropy": 0.05, "fallback_share": 0.05}
STEP = 0.001           # of the histograms
SUPPORT = 30           # documents of a group with bands of its own
SLICE_BYTES = 4 << 20  # text measured at a time
LONGEST = 4096
CACHED = 1_000_000      # words remembered by a Python worker before it starts anew
MAX_VOCABULARY_BYTES = 64 << 20

_MEASURES = {"chars_per_token": pa.float64(), "chars_per_piece": pa.float64(),
             "fallback_share": pa.float64(), "token_entropy": pa.float64()}
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]


class Vocabularies:
    """Both tokenizers, and what they make of the words seen so far."""

    def __init__(self, ranks: bytes, pattern: str, pieces: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.bytes = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.token_bytes = np.zeros(max(table.values()) + 1, np.int64)
        self.token_bytes[[*table.values()]] = [*map(len, table)]
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.per_word = np.zeros((0, 3), np.int64)   # tokens, pieces, byte-fallback pieces
        self.starts, self.tokens = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words, each behind a space, and their number per word.

        One call encodes them all: no token crosses a space that follows a word.
        The bytes of the tokens tell where a word ends. Where a word holds white
        space of its own kind, each is encoded alone.
        """
        if any(len(w.split()) != 1 or w != w.strip() for w in words):
            alone = [self.bytes.encode_ordinary(" " + w) for w in words]
            return (np.fromiter(chain.from_iterable(alone), np.int32), np.fromiter(map(len, alone), np.int64, len(words)))
        tokens = np.asarray(self.bytes.encode_ordinary(" " + " ".join(words)), np.int32)
        ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words)))
        last = np.searchsorted(np.cumsum(self.token_bytes[tokens]), ends) + 1
        return tokens, np.diff(last, prepend=0)

    def rows(self, words: list[str]) -> np.ndarray:
        """The row of each word in ``per_word`` and ``starts``."""
        if len(self.index) > CACHED:
            self.clear()
        new = [w for w in words if w not in self.index]
        if new:
            parts, owner = new, None
            if max(map(len, new)) > LONGEST:
                cut = [[w[i:i + LONGEST] for i in range(0, len(w), LONGEST)] for w in new]
                parts, owner = [p for c in cut for p in c], np.repeat(np.arange(len(new)), [*map(len, cut)])
            tokens, n_tokens = self._encoded(parts)
            pieces = self.pieces.encode(parts, num_threads=1)
            n_pieces = np.fromiter(map(len, pieces), np.int64, len(parts))
            fell = self.fallback[np.fromiter(chain.from_iterable(pieces), np.int64, n_pieces.sum())]
            fell = np.bincount(np.repeat(np.arange(len(parts)), n_pieces)[fell], minlength=len(parts))
            per = np.stack([n_tokens, n_pieces, fell], 1)
            if owner is not None:
                per = np.stack([np.bincount(owner, per[:, k], len(new)).astype(np.int64) for k in range(3)], 1)
            self.starts = np.concatenate([self.starts, len(self.tokens) + np.cumsum(per[:, 0]) - per[:, 0]])
            self.tokens = np.concatenate([self.tokens, tokens])
            self.per_word = np.concatenate([self.per_word, per])
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


@lru_cache(1)
def _loaded(ranks: bytes, pattern: str, pieces: bytes) -> Vocabularies:
    return Vocabularies(ranks, pattern, pieces)


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Owner and value of every element."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), n), pc.list_flatten(lists)


def _repeated(doc: np.ndarray, codes: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document inside windows that it holds twice or more."""
    size = WINDOW
    if len(codes) < size:
        return np.zeros(n_docs, np.int64)
    last = len(codes) - size + 1
    at = np.flatnonzero(doc[:last] == doc[size - 1:])
    odd = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        mixed = (doc[at].astype(np.uint64) + np.uint64(1)) * odd
        for k in range(size):
            mixed = (mixed ^ (codes[at + k].astype(np.uint64) + np.uint64(k + 1))) * odd
            mixed ^= mixed >> np.uint64(29)
    _, group, n = np.unique(mixed, return_inverse=True, return_counts=True)
    at = at[n[group] > 1]
    if not len(at):
        return np.zeros(n_docs, np.int64)
    rows = np.stack([doc[at], *(codes[at + k] for k in range(size))], 1)
    _, group, n = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[n[group.ravel()] > 1]
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    return np.bincount(doc, np.cumsum(change)[:-1] > 0, n_docs).astype(np.int64)


def _entropy(doc: np.ndarray, tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    keys = np.sort(doc.astype(np.int64) << 32 | tokens)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([first, [len(keys)]]))
    total = np.bincount(keys[first] >> 32, times * np.log2(np.maximum(times, 1)), len(n))
    some = np.maximum(n, 1)
    return np.log2(some) - total / some


def measure(texts: pa.Array, known: Vocabularies) -> dict[str, np.ndarray]:
    """Counts and measures of every text; measures are NaN without words."""
    n_docs = len(texts)
    doc, words = _flat(pc.ascii_split_whitespace(texts))
    some = pc.not_equal(words, "")
    doc, words = doc[some.to_numpy(zero_copy_only=False)], words.filter(some).dictionary_encode()
    codes, distinct = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
    count = lambda owner, weight=None: np.bincount(owner, weight, n_docs).astype(np.int64)
    whole = lambda x: x.to_numpy(zero_copy_only=False).astype(np.int64)
    out = {"n_words": count(doc), "word_chars": count(doc, whole(pc.utf8_length(distinct))[codes]),
           "n_symbols": count(doc, whole(pc.count_substring_regex(distinct, SYMBOLS))[codes]),
           "n_repeat_words": _repeated(doc, codes, n_docs)}
    owner, lines = _flat(pc.split_pattern(texts, "\n"))
    lines = lines.dictionary_encode()
    line = whole(lines.indices)
    full = pc.match_substring_regex(lines.dictionary, WORD).to_numpy(zero_copy_only=False).astype(bool)[line]
    owner, line = owner[full], line[full]
    out["n_dup_lines"] = count(owner) - count(np.unique(owner << 32 | line) >> 32)
    row = known.rows(distinct.to_pylist())[codes]
    per = known.per_word[row]
    n_tokens, n_pieces, fell = (count(doc, per[:, k]) for k in range(3))
    out["n_tokens"] = n_tokens
    ends = np.cumsum(per[:, 0])
    tokens = known.tokens[np.repeat(known.starts[row] - ends + per[:, 0], per[:, 0]) + np.arange(ends[-1] if len(ends) else 0)]
    with np.errstate(invalid="ignore", divide="ignore"):
        out |= {"chars_per_token": out["word_chars"] / n_tokens, "chars_per_piece": out["word_chars"] / n_pieces,
                "fallback_share": fell / n_pieces,
                "token_entropy": np.where(n_tokens > 0, _entropy(np.repeat(doc, per[:, 0]), tokens, n_tokens), np.nan)}
    return out


def script(text: str) -> str:
    """The script of most letters, by the first word of their Unicode names; empty without letters."""
    seen = Counter(text)
    found: Counter = Counter()
    for c, n in seen.items():
        if c.isalpha():
            found[unicodedata.name(c, "other").split()[0]] += n
    return min(found, key=lambda s: (-found[s], s), default="")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(size)]
    for i, j in zip(cuts, cuts[1:]):
        if j > i:
            yield batch.slice(i, j - i)


def _tasks(ranks, pattern: str, pieces) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _loaded(ranks.value, pattern, pieces.value)
        for batch in batches:
            for part in _slices(batch):
                got = measure(part.column("text"), known)
                groups = [lang if lang and lang.strip() else f"script {script(text or '')}" for lang, text in
                          zip(part.column("lang").to_pylist(), _only_without(part))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(groups, pa.string()), *(pa.array(got[c], pa.int64()) for c in _COUNTS),
                     *(pa.array(got[c], kind, from_pandas=True) for c, kind in _MEASURES.items())],
                    names=["id", "family", *_COUNTS, *_MEASURES])
    return run


def _only_without(part: pa.RecordBatch) -> list[str | None]:
    """Texts of the rows without a language; None for the others."""
    named = pc.fill_null(pc.match_substring_regex(part.column("lang"), r"\S"), False)
    return pc.if_else(named, pa.scalar(None, pa.string()), part.column("text")).to_pylist()


def measures(df: DataFrame, ranks_path: str, pattern: str, pieces_path: str, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """``id``, ``family`` (language or script), the counts and the measures of every row's whole text."""
    contents = []
    for path in (ranks_path, pieces_path):
        if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
        with open(path, "rb") as f:
            contents.append(df.sparkSession.sparkContext.broadcast(f.read()))
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("family", T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in _COUNTS),
                           *(T.StructField(c, T.DoubleType()) for c in _MEASURES)])
    return rows.mapInArrow(_tasks(contents[0], pattern, contents[1]), schema)


def _quartiles(rows: DataFrame, keys: list[str], reach: float) -> DataFrame:
    """``keys``, ``measure``, ``low``, ``high`` of every group with ``SUPPORT`` documents."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) / STEP).alias("bin"),
                                        F.lit(least).alias("least")) for m, least in LEAST_RANGE.items()]))
    bins = (rows.select(*keys, each.alias("m")).select(*keys, "m.*")
            .groupBy(*keys, "measure", "least", "bin").agg(F.count("*").alias("n")))
    upto = " partition by " + ", ".join([*keys, "measure"])
    bins = bins.selectExpr("*", f"sum(n) over ({upto} order by bin) as upto", f"sum(n) over ({upto}) as total")
    group = bins.where(F.col("total") >= SUPPORT).groupBy(*keys, "measure", "least")
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("bin"))) * STEP
    room = F.greatest(F.col("q3") - F.col("q1"), F.col("least")) * reach
    return (group.agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
            .select(*keys, "measure", (F.col("q1") - room).alias("low"), (F.col("q3") + room + STEP).alias("high")))


def _wide(bands: DataFrame, keys: list[str], tag: str) -> DataFrame:
    one = lambda m, end: F.max(F.when(F.col("measure") == m, F.col(end))).alias(f"{tag}_{m}_{end}")
    return bands.groupBy(*keys).agg(*[one(m, end) for m in LEAST_RANGE for end in ("low", "high")])


def judge(measured: DataFrame, reach: float = REACH) -> DataFrame:
    """The measured documents with ``base_failed`` and ``kept``; the bands cover all that pass the base rules."""
    failed = ((F.col("n_words") < LEAST_WORDS)
              | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    rows = measured.withColumn("base_failed", failed).withColumn(
        "size", F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int"))
    good = rows.where(~F.col("base_failed"))
    own = _wide(_quartiles(good, ["family", "size"], reach), ["family", "size"], "own")
    wider = _wide(_quartiles(good, ["family"], reach), ["family"], "all")
    out = rows.join(own, ["family", "size"], "left").join(wider, "family", "left")
    inside = F.lit(True)
    for m in LEAST_RANGE:
        low, high = ([F.col(f"own_{m}_{end}")] + [F.col(f"all_{m}_{end}")] * (m != "token_entropy") for end in ("low", "high"))
        fits = F.col(m) <= F.coalesce(*high)
        if m != "fallback_share":                      # too few fallback tokens are no fault
            fits = fits & (F.col(m) >= F.coalesce(*low))
        inside = inside & F.coalesce(fits, F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside)


def rules(df: DataFrame, ranks_path: str, pattern: str, pieces_path: str, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str | None = "lang", reach: float = REACH) -> DataFrame:
    """Per row: id, base counts, measures, ``base_failed`` and ``kept``."""
    measured = written(measures(df, ranks_path, pattern, pieces_path, id_col, text_col, lang_col), "fertility")
    return judge(measured, reach).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", *_MEASURES)
