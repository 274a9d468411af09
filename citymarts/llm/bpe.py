"""Byte-pair encoding and decoding with forced-boundary splitting.

A merge never crosses a place whose two neighbouring byte symbols stand next
to each other in no vocabulary token: every token covering the place would
have to contain that pair. Such places are certain cuts. A word is cut there,
each fragment is merged on its own, and the ids are concatenated; the result
equals that of merging the whole word.

A task works on slices of documents. Their pieces between white space are
told apart first; pieces not seen before are cut into words and fragments, and
all fragments of a slice are merged side by side, a merge of each at a time.

Defined results: a NULL or empty text gives no ids and an empty decoded text;
a NULL id is kept; repeated rows give repeated results; an empty table gives
an empty result. Other columns of the input are not read, so their names do
not matter.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Regex, Tokenizer, pre_tokenizers

MAX_VOCABULARY_BYTES = 64 << 20  # the vocabulary file is broadcast; larger ones are refused
CACHED = 800_000                 # pieces remembered by a Python worker before it starts anew
SLICE_BYTES = 4 << 20            # of text encoded at a time
#: The pattern of words in the tokenizer file, and the same for the standard library.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: White space for the standard library alone.
SEPARATOR = re.compile("[\x1c-\x1f]")
WIDTHS = (6, 12, 24)             # fragments up to so many symbols are merged side by side; for longer ones a heap finds the next merge


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _normal(text: str) -> str:
    """NFC and lower case of each character; white space needs no care, as no word holds any."""
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()


class ForcedBoundaryBPE:
    """Encoder and decoder for a ``tokenizers`` JSON file: BPE with a word-end suffix."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"] != "BPE" or split["type"] != "Split" or not split["invert"]
                or split["behavior"] != "Removed" or level["type"] != "ByteLevel"
                or level["use_regex"] or level["add_prefix_space"] or spec["decoder"]
                or spec["post_processor"] or model.get("continuing_subword_prefix")):
            raise ValueError("unsupported tokenizer file: a byte-level word BPE is expected")
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.symbols = byte_symbols()
        self.joined = {p for t in self._bodies() for p in zip(t, t[1:])}
        if split["pattern"]["Regex"] != SPLIT_PATTERN:
            raise ValueError("unsupported tokenizer file: another pattern of words is expected")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)
        self.normalizer = Tokenizer.from_str(content).normalizer
        self.same: set[str] = set()   # characters that the standard library treats alike
        self.other: set[str] = set()
        # merges by number: the pair's key, its rank and what it becomes; no token has the number none
        self.none = len(self.vocab) + 1
        keys = np.array([self.vocab[x] * self.none + self.vocab[y] for x, y in merges], np.int64)
        self.by_key = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.by_key]
        self.becomes = np.array([self.vocab[x + y] for x, y in merges], np.int64)
        self.inner = np.array([self.vocab[c] for c in self.symbols], np.int64)      # tokens of a byte: inside a word,
        self.last = np.array([self.vocab[c + self.end] for c in self.symbols], np.int64)  # at its end
        self.stays = np.array([[(x, y) in self.joined for y in self.symbols] for x in self.symbols])
        self.tokens = pa.array([self.names.get(i, "") for i in range(max(self.names) + 1)], pa.string())
        self.clear()

    def clear(self) -> None:
        self.pieces: dict[str, int] = {}                # piece between white space -> its place in starts and counts
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _bodies(self) -> Iterator[str]:
        for t in self.vocab:
            yield t.removesuffix(self.end) if self.end and len(t) > len(self.end) else t

    def fragments(self, symbols: str) -> list[str]:
        """``symbols`` cut at every pair that no vocabulary token contains."""
        cuts = [i for i, p in enumerate(zip(symbols, symbols[1:]), 1) if p not in self.joined]
        return [symbols[i:j] for i, j in zip([0, *cuts], [*cuts, len(symbols)])]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, or the number of merges where there is none."""
        pair = left * self.none + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where((self.keys[at] == pair) & (right < self.none), self.by_key[at], len(self.keys))

    def merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Rows of tokens (filled up with ``none``), each after all its merges: the lowest rank, leftmost first."""
        out, row = ids.copy(), np.arange(len(ids))
        rank, never = self._rank(ids[:, :-1], ids[:, 1:]), len(self.keys)
        at = np.arange(ids.shape[1])
        while len(row):
            low = rank.min(1)
            live = low < never
            out[row[~live]] = ids[~live]
            row, ids, rank, low = row[live], ids[live], rank[live], low[live]
            if not len(row):
                break
            i, n = rank.argmin(1), np.arange(len(row))
            moved = at + (at > i[:, None])
            ids = np.take_along_axis(np.pad(ids, ((0, 0), (0, 1)), constant_values=self.none), moved, 1)
            ids[n, i] = self.becomes[low]
            rank = np.take_along_axis(np.pad(rank, ((0, 0), (0, 1)), constant_values=never), at[:-1] + (at[:-1] >= i[:, None]), 1)
            after = np.minimum(i, rank.shape[1] - 1)    # the pair that the new token opens; past the end it is none
            rank[n, after] = np.where(i < rank.shape[1], self._rank(ids[n, after], ids[n, after + 1]), rank[n, after])
            before = np.flatnonzero(i)
            rank[before, i[before] - 1] = self._rank(ids[before, i[before] - 1], ids[before, i[before]])
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and their number for each."""
        data = [w.encode() for w in words]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        raw = np.frombuffer(b"".join(data), np.uint8)
        tokens = self.inner[raw]
        tokens[ends - 1] = self.last[raw[ends - 1]]
        opens = np.ones(len(raw), bool)                 # certain cuts, and the words' first bytes
        opens[1:] = ~self.stays[raw[:-1], raw[1:]]
        opens[ends[:-1]] = True
        start = np.flatnonzero(opens)
        size = np.diff(start, append=len(raw))
        count = np.ones(len(start), np.int64)
        found = np.full(len(raw), self.none, np.int64)  # a fragment's ids stand where its bytes do, the rest is none
        alone = size == 1
        found[start[alone]] = tokens[start[alone]]
        least = 1
        for width in WIDTHS:
            at = np.flatnonzero((size > least) & (size <= width))
            if len(at):
                place = np.arange(width)
                held = place < size[at, None]
                where = np.minimum(start[at, None] + place, len(raw) - 1)
                rows = self.merge_rows(np.where(held, tokens[where], self.none))
                found[where[held]] = rows[held]
                count[at] = (rows < self.none).sum(1)
            least = width
        for k in np.flatnonzero(size > least):
            parts = [self.symbols[b] for b in raw[start[k]:start[k] + size[k]]]
            if ends[np.searchsorted(ends, start[k], side="right")] == start[k] + size[k]:
                parts[-1] += self.end
            merged = [self.vocab[t] for t in self._merge_long(parts)]
            found[start[k]:start[k] + len(merged)], count[k] = merged, len(merged)
        word = np.searchsorted(ends, start, side="right")
        return found[found < self.none].astype(np.int32), np.bincount(word, count, len(words)).astype(np.int64)

    def _merge_long(self, parts: list[str]) -> list[str]:
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = [(self.ranks[p], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (rank := self.ranks.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (rank, a, parts[a], parts[b]))
        return [p for p in parts if p]

    def alike(self, text: str) -> bool:
        """Whether the standard library treats every character as the tokenizer's engine does.

        Each character is tried once: their Unicode versions differ.
        """
        chars = set(text)
        if not chars <= self.same:
            for c in chars - self.same - self.other:
                probe = f"a{c}{c}a"
                normal = self.normalizer.normalize_str(probe)
                split = [w for w, _ in self.split.pre_tokenize_str(normal)]
                good = WORD.findall(normal) == split == WORD.findall(_normal(probe))
                (self.same if good else self.other).add(c)
            return chars <= self.same
        return True

    def plain(self, text: str) -> str | None:
        """``text`` normalised, or None where the library has to do it."""
        if text.isascii() and not SEPARATOR.search(text) or self.alike(text):
            plain = _normal(text)
            if unicodedata.is_normalized("NFC", text) or self.alike(plain):
                return plain
        return None

    def words(self, piece: str) -> list[str]:
        plain = piece.isascii() and not SEPARATOR.search(piece) or self.alike(piece)
        return WORD.findall(piece) if plain else [w for w, _ in self.split.pre_tokenize_str(piece)]

    def places(self, pieces: list[str]) -> np.ndarray:
        """The place of each piece in ``starts`` and ``counts``; new ones are encoded."""
        if len(self.pieces) > CACHED:
            self.clear()
        new = [p for p in pieces if p not in self.pieces]
        if new:
            words = [self.words(p) for p in new]
            ids, counts = self.encode_words([*chain.from_iterable(words)])
            owner = np.repeat(np.arange(len(new)), [*map(len, words)])
            counts = np.bincount(owner, counts, len(new)).astype(np.int64)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])
            self.pieces.update(zip(new, range(len(self.pieces), len(self.pieces) + len(new))))
        return np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))

    def _by_library(self, text: str) -> list[int]:
        """Special tokens, and text that the library has to normalise and split."""
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                plain = self.plain(part)
                words = (WORD.findall(plain) if plain is not None else
                         [w for w, _ in self.split.pre_tokenize_str(self.normalizer.normalize_str(part))])
                out += self.encode_words(words)[0].tolist() if words else []
        return out

    def encode_all(self, texts: list[str]) -> pa.ListArray:
        """The ids of every text."""
        special = [bool(self.cut and self.cut.search(t)) for t in texts]
        plain = [None if s else self.plain(t) for s, t in zip(special, texts)]
        lists = pc.ascii_split_whitespace(pa.array([p or "" for p in plain], pa.string()))
        doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        pieces = pc.list_flatten(lists)
        some = pc.not_equal(pieces, "")
        doc, pieces = doc[some.to_numpy(zero_copy_only=False)], pieces.filter(some).dictionary_encode()
        place = self.places(pieces.dictionary.to_pylist())[pieces.indices.to_numpy(zero_copy_only=False)]
        n = self.counts[place]
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(self.starts[place] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        length = np.bincount(doc, n, len(texts)).astype(np.int64)
        odd = [k for k, p in enumerate(plain) if p is None]
        if odd:
            parts = np.split(ids, np.cumsum(length)[:-1])
            for k in odd:
                parts[k] = np.array(self._by_library(texts[k]), np.int32)
                length[k] = len(parts[k])
            ids = np.concatenate(parts)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(ids, pa.int32()))

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of every list joined by one space, as the file names no decoder."""
        tokens = self.tokens.take(ids.values).cast(pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens), " ")

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].as_py()

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


@lru_cache(1)
def _loaded(content: str) -> ForcedBoundaryBPE:
    """One coder for each Python worker: its tables and caches serve all tasks of the worker."""
    return ForcedBoundaryBPE(content)


def _tasks(content) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(content.value)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES)) + 1), len(size)]
            for i, j in zip(cuts, cuts[1:]):
                if j > i:
                    part = batch.slice(i, j - i)
                    ids = bpe.encode_all(pc.fill_null(part.column("text"), "").to_pylist())
                    yield pa.RecordBatch.from_arrays([part.column("id"), ids, bpe.decode_all(ids)], names=["id", "ids", "decoded"])
    return run


def encode_decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array<int>) and ``decoded`` of every row's whole text."""
    if os.path.getsize(vocabulary) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(vocabulary, encoding="utf-8") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(_tasks(content), schema).withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and SHA-256 of the ids and of the decoded text."""
    return encoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
