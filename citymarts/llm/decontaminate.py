"""Benchmark decontamination by template canonicalisation.

Numbers, units after a number and names (capitalised words inside a sentence)
become typed placeholders, all other words lower case. Windows of ``WINDOW``
tokens of the benchmark items (whole items where they are shorter) are
hash-joined with those of the documents; a window of nearly only placeholders
does not count as a template. With ``valued``, as in the registered query and
the pipeline, windows with placeholders are also joined by their own values, so
that verbatim copies match however many numbers and names they hold, and so are
whole items of fewer than ``SHORTEST`` tokens. Hits of a document and an item that lie on one diagonal, i.e.
at a constant distance, belong together, and so do diagonals at most ``SLIP``
tokens apart, as words put in or left out make them: they are one alignment.
Its slots must be consistent: the same value of the item always stands for the
same value of the document and the other way round. Values that stand together
most often are taken first, and windows that hold other pairs do not count. An
alignment that covers at least ``COVERAGE`` of the item's tokens, or ``RUN`` of
them verbatim in a row, is a leak: exact if no slot holds another value than
the item's, re-parameterised otherwise. Without ``valued``, every diagonal
stands alone, a conflict voids it, and coverage decides.

Hits are sorted by document and item and aligned as they stream by; the hits of
one alignment are held at a time, all of one document's text.

The document's windows are made in tasks. Where the benchmark has at most
``BROADCAST_WINDOWS`` windows, their hashes are broadcast (8 bytes each) and
tasks return the windows among them; beyond that all windows are returned and
the join decides alone. Either way the same rows come out.

Defined results: NULL and empty texts and items have no windows and no leaks,
nor have items of fewer than ``SHORTEST`` tokens without ``valued``; a NULL id is kept; repeated
rows give one finding each per id and text; an empty table, documents or
benchmark, gives an empty result. Positions are code points, end exclusive.
Other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

WINDOW = 8
SHORTEST = 5
PLAIN = 5            # tokens of a window (at most) that must not be placeholders
COVERAGE = 0.5
RUN = 25             # tokens of an item that are a leak wherever they stand verbatim in a row
SLIP = 16            # tokens between the diagonals of one alignment
BROADCAST_WINDOWS = 4_000_000
CACHED = 300_000     # words that a Python worker remembers
STEP = 500_000       # windows looked up at a time
TEXTS, CHARS = 200, 300_000     # texts that go through the search together

#: Number words and units.
NUMBERS = frozenset("two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
                    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles g kg mg pound pounds ounce ounces ton tons l ml "
                  "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days "
                  "week weeks month months year years dollar dollars euro euros cent cents percent degrees mph kmh w kw "
                  "kwh v hz khz mhz ghz kb mb gb tb".split())
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|\w+|[.!?:;\n]+")
_PLAIN, _NUMBER, _TITLE, _UNIT, _STOP = range(5)
_rng = np.random.default_rng(20240202)
_POSITION = _rng.integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)
_TYPE = {"number": np.uint64(0x1B5AD4CECEDA1CE9), "unit": np.uint64(0x2B7E151628AED2A7), "name": np.uint64(0x3C6EF372FE94F82B)}


class _Known(dict):
    """word -> its place in ``hashes`` and ``kinds``."""

    def __init__(self):
        self.hashes, self.kinds = array("Q"), array("b")

    def __missing__(self, word: str) -> int:
        low = word.lower()
        if not (word[0].isalnum() or word[0] == "_"):
            kind = _STOP
        elif word[0].isdigit() or low in NUMBERS:
            kind = _NUMBER
        elif low in UNITS:
            kind = _UNIT
        elif len(word) > 1 and word[0].isupper() and word[1:].islower():
            kind = _TITLE
        else:
            kind = _PLAIN
        self[word] = place = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(low))
        self.kinds.append(kind)
        return place

    def look_up(self, words: Iterable[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, kinds) of ``n`` words."""
        if len(self) >= CACHED:
            self.clear()
            self.__init__()
        at = np.fromiter(map(self.__getitem__, words), np.int64, n)
        return np.frombuffer(self.hashes, np.uint64)[at] if n else at.astype(np.uint64), (
            np.frombuffer(self.kinds, np.int8)[at] if n else at.astype(np.int8))


_known = _Known()


def canonical(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the canonical tokens, their slot types (0: none), their places among all matches of ``_TOKEN``, hashes of
    the tokens themselves)."""
    words = _TOKEN.findall(text)
    return _canonical(*_known.look_up(words, len(words)), np.zeros(1, np.int64))


def _canonical(h: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``canonical`` of tokens with these hashes and kinds; ``starts``: places where a text begins."""
    own = h.copy()
    before = np.roll(kind, 1)
    before[starts[starts < len(before)]] = _STOP
    number = kind == _NUMBER
    unit = (kind == _UNIT) & (before == _NUMBER)
    name = (kind == _TITLE) & (before != _STOP)
    h[number], h[unit], h[name] = _TYPE["number"], _TYPE["unit"], _TYPE["name"]
    at = np.flatnonzero(kind != _STOP)
    return h[at], (number * 1 + unit * 2 + name * 3).astype(np.int8)[at], at, own[at]


def windows(h: np.ndarray, slots: np.ndarray, n: int, valued: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the windows of ``n`` tokens that hold enough plain words; with ``valued``, of those with a slot."""
    count = len(h) - n + 1
    if count < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(count, np.uint64(n) * np.uint64(0x9E3779B97F4A7C15))
    for k in range(n):
        total += h[k:k + count] * _POSITION[k]
    total = (total ^ (total >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    total ^= total >> np.uint64(33)
    plain = np.concatenate([[0], np.cumsum(slots == 0)])
    plain = plain[n:] - plain[:-n]
    at = np.flatnonzero(plain < n if valued else plain >= min(n, PLAIN))
    return at, total[at]


def _rows(text: str, lengths: list[int], among: np.ndarray | None, valued: bool = False) -> list[tuple]:
    """(hash, place, length, start, end, slot values) of the text's windows, of those in ``among`` if given.

    With ``valued``, also of windows by their own values, which leave no slot to compare. A window
    without slots has one hash for both, so that it meets one with a name that begins a sentence.
    """
    h, slots, at, own = canonical(text)
    out, spans = [], None
    for n, by_value in [(n, v) for n in lengths for v in ([False, True] if valued else [False])]:
        places, hashes = windows(own if by_value else h, slots, n, by_value)
        if among is not None:
            hit = np.concatenate([_in(hashes[i:i + STEP], among) for i in range(0, len(hashes), STEP)] or [np.zeros(0, bool)])
            places, hashes = places[hit], hashes[hit]
        if not len(places):
            continue
        spans = spans or [m.span() for m in _TOKEN.finditer(text)]
        for p, x in zip(places.tolist(), hashes.astype(np.int64).tolist()):
            values = [] if by_value else [text[slice(*spans[at[k]])].lower() for k in range(p, p + n) if slots[k]]
            out.append((x, p, n, spans[at[p]][0], spans[at[p + n - 1]][1], values))
    return out


def _marks(ordered: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """(a table of the first bits that hashes in ``ordered`` have, the shift to these bits)."""
    bits = min(24, max(16, len(ordered).bit_length() + 4))
    table, shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
    table[ordered >> shift] = True
    return table, shift


def _hit(texts: list[str], lengths: list[int], among: np.ndarray, marks: tuple[np.ndarray, np.uint64], valued: bool) -> list[int]:
    """Which of the texts have a window in ``among``: all texts' tokens go through ``windows`` as one row."""
    parts = [_TOKEN.findall(t) for t in texts]
    count = np.array([len(p) for p in parts], np.int64)
    words = _known.look_up(chain.from_iterable(parts), int(count.sum()))
    h, slots, at, own = _canonical(*words, np.cumsum(count) - count)
    doc = np.repeat(np.arange(len(texts)), count)[at]
    table, shift = marks
    found: set[int] = set()
    for n, by_value in [(n, v) for n in lengths for v in ([False, True] if valued else [False])]:
        places, hashes = windows(own if by_value else h, slots, n, by_value)
        near = np.flatnonzero(table[hashes >> shift])
        near = near[doc[places[near]] == doc[places[near] + n - 1]]      # no window of two texts
        found.update(doc[places[near[_in(hashes[near], among)]]].tolist())
    return sorted(found)


def _in(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


ROWS = "same long, hash long, place int, length int, start int, end int, slots array<string>"


def _parts(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in order, at most ``TEXTS`` at a time and, but for a longer text alone, ``CHARS`` characters."""
    first = size = 0
    for i, t in enumerate(pdf["text"]):
        if i > first and (i - first >= TEXTS or size + len(t) > CHARS):
            yield pdf.iloc[first:i]
            first, size = i, 0
        size += len(t)
    yield pdf.iloc[first:]


def _windowing(among, lengths: list[int], valued: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = among.value if among is not None else None
        marks = _marks(hashes) if hashes is not None else None
        for pdf in batches:
            for part in _parts(pdf):
                if hashes is not None:      # texts without a window of the benchmark go at once
                    part = part.iloc[_hit([*part["text"]], lengths, hashes, marks, valued)]
                rows = [(k, s, *r) for k, s, t in zip(part["id"], part["same"], part["text"])
                        for r in _rows(t, lengths, hashes, valued)]
                yield pd.DataFrame(rows, columns=["id", "same", "hash", "place", "length", "start", "end", "slots"])
    return run


def _item_windows(valued: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["item"], pdf["text"]):
                n = len(canonical(t)[0])
                if n >= (1 if valued else SHORTEST):
                    rows += [(i, n, *r) for r in _rows(t, [min(n, WINDOW)], None, valued)]
            yield pd.DataFrame([(i, n, x, p, k, v) for i, n, x, p, k, _, _, v in rows],
                               columns=["item", "tokens", "hash", "at", "length", "values"])
    return run


def align(hits: list[tuple], coverage: float, merged: bool) -> tuple | None:
    """(coverage, shift, start, end, windows, changed) of an alignment that is a leak, else None.

    ``hits``: (shift, at, start, end, length, tokens, item's values, document's values), sorted.
    """
    votes = Counter(pair for h in hits for pair in zip(h[6], h[7]))
    here, there = {}, {}
    for (a, b), _ in sorted(votes.items(), key=lambda v: (-v[1], v[0])):
        if a not in here and b not in there:
            here[a], there[b] = b, a
    fit = [h for h in hits if all(here.get(a) == b for a, b in zip(h[6], h[7]))]
    if not fit or (len(fit) < len(hits) and not merged):
        return None
    length, tokens = hits[0][4], max(h[5] for h in hits)
    verbatim = {h[1] for h in hits if list(h[6]) == list(h[7])}
    changed = {(a, b) for h in hits if h[1] not in verbatim for a, b in zip(h[6], h[7]) if a != b}
    covered, to = 0, 0
    for at in sorted({h[1] for h in fit}):
        covered += at + length - max(at, to)
        to = at + length
    run, first, last = 0, None, None
    for shift, at, *_, a, b in hits:
        if list(a) == list(b):
            if shift != last or at > to:
                first = at
            last, to = shift, at + length
            run = max(run, to - first)
    if covered < coverage * tokens and not (merged and run >= RUN):
        return None
    return (covered / tokens, fit[0][0], min(h[2] for h in fit), max(h[3] for h in fit),
            len({h[:2] for h in fit}), len(changed))


def _aligning(coverage: float, merged: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Hits come sorted by document, item, shift and place in the item; the best alignment of each document and item goes out."""
    def alignments(hits: Iterator[tuple]) -> Iterator[list[tuple]]:
        out: list[tuple] = []
        for h in hits:
            if out and h == out[-1]:  # repeated rows
                continue
            if out and h[0] - out[-1][0] > (SLIP if merged else 0):
                yield out
                out = []
            out.append(h)
        yield out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((*r[:-2], tuple(r[-2]), tuple(r[-1])) for pdf in batches for r in pdf.itertuples(index=False, name=None))
        out = []
        for key, hits in groupby(rows, key=lambda r: r[:3]):
            leaks = filter(None, (align(a, coverage, merged) for a in alignments(h[3:] for h in hits)))
            best = min(leaks, key=lambda x: (-x[0], x[5], x[1]), default=None)
            if best:
                out.append((key[0], key[2], best[2], best[3], best[4], best[0], best[5]))
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=_ALIGNED)
                out = []
        yield pd.DataFrame(out, columns=_ALIGNED)
    return run


_ALIGNED = ["id", "item", "start", "end", "windows", "coverage", "changed"]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", coverage: float = COVERAGE, broadcast_windows: int = BROADCAST_WINDOWS,
          valued: bool = False) -> DataFrame:
    """One row for each document (id and text) and item: the alignment that covers most of the item.

    ``id_col``, ``item_col``, start, end, windows (matched), coverage, changed
    (slots with another value) and kind (exact or reparameterised). With
    ``valued``, windows are also compared by their own values.
    """
    spark = docs.sparkSession
    # ids go through pandas as strings, as numbers beside NULL would become floating there
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    made = items.mapInPandas(_item_windows(valued), "item string, tokens int, hash long, at int, length int, values array<string>")
    lengths = sorted(r.length for r in made.select("length").distinct().collect())  # at most WINDOW
    distinct = made.select("hash").distinct()
    among = None
    if distinct.count() <= broadcast_windows:
        hashes = np.sort(np.array([r.hash for r in distinct.collect()], np.int64).astype(np.uint64))
        among = spark.sparkContext.broadcast(hashes)
        made = F.broadcast(made) if broadcast_windows <= BROADCAST_WINDOWS and len(hashes) <= 200_000 else made
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = rows.withColumn("same", F.xxhash64("text"))
    found = rows.select("id", "same", "text").mapInPandas(_windowing(among, lengths, valued), f"id string, {ROWS}")
    hits = found.join(made, ["hash", "length"]).select(
        "id", "same", "item", (F.col("place") - F.col("at")).alias("shift"), "at", "start", "end", "length", "tokens", "values", "slots")
    order = ["id", "same", "item"]
    dealt = hits.repartition(*order).sortWithinPartitions(*order, "shift", "at", "start", "end", "tokens", "values", "slots")
    best = dealt.mapInPandas(_aligning(coverage, valued), "id string, item string, start int, end int, windows int, "
                                                          "coverage double, changed int")
    return best.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
                       F.col("item").cast(benchmark.schema[item_col].dataType).alias(item_col), "start", "end", "windows",
                       F.round("coverage", 6).alias("coverage"), "changed",
                       F.when(F.col("changed") == 0, "exact").otherwise("reparameterised").alias("kind"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id has no leak; rows with a NULL id stay."""
    bad = leaks(docs, benchmark, id_col=id_col, **options).select(F.col(id_col).alias("_leaked")).distinct()
    return docs.join(bad, docs[id_col] == bad["_leaked"], "left_anti")
