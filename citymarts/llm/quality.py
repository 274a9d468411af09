"""Quality classifier from weak labels.

1. Heuristic labellers vote on every document: low (1), fine (0) or no opinion
   (-1). Votes are counted by pattern over all documents, per task first;
   there are at most 3^labellers patterns.
2. Expectation-maximisation over these counts estimates how each labeller
   votes on low and on fine documents, without any gold label.
3. The posterior labels of a bounded sample (``TRAIN_DOCS`` documents in
   expectation, chosen by a hash of the id) train a linear scorer over hashed
   features: words, word shapes, repetition and votes.
4. The scorer decides on every whole document.

Two label models run side by side, one for quality and one for abuse; a
document is kept if neither rejects it.

Defined results: NULL, empty and blank texts are rejected with ``p_low`` 1 and
``p_toxic`` 0. A NULL id is kept as it is. Repeated rows get equal scores. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

TRAIN_DOCS = 8192
DIM = 1 << 15        # hashed features
WORD_SEED = 7        # keeps words apart from other features
ROUNDS = 100         # of expectation-maximisation
STEPS = 150          # of gradient descent

#: Words of abuse in the languages of the corpus.
ABUSE = frozenset("idiot idiots moron morons stupid pathetic worthless disgusting scum trash loser losers clown vermin "
         "imbecile crétin imbécile connard ordure idiota imbécil estúpido estúpida escoria trottel abschaum "
         "dummkopf widerlich".split())


_SYMBOL = re.compile(r"[^\w\s.,;:'\"()-]|_")
_RUN = re.compile(r"[*&$%#@^~=+<>{}\[\]|\\/_]{2,}")
_EDGE = ".,;:!?'\"()"


def _vote(x: float, fine_below: float, low_above: float) -> int:
    return 1 if x > low_above else 0 if x < fine_below else -1


class Examined:
    """What one pass over a document's words tells: counts for the labellers and the features."""

    def __init__(self, text: str):
        words = text.split()
        self.n, self.size, self.counts = max(1, len(words)), max(1, len(text)), Counter(words)
        self.seen: set[str] = set()
        self.shapes: Counter = Counter()
        runs = symbols = upper = bangs = hits = 0
        for w, k in self.counts.items():
            core = w.strip(_EDGE).lower()
            self.seen.add(core)
            if w.isalpha():
                self.shapes["upper" if len(w) > 1 and w.isupper() else "alpha"] += k
            else:
                self.shapes["plain" if w[0].isalpha() else "other"] += k
                if len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum():
                    self.shapes["tail"] += k
                symbols += k * len(_SYMBOL.findall(w))
                runs += k * len(_RUN.findall(w))
                bangs += k * w.count("!")
                if not any(map(str.isalnum, w)):
                    self.shapes["lone"] += k
            if not w.islower():
                upper += k * sum(map(str.isupper, w))
            if core in ABUSE:
                hits += k
        same = [*map(eq, words, words[1:])] if len(self.counts) < len(words) else []
        doubled = sum(same)
        stutter = sum(a and b and c for a, b, c in zip(same, same[1:], same[2:])) if doubled > 2 else 0
        n, size = self.n, self.size
        ends = sum(k for w, k in self.counts.items() if w[-1] in ".!?…。")
        #: quality labellers: symbol runs, symbol share, upper case, shouting, lone symbols, doubled words,
        #: stuttering, few distinct words, word length, sentences; abuse labellers: any, several, dense
        self.votes = [
            _vote(runs / n, 0.02, 0.1), _vote(symbols / size, 0.03, 0.08), _vote(upper / size, 0.1, 0.3),
            _vote(bangs / n, 0.05, 0.3), _vote(self.shapes["lone"] / n, 0.02, 0.15),
            _vote(2 * doubled / n, 0.05, 0.15), _vote(stutter / n, 0.01, 0.1),
            _vote(1 - len(self.counts) / n, 0.85, 0.92) if 20 <= n <= 2000 else -1,
            1 if not 2.5 <= size / n <= 20 else 0 if size / n < 12 else -1,
            _vote(n / (1 + ends), 60.0, 150.0) if n >= 30 else -1,
            int(hits > 0), 1 if hits > 1 else 0 if hits == 0 else -1, 1 if hits / n > 0.004 else 0 if hits == 0 else -1]


QUALITY_LABELLERS = 10


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """P(low | votes) per pattern; ``patterns`` holds a row of votes for each."""
    low, fine = (patterns == 1).sum(1), (patterns == 0).sum(1)
    # where the labellers disagree, one in three against is doubt enough to begin with
    p = np.where(low > 0, 0.9, 0.05) * np.where((low > 0) & (fine > 2 * low), 0.6, 1.0)
    for _ in range(rounds):
        logit = np.log((p @ counts + 1) / ((1 - p) @ counts + 1)) * np.ones(len(p))
        for j in range(patterns.shape[1]):
            for vote in (-1, 0, 1):
                at = patterns[:, j] == vote
                a = (p[at] @ counts[at] + 0.5) / (p @ counts + 1.5)
                b = ((1 - p[at]) @ counts[at] + 0.5) / ((1 - p) @ counts + 1.5)
                logit[at] += np.log(a / b)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p


def features(doc: Examined) -> dict[int, float]:
    """Hashed features of a document; every group of features has about unit length."""
    out: dict[int, float] = {}

    def add(name: str, value: float) -> None:
        at = zlib.crc32(name.encode()) % DIM
        out[at] = out.get(at, 0.0) + value

    for i, v in enumerate(doc.votes):
        add(f"vote {i} {v}", 1.0)
    for kind, k in doc.shapes.items():
        add(f"shape {kind}", k / doc.n)
        add(f"shape {kind} {10 * k // doc.n}", 0.5)
    add(f"distinct {10 * len(doc.counts) // doc.n}", 0.5)
    scale = 1 / np.sqrt(max(1, len(doc.seen)))
    for w in doc.seen:
        at = zlib.crc32(w.encode(), WORD_SEED) % DIM
        out[at] = out.get(at, 0.0) + scale
    return out


def fit(at: np.ndarray, x: np.ndarray, sizes: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights (and, last, the bias) of a logistic scorer for soft targets, classes balanced.

    ``at`` and ``x`` hold the features of all documents one after the other, ``sizes`` their number in each.
    """
    count = len(sizes)
    row = np.repeat(np.arange(count, dtype=np.int32), sizes)
    share = min(max(target.mean(), 1e-3), 1 - 1e-3)
    weight = target / share + (1 - target) / (1 - share)
    weight /= weight.sum()
    w, b, speed, speed_b = np.zeros(DIM), 0.0, np.zeros(DIM), 0.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, x * w[at], count) + b, -30, 30)))
        g = (p - target) * weight
        speed = 0.9 * speed - 4.0 * (np.bincount(at, x * g[row], DIM) + 1e-4 * w)
        speed_b = 0.9 * speed_b - 4.0 * g.sum()
        w, b = w + speed, b + speed_b
    return np.append(w, b)


def _patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: Counter = Counter()
    for pdf in batches:
        found.update(tuple(Examined(t).votes) for t in pdf["text"])
    if found:
        yield pd.DataFrame({"votes": [[*v] for v in found], "n": [*found.values()]})


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in filter(len, batches):
        docs = [Examined(t) for t in pdf["text"]]
        found = [features(d) for d in docs]
        yield pd.DataFrame({"votes": [d.votes for d in docs], "at": [np.fromiter(f, "<i4", len(f)).tobytes() for f in found],
                            "x": [np.fromiter(f.values(), "<f8", len(f)).tobytes() for f in found]})


def _scoring(model) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = model.value
        for pdf in batches:
            logits = []
            for text in pdf["text"]:
                f = features(Examined(text))
                logits.append(w[:, [*f]] @ np.fromiter(f.values(), float, len(f)) + w[:, -1])
            found = 1 / (1 + np.exp(-np.clip(np.array(logits).reshape(-1, 2), -30, 30)))
            yield pd.DataFrame({"id": pdf["id"], "p_low": found[:, 0], "p_toxic": found[:, 1]})
    return run


def train(docs: DataFrame) -> np.ndarray:
    """Scorer weights (quality, abuse) from documents with ``id`` and ``text``."""
    patterns = (docs.select("text").mapInPandas(_patterns, "votes array<int>, n long")
                .groupBy("votes").agg(F.sum("n").alias("n")).collect())  # at most 3^labellers rows
    if not patterns:
        return np.zeros((2, DIM + 1))
    votes, counts = np.array([r.votes for r in patterns]), np.array([r.n for r in patterns], float)
    known = {tuple(r.votes): p for r, *p in zip(patterns, posteriors(votes[:, :QUALITY_LABELLERS], counts),
                                                posteriors(votes[:, QUALITY_LABELLERS:], counts))}
    share = int(np.ceil(min(1.0, TRAIN_DOCS / counts.sum()) * (1 << 20)))
    sample = docs.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < share)
    # packed: as lists, every feature would be two objects of Python on the driver
    rows = sample.select("text").mapInPandas(_featured, "votes array<int>, at binary, x binary").collect()
    if not rows:
        return np.zeros((2, DIM + 1))
    target = np.array([known[tuple(r.votes)] for r in rows])
    sizes = np.array([len(r["at"]) // 4 for r in rows])
    at = np.frombuffer(b"".join(r["at"] for r in rows), "<i4")
    x = np.frombuffer(b"".join(r["x"] for r in rows), "<f8")
    del rows
    return np.stack([fit(at, x, sizes, target[:, j]) for j in (0, 1)])


def classify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``p_low``, ``p_toxic`` and ``keep``."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # white space of both the JVM and Python
    blank = F.col("text").rlike(r"^[\s\x1c-\x1f\x85\p{Z}]*$")
    docs = rows.where(~blank)
    model = df.sparkSession.sparkContext.broadcast(train(docs))  # 2 x (DIM + 1) numbers
    kind = rows.schema["id"].dataType.simpleString()
    scored = docs.mapInPandas(_scoring(model), f"id {kind}, p_low double, p_toxic double")
    empty = rows.where(blank).select("id", F.lit(1.0).alias("p_low"), F.lit(0.0).alias("p_toxic"))
    return scored.unionByName(empty).select(
        F.col("id").alias(id_col), "p_low", "p_toxic", ((F.col("p_low") < 0.5) & (F.col("p_toxic") < 0.5)).alias("keep"))
