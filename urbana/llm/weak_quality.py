"""A quality classifier without labels: overlapping heuristics, EM for their accuracies, a hashed linear scorer.

Each heuristic votes bad, good or nothing on each whole document. The votes of all documents are counted by pattern (a
bounded table), and expectation-maximisation finds the share of good documents and each heuristic's vote
probabilities in either class. The posterior of a document's pattern is its label for a linear scorer on the hashed byte
n-grams of the whole text and its repetitions, which is fitted on a bounded sample of documents and scores every document.

One pass takes the votes of all documents and the n-gram counts of the sampled ones, a second one scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbana.llm.arrow import slices, texts, with_columns
from urbana.llm.quality_rules import SYMBOLS
from urbana.llm.subwords import Descent
from urbana.session import cut

LABELLERS = ("symbols", "shouting", "repeats", "variety", "word_length", "clean_marks")
BAD, GOOD, NONE = 0, 1, 2
BUCKETS = 1 << 15  # of n-grams; two more features stand after them
FEATURES = BUCKETS + 2
SAMPLE = 2400  # different documents the scorer is fitted on at most or so, chosen by a hash of their text
ROUNDS = 60
STEPS = 60
SCALE = 8.0
KEEP = 0.3  # least score that is kept; both classes weigh half in the fit, so this leans towards keeping

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_PROSE = np.zeros(256, bool)
_PROSE[[*range(65, 91), *range(97, 123), *range(128, 256), *b" \n\t\r.,;:'-\"()"]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    global _POWERS, _INVERSES
    if n > len(_POWERS):
        size = max(n, 1 << 16)
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE, np.uint64)]))
        _INVERSES = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, pow(_BASE, -1, 2**64), np.uint64)]))
    return _POWERS[:n], _INVERSES[:n]


class Profile:
    """What the labellers and the scorer look at, of one whole text (UTF-8)."""

    def __init__(self, text: bytes):
        raw = np.frombuffer(text, np.uint8)
        self.size, self.raw = len(raw), raw
        space = _SPACE[raw]
        edges = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        starts, ends = np.nonzero(edges == -1)[0], np.nonzero(edges == 1)[0]
        self.n = n = len(starts)
        self.chars = int((~space & ((raw & 0xC0) != 0x80)).sum())
        self.symbols = int(_SYMBOL[raw].sum())
        self.upper = int(((raw >= 65) & (raw <= 90)).sum())
        self.prose = int(_PROSE[raw].sum())
        self.runs = self.repeats = 0
        self.different = n
        if n > 1:
            powers, inverses = _powers(len(raw))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(raw.astype(np.uint64) * powers + powers)])
            words = (sums[ends] - sums[starts]) * inverses[starts]  # equal for equal words
            words = (words ^ (words >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            self.different = len(np.unique(words))
            self.runs = int((words[1:] == words[:-1]).sum())
            if n > 2:
                grams = words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + words[2:] * np.uint64(0x165667B19E3779F9)
                _, of, count = np.unique(grams, return_inverse=True, return_counts=True)
                again = np.nonzero(count[of] > 1)[0]
                covered = np.zeros(n + 3, np.int64)
                np.add.at(covered, again, 1)
                np.add.at(covered, again + 3, -1)
                self.repeats = int((np.cumsum(covered) > 0).sum())

    def votes(self) -> list[int]:
        """The vote of each labeller. Texts under 5 words get no vote but that of their marks; repeats are words in 3-word windows found twice or more."""
        n, size = self.n, max(self.size, 1)
        short = n < 5
        upper, prose, different, mean = self.upper / size, self.prose / size, self.different / max(n, 1), self.chars / max(n, 1)

        def rule(bad: bool, good: bool) -> int:
            return NONE if short else BAD if bad else GOOD if good else NONE

        return [
            rule(10 * self.symbols > n, False),
            rule(upper > 0.2, upper < 0.1),
            rule(10 * self.repeats > 3 * n and 20 * self.runs > n, 20 * self.repeats < n),
            rule(different < 0.1, different > 0.6),
            rule(mean > 6.8 or mean < 2.5, 3.5 < mean < 6),
            BAD if prose < 0.9 else GOOD if prose > 0.97 else NONE,
        ]

    def pattern(self) -> int:
        return sum(x * 3**k for k, x in enumerate(self.votes()))

    def grams(self) -> np.ndarray:
        """The bucket of every byte n-gram of 1 to 3 bytes; white space is one byte like any other, all kinds alike."""
        one = np.where(_SPACE[self.raw], np.uint32(32), self.raw.astype(np.uint32))
        two = one[:-1] | one[1:] << np.uint32(8)
        three = two[:-1] | one[2:] << np.uint32(16)
        every = np.concatenate([one, two | np.uint32(1 << 24), three | np.uint32(2 << 24)])
        return (every * np.uint32(2654435761)) >> np.uint32(17)

    def repetition(self) -> tuple[float, float]:
        n = max(self.n, 1)
        return self.runs / n, self.repeats / n

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(number, value) of the features that are not 0: shares of the n-grams, and of words in runs and in repeated windows."""
        counts = np.bincount(self.grams(), minlength=BUCKETS)
        at = np.nonzero(counts)[0]
        return np.concatenate([at, [BUCKETS, BUCKETS + 1]]).astype(np.uint16), np.concatenate([counts[at] / max(counts.sum(), 1), self.repetition()]).astype(np.float32)


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the classes, and ``p[labeller, class, vote]``, by EM over the counts of vote patterns.

    Class 0 is good. Bad documents are bad in different ways, so each labeller's finds start as a bad class of their own;
    labellers are taken to be better than chance: a document that nobody marks bad starts as good.
    """
    v = np.array(list(patterns), int).reshape(-1, len(LABELLERS))
    n = np.array(list(patterns.values()), float)
    classes = len(LABELLERS) + 1
    if not len(n):
        return np.full(classes, 1 / classes), np.full((len(LABELLERS), classes, 3), 1 / 3)
    bad = v == BAD
    good = np.select([bad.sum(axis=1) == 0, bad.sum(axis=1) == 1], [0.95, 0.3], 0.03)
    by = np.where(bad.any(axis=1)[:, None], bad / np.maximum(bad.sum(axis=1), 1)[:, None], 1 / len(LABELLERS))
    q = np.hstack([good[:, None], (1 - good)[:, None] * by])
    for _ in range(rounds):
        weight = q * n[:, None]
        shares = (weight.sum(axis=0) + 1) / (n.sum() + classes)
        p = np.stack([[[weight[v[:, k] == vote, c].sum() + 0.1 for vote in range(3)] for c in range(classes)] for k in range(len(LABELLERS))])
        p /= p.sum(axis=2, keepdims=True)
        q = memberships(v, shares, p)
    return shares, p


def memberships(v: np.ndarray, shares: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The probability of each class for each vote pattern."""
    z = np.log(shares)[None, :] + sum(np.log(p[k][:, v[:, k]].T) for k in range(len(LABELLERS)))
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def posterior(v: np.ndarray, shares: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The probability that each vote pattern's documents are good."""
    return memberships(v, shares, p)[:, 0]


def accuracies(shares: np.ndarray, p: np.ndarray) -> dict[str, tuple[float, float, float, float]]:
    """Of each labeller, as estimated: how often it marks bad documents bad, and good documents bad, and good documents good, and bad documents good."""
    bad = shares[1:] / max(shares[1:].sum(), 1e-12)
    return {name: (float(p[k, 1:, BAD] @ bad), float(p[k, 0, BAD]), float(p[k, 0, GOOD]), float(p[k, 1:, GOOD] @ bad)) for k, name in enumerate(LABELLERS)}


def train(features: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights of the features and bias of a logistic scorer of documents with soft labels."""
    at, value = np.concatenate([x for x, _ in features]).astype(np.int64), np.concatenate([x for _, x in features])
    n = np.array([len(x) for x, _ in features])
    starts, row = np.concatenate([[0], np.cumsum(n)[:-1]]), np.repeat(np.arange(len(n)), n)
    table, bias = np.zeros((FEATURES, 1)), np.zeros(1)
    steppers = [Descent(table, 0.1, np.bincount(at, value, FEATURES) * 1e3, 0.999), Descent(bias, 0.1, share=1.0)]
    weight = np.where(good < 0.5, 0.5 / max((1 - good).sum(), 1e-9), 0.5 / max(good.sum(), 1e-9))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.add.reduceat(value * table[at, 0], starts) * SCALE + bias[0], -30, 30)))
        e = (p - good) * weight
        slope = np.bincount(at, value * e[row], FEATURES)[:, None] * SCALE
        for stepper, s in zip(steppers, (slope, e.sum(keepdims=True)), strict=True):
            stepper.step(s)
    return table[:, 0] * SCALE, float(bias[0])


def first_pass(rows: DataFrame) -> DataFrame:
    """``(pattern, n, mark, at, value)``: counts of the vote patterns of a slice of documents (``mark`` null), and the features of the sampled
    documents (``n`` 0). A text is sampled by its hash; equal texts of a slice come once."""
    share = min(1.0, SAMPLE / max(rows.count(), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        seen: set[int] = set()
        for b in slices(batches):
            found: list[tuple] = []
            for t in texts(b, "text"):
                profile = Profile(t)
                pattern = profile.pattern()
                counts[pattern] = counts.get(pattern, 0) + 1
                mark = xxhash.xxh64_intdigest(t, 9)
                if mark < share * 2**64 and mark not in seen:
                    if len(seen) < 4 * SAMPLE:
                        seen.add(mark)
                    found.append((pattern, 0, mark - 2**63, *(x.tobytes() for x in profile.features())))
            yield _batch(found)
        yield _batch([(k, n, None, None, None) for k, n in counts.items()])

    return rows.select("text").mapInArrow(run, "pattern int, n bigint, mark bigint, at binary, value binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["pattern", "n", "mark", "at", "value"])


def fit(rows: DataFrame) -> tuple[np.ndarray, float, dict[int, float], dict[str, tuple[float, float, float, float]]]:
    """Weights, bias, the posterior of each vote pattern that occurs, and the labellers' accuracies."""
    pieces = cut(first_pass(rows))
    found = {r["pattern"]: r["n"] for r in pieces.where("mark IS NULL").groupBy("pattern").agg(F.sum("n").alias("n")).collect()}  # at most 3 ** 6 rows
    unpack = lambda c: tuple(c // 3**k % 3 for k in range(len(LABELLERS)))
    shares, p = estimate({unpack(c): n for c, n in found.items()})
    label = {c: float(posterior(np.array([unpack(c)]), shares, p)[0]) for c in found}
    sample = pieces.where("mark IS NOT NULL").groupBy("mark").agg(F.first(F.struct("pattern", "at", "value")).alias("one"))
    got = sorted(sample.collect(), key=lambda r: r["mark"])  # about SAMPLE documents, each of FEATURES numbers at most
    features = [(np.frombuffer(r["one"]["at"], np.uint16), np.frombuffer(r["one"]["value"], np.float32)) for r in got]
    weights, bias = train(features, np.array([label[r["one"]["pattern"]] for r in got])) if got else (np.zeros(FEATURES), 0.0)
    return weights, bias, label, accuracies(shares, p)


def classify(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, posterior, score, kept)``: the weak label, the scorer's probability of good, and whether that is KEEP or more.

    Null and empty texts have no words and score as the bias alone. Texts of any length are read whole. Repeated rows stay and get equal
    scores; an empty table gives an empty result. Other columns, whatever their names, are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    weights, bias, label, _ = fit(rows)
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias, label))  # of fixed size

    def score(batch: list[bytes]) -> list[pa.Array]:
        weights, bias, label = shared.value
        out, weak = [], []
        for t in batch:
            profile = Profile(t)
            grams = profile.grams()
            z = weights[grams].sum() / max(len(grams), 1) + weights[BUCKETS:] @ profile.repetition() + bias
            out.append(1 / (1 + math.exp(-min(max(z, -30.0), 30.0))))
            weak.append(label[profile.pattern()])
        return [pa.array(weak, pa.float64()), pa.array(out, pa.float64()), pa.array([s >= KEEP for s in out], pa.bool_())]

    return with_columns(rows, "text", "posterior double, score double, kept boolean", score, ["doc_id"])
