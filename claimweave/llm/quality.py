"""A quality classifier from overlapping heuristic labellers, without given labels.

Each labeller looks at one property of a text and votes good, bad or abstains. Expectation-
maximisation over the counts of vote patterns (at most 3 to the power of the labellers) estimates
how often each labeller gives each vote to good and to bad texts, and so the probability that a
text with a given pattern is good. These posterior labels train a logistic scorer on hashed
features: the shapes of a text's words, each weighted by the square root of its share, and
the text's own shape. The scorer, not the votes, decides.

The EM counts every document. The scorer learns from about `fit_rows` documents, chosen by a hash.
A null text counts as empty; texts without words get score 0. Repeated rows get the same score;
an empty table gives none. Other columns are kept by `keep_good` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.text import Rolling, Texts, Words, pieces, tidy

FEATURES = 1 << 12
FIT_ROWS = 20_000

#: Letters, upper-case letters, digits and the marks that prose uses; what is left is symbols.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:127] = True
_SYMBOL[[*range(48, 58), *range(65, 91), *range(97, 123), *map(ord, ".,;:'\"-()?")]] = False

#: Shape classes of bytes: lower, upper, digit, beyond ASCII (as lower); each other byte is its own.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = ord("a")
_SHAPE[128:256] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")

_hash, _shapes = Rolling(61), Rolling(62)


@dataclass
class Properties:
    """What the labellers look at, one number for each text."""

    n: np.ndarray  # words
    symbols: np.ndarray  # share of symbols among the non-space bytes
    upper: np.ndarray  # share of capitals among the ASCII letters
    bare: np.ndarray  # share of words without a letter or digit
    repeats: np.ndarray  # share of words equal to the word before
    distinct: np.ndarray  # distinct words for each word, on a scale that suits the length
    length: np.ndarray  # mean bytes of a word
    shouts: np.ndarray  # share of words that end in a symbol


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[first])


def properties(t: Texts) -> tuple[Properties, Words, np.ndarray]:
    w = Words(t)
    n = np.diff(w.first)
    some = np.maximum(n, 1)
    word = _hash.of(_hash.sums(t.data), w.starts, w.ends)
    doc = np.repeat(np.arange(len(t)), n)
    size = _sums(w.ends - w.starts, w.first)
    ascii_ = (t.data > 64) & (t.data < 123) & _LETTER[t.data]
    inside = np.concatenate([[0], np.cumsum(_LETTER[t.data] | (t.data >= 48) & (t.data < 58), dtype=np.int64)])
    bare = inside[w.ends] == inside[w.starts]
    again = np.zeros(len(w), bool)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((word, doc))
    new = np.ones(len(w), bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    kinds = np.bincount(doc[order][new], minlength=len(t))
    shout = _SYMBOL[t.data[w.ends - 1]] if len(w) else np.zeros(0, bool)
    found = Properties(
        n,
        _sums(_SYMBOL[t.data], t.offsets) / np.maximum(size, 1),
        _sums(_UPPER[t.data], t.offsets) / np.maximum(_sums(ascii_, t.offsets), 1),
        _sums(bare, w.first) / some,
        _sums(again, w.first) / some,
        kinds / np.maximum(some**0.75, 1),
        size / some,
        _sums(shout, w.first) / some,
    )
    return found, w, word


def votes(p: Properties) -> np.ndarray:
    """One column for each labeller: 1 good, -1 bad, 0 no opinion."""

    def between(x: np.ndarray, good: float, bad: float) -> np.ndarray:
        return np.where(x >= bad, -1, np.where(x <= good, 1, 0))

    columns = [
        between(p.symbols, 0.02, 0.08),
        between(p.upper, 0.15, 0.5),
        between(p.bare, 0.02, 0.15),
        between(p.repeats, 0.02, 0.1),
        between(-p.distinct, -0.9, -0.5),
        between(p.length, 6.3, 7.3),
        between(p.shouts, 0.03, 0.3),
    ]
    out = np.stack(columns, 1)
    out[p.n == 0] = -1
    few = p.n < 8  # too short for shares of words to mean much
    out[few & (p.n > 0)] *= (out[few & (p.n > 0)] < 0) & (np.arange(len(columns)) < 4)
    return out


LABELLERS = 7
KNOWS, ERRS = 0.5, 0.02


def _pattern(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * 3 ** np.arange(LABELLERS)).sum(1)


def _unpattern(code: np.ndarray) -> np.ndarray:
    return (code[:, None] // 3 ** np.arange(LABELLERS)) % 3 - 1


@dataclass
class LabelModel:
    """The share of good texts and, for each labeller that votes, the chances of its vote on bad and good texts.

    Having no opinion is no evidence: a text on which all abstain has the share as its posterior.
    """

    good: float
    chances: np.ndarray  # class, labeller, vote + 1; 1 for no opinion

    def posterior(self, v: np.ndarray) -> np.ndarray:
        logs = np.log(self.chances)[:, np.arange(LABELLERS), v + 1].sum(2) + np.log([[1 - self.good], [self.good]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def expectation_maximisation(v: np.ndarray, count: np.ndarray, rounds: int = 200) -> LabelModel:
    """Accuracies of the labellers from vote patterns and their counts.

    There are many kinds of bad text, and each labeller knows some: that it finds nothing bad says
    little, that it does says much. So its chance of calling a bad text bad is held at KNOWS at most,
    and that of calling a good one bad at ERRS at most. Without these bounds the commonest kind of
    bad text, which several labellers see, would become the whole class. EM begins from "bad if any
    labeller says bad", so that the classes mean the same whatever their shares.
    """
    p = np.where((v < 0).any(1), 0.05, 0.98)
    model = None
    for _ in range(rounds):
        chances = np.empty((2, LABELLERS, 3))
        for c, weight in enumerate((count * (1 - p), count * p)):
            bad, good = (((v == vote) * weight[:, None]).sum(0) + 0.5 for vote in (-1, 1))
            says_bad = np.clip(bad / (bad + good), *(((0.05, KNOWS), (1e-4, ERRS))[c]))
            chances[c] = np.stack([says_bad, np.ones(LABELLERS), 1 - says_bad], 1)
        share = float(((count * p).sum() + 1) / (count.sum() + 2))
        model = LabelModel(share, chances)
        new = model.posterior(v)
        done = np.abs(new - p).max() < 1e-6
        p = new
        if done:
            break
    return model


def features(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, Properties]:
    """Hashed features of texts as (text, feature, value), and the texts' properties."""
    p, w, _ = properties(t)
    shape = _SHAPE[t.data]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[w.starts] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    kinds = _shapes.of(_shapes.sums(shape[keep]), place[w.starts], place[w.ends]) % np.uint64(FEATURES - 64)
    doc = np.repeat(np.arange(len(t)), p.n)
    pairs, count = np.unique(doc * FEATURES + kinds.astype(np.int64), return_counts=True)
    row, column = np.divmod(pairs, FEATURES)
    value = np.sqrt(count / np.maximum(p.n, 1)[row])
    own = np.stack(
        [
            np.ones(len(t)),
            np.minimum(p.symbols * 5, 1),
            p.upper,
            np.minimum(p.bare * 4, 1),
            np.minimum(p.repeats * 4, 1),
            np.maximum(0, 1 - p.distinct),
            np.clip((p.length - 6) / 2, 0, 1),
            p.shouts,
            (p.n == 0).astype(float),
        ],
        1,
    )
    r, c = np.nonzero(own)
    return (
        np.concatenate([row, r]),
        np.concatenate([column, FEATURES - 64 + c]),
        np.concatenate([value, own[r, c]]),
        p,
    )


@dataclass
class Model:
    labels: LabelModel
    weights: np.ndarray


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The label model from all documents, the scorer from about `fit_rows` of them."""
    texts = docs.select("text")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(3**LABELLERS, np.int64)
        for batch in batches:
            for _, t in pieces(batch):
                sums += np.bincount(_pattern(votes(properties(t)[0])), minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(at), pa.array(sums[at])], ["pattern", "n"])

    counted = texts.mapInArrow(tidy(vote), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    counted = counted.orderBy("pattern").toPandas()
    n = int(counted["n"].sum())
    if not n:
        return Model(LabelModel(0.5, np.ones((2, LABELLERS, 3))), np.zeros(FEATURES))
    labels = expectation_maximisation(_unpattern(counted["pattern"].to_numpy()), counted["n"].to_numpy(float))

    def example(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                row, column, value, p = features(t)
                order = np.argsort(row, kind="stable")
                offsets = np.searchsorted(row[order], np.arange(len(t) + 1)).astype(np.int32)
                yield pa.record_batch(
                    [
                        part.column("place"),
                        pa.array(labels.posterior(votes(p))),
                        pa.ListArray.from_arrays(offsets, pa.array(column[order].astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(value[order].astype(np.float32))),
                    ],
                    ["place", "good", "columns", "numbers"],
                )

    # a share of the hash's range that holds about fit_rows of the n documents
    place = F.xxhash64(F.lit(6), *[c for c in ("doc_id",) if c in docs.columns], "text")
    most = min(int(fit_rows / n * 2**64) - 2**63, 2**63 - 1)
    sample = docs.select(place.alias("place"), "text").filter(F.col("place") <= most)
    rows = sample.mapInArrow(
        tidy(example), "place long, good double, columns array<int>, numbers array<float>"
    ).toArrow().sort_by("place")
    return Model(labels, _train(rows))


def _train(rows: pa.Table, rounds: int = 300, rate: float = 2.0) -> np.ndarray:
    """Logistic regression on soft labels by gradient descent with momentum; both classes weigh the same."""
    good = rows.column("good").to_numpy()
    lists = rows.column("columns").combine_chunks()
    row = np.repeat(np.arange(len(good)), lists.value_lengths().to_numpy(zero_copy_only=False))
    column = lists.flatten().to_numpy()
    value = rows.column("numbers").combine_chunks().flatten().to_numpy().astype(float)
    weight = good / max(good.sum(), 1e-9) + (1 - good) / max((1 - good).sum(), 1e-9)
    weight /= weight.sum()
    w, pace = np.zeros(FEATURES), np.zeros(FEATURES)
    for _ in range(rounds):
        score = np.bincount(row, value * w[column], len(good))
        error = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - good)
        slope = np.bincount(column, value * error[row], FEATURES) + 1e-5 * w
        pace = 0.9 * pace - rate * slope
        w = w + pace
    return w


def _score(model: Model, t: Texts) -> np.ndarray:
    row, column, value, p = features(t)
    sums = np.bincount(row, value * model.weights[column], len(t))
    return np.where(p.n > 0, 1 / (1 + np.exp(-np.clip(sums, -30, 30))), 0.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (the chance that the text is good), label_score (the labellers' posterior), n_words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                p, _, _ = properties(t)
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array(_score(model, t)),
                        pa.array(model.labels.posterior(votes(p))),
                        pa.array(p.n),
                    ],
                    ["doc_id", "score", "label_score", "n_words"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        tidy(run), "doc_id long, score double, label_score double, n_words long"
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores at least the threshold."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                yield part.filter(pa.array(_score(model, t) >= threshold))

    return docs.mapInArrow(tidy(run), schema)
