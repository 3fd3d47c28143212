"""Toxic passages as maximum-scoring segments of token log-odds.

Words are lower-cased runs of letters and digits. A word and its beginnings of 5, 6 and 7 bytes
(stems, for languages that inflect or compound) are hashed to `BUCKETS` table places. Each place has
the log-odds between toxic and clean labelled texts under a Dirichlet prior in proportion to the
frequency in both, moved two standard deviations towards 0. A word's score is the strongest of its
places, less a drift that makes the expected score of clean text negative. A linear scan (Ruzzo and Tompa) finds all maximal segments of a text. Their
scores S are calibrated by the extreme-value law of such segments: lambda solves
sum p(s) exp(lambda s) = 1 over clean words, K is fitted to the best segments of clean texts, and
lambda*S - ln(K*n) is the log-significance of S in a text of n words. A text's evidence is that of
its best segment and the sum over all significant ones; two logistic weights turn it into a score.

Labels come from a sample of at most `fit_rows` labelled documents, the first by a hash of the id;
a document with several labels counts as toxic if one says so, null labels are left out. Without
labels of both kinds every score is 0.1. A null text counts as empty and gets the score of a text
without evidence. Repeated rows give repeated results; other columns pass `score` by unused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.shared import stored
from claimweave.llm.text import LOWER, Rolling, Texts, Words, pieces, tidy

BUCKETS = 1 << 18
FIT_ROWS = 20_000
DRIFT = 0.05
PRIOR = 2_000.0  # pseudo-words of the prior for each class
SIGNIFICANT = 2.0  # log-significance from which a segment counts
STEP, STEPS = 0.02, 1000  # of the histogram of scores

#: Bytes that belong to words: ASCII letters and digits, and all beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_hash = Rolling(7)


STEMS = (5, 6, 7)


@dataclass
class Model:
    """Log-odds by bucket, lambda, ln K, and the logistic weights (base, best segment, sum)."""

    odds: np.ndarray
    rate: float
    log_k: float
    weights: np.ndarray


def _words(t: Texts) -> tuple[Words, list[np.ndarray]]:
    """The words, and the places of the words and of their stems; a word too short for a stem has its own again."""
    w = Words(t, LETTER)
    sums = _hash.sums(LOWER[t.data])
    out = []
    for k in (1 << 40, *STEMS):
        ends = np.minimum(w.ends, w.starts + k)
        key = _hash.of(sums, w.starts, ends) ^ np.uint64(k * 0x9E37)
        out.append((key % np.uint64(BUCKETS)).astype(np.int64))
    return w, out


def _scores(odds: np.ndarray, t: Texts) -> tuple[Words, np.ndarray]:
    w, places = _words(t)
    best = odds[places[0]]
    for place in places[1:]:
        other = odds[place]
        best = np.where(np.abs(other) > np.abs(best), other, best)
    return w, best - DRIFT


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments of a sequence: (score, start, end), in order.

    Only the places with positive scores are visited.
    """
    stack: list[list] = []  # left sum, right sum, start, end, place of the nearest segment with a smaller left sum
    total = np.concatenate([[0.0], np.cumsum(scores)])
    for i in np.flatnonzero(scores > 0).tolist():
        left, right, start, end = float(total[i]), float(total[i + 1]), i, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                stack.append([left, right, start, end, j])
                break
            left, start = stack[j][0], stack[j][2]
            del stack[j:]
    return [(right - left, start, end) for left, right, start, end, _ in stack]


def _found(odds: np.ndarray, t: Texts) -> tuple[Words, list[list[tuple[float, int, int]]]]:
    """The maximal segments of each text, in its words."""
    w, scores = _scores(odds, t)
    positive = np.concatenate([[0], np.cumsum(scores > 0)])[w.first]
    bounds = w.first.tolist()
    return w, [
        segments(scores[bounds[i] : bounds[i + 1]]) if positive[i + 1] > positive[i] else [] for i in range(len(t))
    ]


def _worth(model: Model, scores: list[float], n: int) -> list[float]:
    """Log-significance of the segments of a text of n words."""
    return [model.rate * s - model.log_k - float(np.log(max(n, 1))) for s in scores]


def _evidence(model: Model, found: list[list[float]], n: np.ndarray) -> np.ndarray:
    """For each text the log-significance of its best segment and the sum over significant ones."""
    out = np.zeros((len(found), 2))
    for i, scores in enumerate(found):
        if scores:
            worth = _worth(model, scores, n[i])
            out[i] = max(0.0, max(worth)), sum(x for x in worth if x > SIGNIFICANT)
    return out


def _features(evidence: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(evidence)), evidence[:, 0], np.log1p(evidence[:, 1])])


def _probability(model: Model, t: Texts) -> np.ndarray:
    w, found = _found(model.odds, t)
    evidence = _evidence(model, [[s for s, _, _ in x] for x in found], np.diff(w.first))
    return 1 / (1 + np.exp(-np.clip(_features(evidence) @ model.weights, -30, 30)))


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be learned from; the others are held out."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learns from the labels given."""
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    chosen = F.broadcast(docs.sparkSession.createDataFrame(chosen.collect(), "doc_id long, toxic int"))
    sample = stored(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic"), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part, t in pieces(batch):
                w, places = _words(t)
                toxic = np.repeat(np.asarray(part.column("toxic")), np.diff(w.first)) != 0
                for place in places:
                    sums[0] += np.bincount(place[~toxic], minlength=BUCKETS)
                    sums[1] += np.bincount(place[toxic], minlength=BUCKETS)
        at = np.flatnonzero(sums.any(0))
        yield pa.record_batch([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], ["bucket", "clean", "toxic"])

    counted = sample.mapInArrow(tidy(count), "bucket long, clean long, toxic long")
    counted = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    clean, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    clean[counted["bucket"]], toxic[counted["bucket"]] = counted["clean"], counted["toxic"]
    if not clean.any() or not toxic.any():
        return Model(np.zeros(BUCKETS), 1.0, 0.0, np.array([np.log(0.1 / 0.9), 0.0, 0.0]))
    prior = PRIOR * (clean + toxic) / (clean + toxic).sum()
    seen = clean + toxic > 0
    t, c = (toxic + prior)[seen], (clean + prior)[seen]
    raw = np.log(t / (t.sum() - t)) - np.log(c / (c.sum() - c))
    odds = np.zeros(BUCKETS)
    odds[seen] = np.sign(raw) * np.maximum(np.abs(raw) - 2 * np.sqrt(1 / t + 1 / c), 0)

    # the scores of clean words, in steps of STEP
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 * STEPS + 1, np.int64)
        for batch in batches:
            for part, t in pieces(batch):
                w, scores = _scores(odds, t)
                clean = np.repeat(np.asarray(part.column("toxic")), np.diff(w.first)) == 0
                step = np.clip(np.rint(scores[clean] / STEP), -STEPS, STEPS).astype(int) + STEPS
                sums += np.bincount(step, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(at), pa.array(sums[at])], ["step", "n"])

    steps = sample.mapInArrow(tidy(spread), "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).toPandas()
    share = steps["n"].to_numpy(float)
    rate = _rate((steps["step"].to_numpy() - STEPS) * STEP, share / share.sum())

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                w, found = _found(odds, t)
                scores = pa.array([[s for s, _, _ in x] for x in found], pa.list_(pa.float64()))
                yield pa.record_batch(
                    [part.column("toxic"), pa.array(np.diff(w.first)), scores], ["toxic", "n", "scores"]
                )

    rows = sample.mapInArrow(tidy(best), "toxic int, n long, scores array<double>").toArrow().to_pydict()
    toxic, n, found = np.array(rows["toxic"]) != 0, np.array(rows["n"]), rows["scores"]
    model = Model(odds, rate, 0.0, np.zeros(3))
    # the median of the best segment's law is ln K - ln ln 2 above lambda * S - ln n
    top = [max(_worth(model, s, k)) for s, k, bad in zip(found, n, toxic, strict=True) if s and not bad]
    model.log_k = float(np.median(top) + np.log(np.log(2))) if top else 0.0
    model.weights = _logistic(_features(_evidence(model, found, n)), toxic.astype(float))
    return model


def _rate(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive lambda with sum share * exp(lambda * score) = 1."""
    if not (scores[share > 0] > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    value = lambda x: float((share * np.exp(np.minimum(x * scores, 700))).sum())
    while value(high) < 1:
        high *= 2
    if (share * scores).sum() >= 0:
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 1 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), x.T @ (y - p) - 1e-3 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the score of its text, in [0, 1]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                yield pa.record_batch([part.column("doc_id"), pa.array(_probability(model, t))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, score double")


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant passage: doc_id, its bytes' start and end, its text and log-significance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                w, found = _found(model.odds, t)
                ids, out = part.column("doc_id").to_pylist(), []
                for i, own in enumerate(found):
                    n = int(w.first[i + 1] - w.first[i])
                    for value, (_, a, b) in zip(_worth(model, [s for s, _, _ in own], n), own, strict=True):
                        if value > SIGNIFICANT:
                            x, y = int(w.starts[w.first[i] + a]), int(w.ends[w.first[i] + b - 1])
                            base = int(t.offsets[i])
                            out.append((ids[i], x - base, y - base, t.data[x:y].tobytes().decode(), value))
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64())
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "start", "end", "passage", "significance"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        tidy(run), "doc_id long, start long, end long, passage string, significance double"
    )


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores below the threshold."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                yield part.filter(pa.array(_probability(model, t) < threshold))

    return docs.mapInArrow(tidy(run), schema)
