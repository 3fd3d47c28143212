"""Language-model scoring by deleted interpolation.

The chance of a token w after v is a mixture of the maximum-likelihood estimates of the bigram
c(v,w)/c(v), of the word c(w)/N, and of the uniform 1/(V+1) over the known words and one unknown
word. The weights depend on how often v was seen (a bucket for each power of two) and are learned by
expectation-maximisation: each training document in turn is held out, so that its tokens are
judged by the counts of all others. The EM works on a histogram of those counts, which covers every
training token and whose size is bounded by its bins (counts up to 16 exactly, then in quarter
octaves).

Counts cover all training documents. Blocks of documents ask for the counts of their distinct words
and then of their distinct bigrams; no count passes through the driver, which gets the histogram, N
and V.

Tokens are maximal runs of bytes other than ASCII white space, A-Z lower-cased, then one end. A
document's first token has the end as its context. A null text counts as empty: one end. A null
doc_id is hashed as the empty text. Repeated rows count repeatedly. An empty table gives no rows.
Without training documents nothing is known, and the score is the uniform one. Words are told apart
by 48 bits within a bucket, bigrams by 40; buckets grow in number with the corpus, so that the
chance of a clash stays near one in a million million and one in a few million.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.blocks import Blocks, answered, buckets, packed, unpacked
from claimweave.llm.shared import shared_path
from claimweave.llm.text import LOWER, Rolling, Words, mixed, texts, tidy

END = np.uint64(0x1D0C0FFEE1234567)
EXACT, OCTAVE = 16, 4  # bins: counts below EXACT one by one, then OCTAVE to each doubling
RATIOS = 120
FOLDS = 10

_hash = Rolling(41)


def held_out(doc_id: object) -> bool:
    """Documents that nothing is learned from."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def _bin(count: np.ndarray) -> np.ndarray:
    log = EXACT + np.floor(OCTAVE * np.log2(np.maximum(count, 1) / EXACT))
    return np.where(count < EXACT, count, log).astype(np.int64)


def _unbin(b: np.ndarray) -> np.ndarray:
    return np.where(b < EXACT, b, EXACT * 2.0 ** ((b - EXACT + 0.5) / OCTAVE))


def _planes(x: np.ndarray) -> bytes:
    """Numbers with their bytes sorted by place: the high ones are mostly zeros and compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(blob: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(kind).ravel()


class _View:
    """A block's tokens: distinct words in order, each token's word, and which documents teach."""

    def __init__(self, table: pa.Table):
        t = texts(table.column("text"))
        w = Words(t)
        n = np.diff(w.first)
        word = _hash.of(_hash.sums(LOWER[t.data]), w.starts, w.ends)
        self.first = w.first + np.arange(len(w.first))  # every document has an end more
        tokens = np.full(len(word) + len(n), END)
        inside = np.ones(len(tokens), bool)
        inside[self.first[1:] - 1] = False
        tokens[inside] = word
        self.n = n + 1
        self.ids = table.column("row").combine_chunks().field("doc_id").to_pylist() if len(table) else []
        self.out = np.array([held_out(i) for i in self.ids], bool)
        self.doc = np.repeat(np.arange(len(n)), self.n)
        self.taught = ~self.out[self.doc]
        self.words, self.token = np.unique(tokens, return_inverse=True)
        self.seen = np.bincount(self.token, self.taught, len(self.words)).astype(np.uint64)
        end = int(np.searchsorted(self.words, END))
        self.context = np.empty_like(self.token)
        self.context[1:] = self.token[:-1]
        self.context[self.first[:-1]] = end

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigrams' keys in order, each token's, and how often the block teaches each."""
        key = mixed(self.words[self.context] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.token])
        keys, pair = np.unique(key, return_inverse=True)
        return keys, pair, np.bincount(pair, self.taught, len(keys)).astype(np.uint64)


def _ask(keys: np.ndarray, counts: np.ndarray, n: int, size: int, kind: int) -> Iterator[tuple[int, int, bytes]]:
    """`size` low bytes of each key, and its count, to the bucket that its high bits name."""
    owners, at = buckets(keys, n)
    low = keys.view(np.uint8).reshape(-1, 8)[:, :size]
    for i, owner in enumerate(owners.tolist()):
        run = slice(at[i], at[i + 1])
        yield owner, kind, packed(low[run].T) + _planes(counts[run])


def _count(size: int, kind: int):
    """A bucket's totals for each key asked for, and one bit for the first block that asks."""

    def answer(came: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        yield from (x for x in came if x[1] != kind)
        asked = [x for x in came if x[1] == kind]
        if not asked:
            return
        lengths = [len(blob) // (size + 8) for _, _, blob in asked]
        keys = np.zeros((sum(lengths), 8), np.uint8)
        counts = np.empty(sum(lengths), np.uint64)
        at = 0
        for (_, _, blob), m in zip(asked, lengths, strict=True):
            keys[at : at + m, :size] = np.frombuffer(blob, np.uint8, size * m).reshape(size, m).T
            counts[at : at + m] = _unplanes(blob[size * m :], "u8")
            at += m
        _, first, back = np.unique(keys.view(np.uint64).ravel(), return_index=True, return_inverse=True)
        total = np.bincount(back, counts).astype(np.uint64)[back]
        owns = np.zeros(len(back), bool)
        owns[first] = True
        at = 0
        for (block, _, _), m in zip(asked, lengths, strict=True):
            yield block, kind, _planes(total[at : at + m]) + np.packbits(owns[at : at + m]).tobytes()
            at += m

    return answer


def _totals(came: list[tuple[int, int, bytes]], kind: int, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    _, at = buckets(keys, n)
    totals, owns = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for i, blob in enumerate(blob for _, k, blob in came if k == kind):
        m = int(at[i + 1] - at[i])
        totals.append(_unplanes(blob[: 8 * m], "u8"))
        owns.append(np.unpackbits(np.frombuffer(blob, np.uint8, offset=8 * m), count=m).astype(bool))
    return np.concatenate(totals), np.concatenate(owns)


WORD_BYTES, PAIR_BYTES = 6, 5

#: One row for each block: what its documents need to be scored, and its share of N, V and the histogram.
COUNTED = (
    "doc_ids array<long>, held_out array<boolean>, n_tokens array<long>, n_known array<long>, "
    "log_sums array<double>, counts binary, train_tokens long, train_docs long, new_words long, cells binary"
)


def _counted(docs: DataFrame) -> DataFrame:
    """The counts that the scores need, see COUNTED."""
    blocks = Blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    n = blocks.n

    def ask(block: int, table: pa.Table):
        view = _View(table)
        return _ask(view.words, view.seen, n, WORD_BYTES, 1)

    def ask_pairs(block: int, table: pa.Table, came: list):
        view = _View(table)
        totals, owns = _totals(came, 1, view.words, n)
        yield block % n, 0, _planes(totals) + np.packbits(owns).tobytes()  # the block's own note
        keys, _, counts = view.pairs()
        yield from _ask(keys, counts, n, PAIR_BYTES, 2)

    def finish(table: pa.Table, came: list) -> pa.Table:
        view = _View(table)
        note = next(blob for _, kind, blob in came if kind == 0)
        m = len(view.words)
        totals = _unplanes(note[: 8 * m], "u8")
        owns = np.unpackbits(np.frombuffer(note, np.uint8, offset=8 * m), count=m).astype(bool)
        keys, pair, _ = view.pairs()
        both, _ = _totals(came, 2, keys, n)
        c_word, c_pair = totals[view.token].astype(np.float64), both[pair].astype(np.float64)
        first = view.first[:-1]
        log_sum = np.add.reduceat(np.log10(c_word + 0.1), first)
        known = np.add.reduceat(c_word > 0, first, dtype=np.int64)
        counts = _planes(totals[view.token]) + _planes(both[pair])
        one = {
            "doc_ids": view.ids,
            "held_out": view.out.tolist(),
            "n_tokens": view.n.tolist(),
            "n_known": known.tolist(),
            "log_sums": log_sum.tolist(),
            "counts": zstandard.compress(counts, 9),
            "train_tokens": int(view.n[~view.out].sum()),
            "train_docs": int((~view.out).sum()),
            "new_words": int((owns & (totals > 0)).sum()),
            "cells": _cells(view, totals, c_word, c_pair, pair),
        }
        return pa.Table.from_pylist([one])

    first = answered(blocks.ask(ask), _count(WORD_BYTES, 1))
    second = answered(blocks.ask_again(first, ask_pairs), _count(PAIR_BYTES, 2))
    return blocks.finish(second, finish, COUNTED)


def _cells(view: _View, totals: np.ndarray, c_word: np.ndarray, c_pair: np.ndarray, pair: np.ndarray) -> bytes:
    """The histogram of (context's bucket, word's count, bigram's share), each document's own counts left out."""

    def own(key: np.ndarray) -> np.ndarray:
        joint = view.doc * (int(key.max(initial=0)) + 1) + key
        _, back, count = np.unique(joint, return_inverse=True, return_counts=True)
        return count[back]

    t = view.taught
    before = totals[view.context].astype(np.float64)
    own_word = own(view.token)
    own_before = np.empty_like(own_word)
    own_before[1:] = own_word[:-1]
    own_before[view.first[:-1]] = 1  # a document begins once
    # a document's occurrences of v as a context are its occurrences, as the end closes each document
    word, both, ctx = (c_word - own_word)[t], (c_pair - own(pair))[t], (before - own_before)[t]
    ratio = np.where(both > 0, 1 + np.floor(-OCTAVE * np.log2(np.maximum(both, 1) / np.maximum(ctx, 1))), 0)
    ratio = np.minimum(ratio, RATIOS - 1).astype(np.int64)
    bucket = np.where(ctx > 0, 1 + np.floor(np.log2(np.maximum(ctx, 1))), 0).astype(np.int64)
    cell, count = np.unique((bucket * 1024 + _bin(word)) * RATIOS + ratio, return_counts=True)
    return packed(cell.astype(np.int64), count.astype(np.int64))


def learn_weights(cell: np.ndarray, count: np.ndarray, n: float, v: float, rounds: int = 100) -> np.ndarray:
    """Mixture weights (uniform, word, bigram) for each bucket of context frequencies."""
    rest, ratio = np.divmod(cell, RATIOS)
    bucket, word = np.divmod(rest, 1024)
    p = np.stack(
        [
            np.full(len(cell), 1 / (v + 1)),
            _unbin(word) / max(n, 1),
            np.where(ratio > 0, 2.0 ** (-(ratio - 0.5) / OCTAVE), 0.0),
        ],
        1,
    )
    p[ratio == 1, 2] = 1.0  # shares above a quarter octave below 1
    size = 64
    weights = np.tile([0.05, 0.65, 0.3], (size, 1))
    weights[0] = [0.1, 0.9, 0.0]  # a context never seen
    total = np.bincount(bucket, count, size)
    for _ in range(rounds):
        part = weights[bucket] * p
        part *= (count / part.sum(1))[:, None]
        new = np.stack([np.bincount(bucket, part[:, i], size) for i in range(3)], 1)
        # a bucket that few tokens fall into leans on the prior weights; unknown words keep some chance
        new = (new + 0.5 * weights) / (total + 0.5)[:, None]
        new = np.maximum(new, [1e-6, 1e-6, 0.0])
        weights = new / new.sum(1, keepdims=True)
    return weights


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score(docs: DataFrame) -> DataFrame:
    """Learns from `docs` and scores all of them, see SCORED."""
    spark = docs.sparkSession
    path = shared_path(spark, "counts")
    _counted(docs).write.parquet(path)
    table = spark.read.schema(COUNTED).parquet(path)
    sums = table.agg(*(F.sum(c).alias(c) for c in ("train_tokens", "train_docs", "new_words"))).first()
    n, starts, v = (int(sums[c] or 0) for c in ("train_tokens", "train_docs", "new_words"))

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [unpacked(b, "i8", "i8") for b in batch.column("cells").to_pylist() if b]
            if parts:
                cell, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                count = np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.record_batch([pa.array(cell), pa.array(count)], ["cell", "n"])

    cells = table.select("cells").mapInArrow(tidy(histogram), "cell long, n long")
    cells = cells.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()
    weights = learn_weights(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(float), n, v)
    normal = np.log10(n + 0.1 * (v + 1))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = np.array(row["n_tokens"], np.int64)
                first, m = np.cumsum(tokens) - tokens, int(tokens.sum())
                blob = zstandard.decompress(row["counts"])
                word = _unplanes(blob[: 8 * m], "u8").astype(np.float64)
                both = _unplanes(blob[8 * m :], "u8").astype(np.float64)
                before = np.empty(m)
                before[1:] = word[:-1]
                before[first] = starts  # an end closes each training document: so often was it a context
                bucket = np.where(before > 0, 1 + np.floor(np.log2(np.maximum(before, 1))), 0).astype(int)
                w = weights[bucket]
                p = w[:, 0] / (v + 1) + w[:, 1] * word / max(n, 1) + w[:, 2] * both / np.maximum(before, 1)
                yield pa.record_batch(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["held_out"], pa.bool_()),
                        pa.array(tokens),
                        pa.array(row["n_known"], pa.int64()),
                        pa.array(np.full(len(tokens), n)),
                        pa.array(np.array(row["log_sums"]) - tokens * normal),
                        pa.array(np.add.reduceat(np.log10(p), first)),
                    ],
                    [c.split()[0] for c in SCORED.split(", ")],
                )

    ready = table.select("doc_ids", "held_out", "n_tokens", "n_known", "log_sums", "counts")
    return ready.mapInArrow(tidy(apply), SCORED)
