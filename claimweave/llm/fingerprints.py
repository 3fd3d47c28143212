"""Document fingerprints by improved consistent weighted sampling.

A document's terms are its words, weighted by their counts. For sample j every term gets three
values that depend on the term and j alone: r and c from Gamma(2, 1), b uniform. With weight S,
t = floor(ln S / r + b) and ln a = ln c - r * (t - b) - r; the term with the least a is the sample,
and (term, t), which a determines, is what two documents must share. They share it with a
probability equal to the generalised Jaccard similarity of their weights.

A null text counts as empty. Texts without words have the fingerprint of zeros and are alike.
Repeated rows and equal ids are ordered by their text; a null doc_id comes last. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.shared import partitions
from claimweave.llm.text import PIECE, Rolling, Texts, Words, mixed, pieces, texts, tidy

SAMPLES = 128
ROWS = 1 << 13  # term rows handled at once

COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)

_hash = Rolling(9)
_salts = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64))
_BITS = np.uint64((1 << 21) - 1)


def _uniform(bits: np.ndarray, shift: int) -> np.ndarray:
    """21 bits of a hash as a number in (0, 1)."""
    u = ((bits >> np.uint64(shift)) & _BITS).astype(np.float32)
    u += np.float32(0.5)
    u *= np.float32(2.0**-21)
    return u


def _values(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """ln a for each row's term and weight, and each sample."""
    x = mixed(terms[:, None] ^ _salts)
    r = _uniform(x, 0)
    r *= _uniform(x, 21)
    np.negative(np.log(r, out=r), out=r)
    b = _uniform(x, 42)
    x *= np.uint64(0xD1342543DE82EF95)
    x ^= x >> np.uint64(32)
    c = _uniform(x, 0)
    c *= _uniform(x, 21)
    np.negative(np.log(c, out=c), out=c)
    np.log(c, out=c)
    t = np.log(weights).astype(np.float32)[:, None] / r
    t += b
    np.floor(t, out=t)
    t -= b
    t += np.float32(1)
    t *= r
    c -= t
    return c


def signatures(t: Texts) -> np.ndarray:
    """For each text SAMPLES 16-bit numbers."""
    w = Words(t)
    out = np.zeros((len(t), SAMPLES), np.uint16)
    if not len(w):
        return out
    terms = _hash.of(_hash.sums(t.data), w.starts, w.ends)
    names, term = np.unique(terms, return_inverse=True)
    doc = np.repeat(np.arange(len(t)), np.diff(w.first))
    pairs, weight = np.unique(doc * len(names) + term, return_counts=True)
    doc, term = np.divmod(pairs, len(names))
    # a term's values are made once for each weight that it has in any of the texts
    kinds, kind = np.unique(term * (weight.max() + 1) + weight, return_inverse=True)
    values = np.empty((len(kinds), SAMPLES), np.float32)
    for at in range(0, len(kinds), ROWS):
        term_of, weight_of = np.divmod(kinds[at : at + ROWS], weight.max() + 1)
        values[at : at + ROWS] = _values(names[term_of], weight_of.astype(np.float64))
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    owner = doc[first]
    bounds = np.append(first, len(doc))
    i = 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + 8 * ROWS, "right")) - 1)
        least = np.minimum.reduceat(values[kind[bounds[i] : bounds[j]]], bounds[i:j] - bounds[i], axis=0)
        out[owner[i:j]] = (mixed(least.view(np.uint32).astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
        i = j
    return out


def fingerprint(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of equal samples of two fingerprints."""
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint16) for s in (a, b))
    return float((x == y).mean())


def _joined(strings: list[str]) -> Texts:
    return texts(pa.array([s.encode() for s in strings], pa.large_binary()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in pieces(batch):
                made = pa.array([fingerprint(s) for s in signatures(t)], pa.string())
                yield pa.record_batch([part.column("doc_id"), made], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, fingerprint string")


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows by descending doc_id, cut into ranges; each range ends with a copy of the next one's first row.

    The driver sees the bounds of the ranges, one for each shuffle partition.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    lowest = -(1 << 63)
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), place.alias("place"))
    cuts = rows.stat.approxQuantile("place", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    bounds = sorted({int(c) for c in cuts})
    above = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    part = F.size(F.filter(above, lambda b: b >= F.col("place")))
    heads = sorted((r["part"], r["head"]) for r in
                   docs.select(place.alias("place")).groupBy(part.alias("part")).agg(F.max("place").alias("head")).collect())
    sends = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    guests = F.broadcast(spark.createDataFrame(sends, "place long, guest_of int"))
    here = F.array(F.struct(part.alias("part"), F.lit(0).alias("guest")))
    there = F.array(F.struct(F.col("guest_of").alias("part"), F.lit(1).alias("guest")))
    placed = rows.join(guests, "place", "left").withColumn(
        "to", F.explode(F.when(F.col("guest_of").isNull(), here).otherwise(F.concat(here, there)))
    )
    placed = placed.select("doc_id", "text", "place", "to.part", "to.guest")
    return placed.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(
        "guest", F.desc("place"), "text"
    )


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness, see COMPARED.

    In the edited text the last third is replaced by the beginning of the next document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row so far: id, text, signature
        over = False
        for batch in batches:
            at = 0
            ids, guest = batch.column("doc_id").to_pylist(), batch.column("guest").to_pylist()
            every = texts(batch.column("text"))
            while at < len(ids) and not over:
                to = int(np.searchsorted(every.offsets, every.offsets[at] + PIECE // 2, "right")) - 1
                to = min(max(to, at + 1), len(ids))
                if 1 in guest[at:to]:
                    to = at + guest[at:to].index(1) + 1
                    over = True
                own = [every.of(i).decode() for i in range(at, to)]
                before = [*([waiting] if waiting else []), *zip(ids[at:to], own, strict=True)]
                edited = []
                for row, after in zip(before[:-1], before[1:], strict=True):
                    text, k = row[1], len(row[1]) // 3
                    edited.append(text[: len(text) - k] + after[1][:k])
                # one call for both, as they share most terms
                made = signatures(_joined([*own, *edited]))
                old = [waiting[2]] if waiting else []
                sign = np.stack([*old, *made[: len(own)]])
                changed = made[len(own) :]
                if edited:
                    rows, signs, after = before[:-1], sign[:-1], sign[1:]
                    yield pa.record_batch(
                        [
                            pa.array([r[0] for r in rows], pa.int64()),
                            pa.array([len(r[1]) for r in rows], pa.int64()),
                            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                            pa.array([fingerprint(s) for s in signs]),
                            pa.array([fingerprint(s) for s in changed]),
                            pa.array((signs == changed).mean(1)),
                            pa.array((signs == after).mean(1)),
                        ],
                        [c.split()[0] for c in COMPARED.split(", ")],
                    )
                waiting = (ids[to - 1], own[-1], sign[-1])
                at = to

    return _in_order(docs).select("doc_id", "text", "guest").mapInArrow(tidy(run), COMPARED)
