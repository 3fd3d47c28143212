"""Questions that blocks of documents put to the whole corpus, and the answers.

Documents are shuffled once into blocks of about BLOCK bytes, by a hash of their content. A block
boils its texts down to sorted distinct keys (64-bit hashes), with a payload for each, and sends
each range of keys to the bucket that owns it, packed into one binary value. A bucket sees all
blocks' keys of its range and sends one value for each back, in the same order. A key therefore
reaches a bucket at most once from each block, however many documents of the block have it.

Blocks and buckets grow in number with the text, not in size. A block orders its rows by their
content, so whoever computes it again, after the loss of an executor, gets the same keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.shared import partitions
from claimweave.llm.text import release, texts, tidy

BLOCK = 1 << 21

SENT = "bucket int, block int, kind int, blob binary"
ANSWER = "block int, bucket int, kind int, blob binary"


class Blocks:
    """The documents in blocks: `rows` has `row` (a struct of all columns but text), `text` and `block`."""

    def __init__(self, docs: DataFrame):
        others = [c for c in docs.columns if c != "text"]
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        kept = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
        size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
        self.n = max(partitions(docs.sparkSession), -(-int(size) // BLOCK))
        rows = docs.select(kept.alias("row"), text.alias("text"))
        self.row_type = rows.schema["row"].dataType.simpleString()
        block = F.pmod(F.xxhash64("text", F.to_json("row")), F.lit(self.n)).cast("int")
        rows = rows.withColumn("block", block).mapInArrow(tidy(_squeezed), f"row {self.row_type}, text binary, block int")
        self.rows = rows.repartition("block")

    def ask(self, make: Callable[[int, pa.Table], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
        """Rows of SENT; `make` gets a block and its documents, and yields (bucket, kind, blob)."""

        def run(table: pa.Table) -> pa.Table:
            block = table.column("block")[0].as_py()
            out = _sent(block, make(block, ordered(table)))
            release()
            return out

        return self.rows.groupBy("block").applyInArrow(run, SENT)

    def ask_again(self, answers: DataFrame, make: Callable) -> DataFrame:
        """The same with the answers so far: `make` also gets a list of (bucket, kind, blob)."""

        def run(table: pa.Table, got: pa.Table) -> pa.Table:
            if not len(table):
                return _sent(0, iter(()))
            block = table.column("block")[0].as_py()
            out = _sent(block, make(block, ordered(table), received(got)))
            release()
            return out

        return self.rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SENT)

    def finish(self, answers: DataFrame, make: Callable[[pa.Table, list], pa.Table], schema: str) -> DataFrame:
        """Result rows from each block and its answers."""
        empty = schema_of(schema)

        def run(table: pa.Table, got: pa.Table) -> pa.Table:
            if not len(table):
                return empty.empty_table()
            out = make(ordered(table), received(got)).cast(empty)
            release()
            return out

        return self.rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def schema_of(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def answered(sent: DataFrame, answer: Callable[[list[tuple[int, int, bytes]]], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
    """Rows of ANSWER; `answer` gets a bucket's (block, kind, blob) and yields (block, kind, blob)."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        came = zip(table.column("block").to_pylist(), table.column("kind").to_pylist(), table.column("blob").to_pylist(), strict=True)
        out = list(answer(sorted(came, key=lambda x: (x[0], x[1]))))
        release()
        return pa.table(
            {
                "block": pa.array([x[0] for x in out], pa.int32()),
                "bucket": pa.array([bucket] * len(out), pa.int32()),
                "kind": pa.array([x[1] for x in out], pa.int32()),
                "blob": pa.array([x[2] for x in out], pa.binary()),
            }
        )

    return sent.groupBy("bucket").applyInArrow(run, ANSWER)


def _sent(block: int, rows: Iterator[tuple[int, int, bytes]]) -> pa.Table:
    out = list(rows)
    return pa.table(
        {
            "bucket": pa.array([x[0] for x in out], pa.int32()),
            "block": pa.array([block] * len(out), pa.int32()),
            "kind": pa.array([x[1] for x in out], pa.int32()),
            "blob": pa.array([x[2] for x in out], pa.binary()),
        }
    )


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in less space for the shuffle."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        t = texts(batch.column("text"))
        small = pa.array([squeeze(t.of(i)) for i in range(len(t))], pa.binary())
        yield pa.record_batch([batch.column("row"), small, batch.column("block")], ["row", "text", "block"])


def ordered(table: pa.Table) -> pa.Table:
    """A block's rows, texts unpacked, in an order that their content gives."""
    unpack = zstandard.ZstdDecompressor().decompress
    raw = [unpack(x.as_py()) for x in table.column("text")]
    order = sorted(range(len(raw)), key=lambda i: (xxhash.xxh3_128_intdigest(raw[i]), i))
    table = table.set_column(table.column_names.index("text"), "text", pa.array(raw, pa.large_binary()))
    return table.take(pa.array(order, pa.int64()))


def received(table: pa.Table) -> list[tuple[int, int, bytes]]:
    came = zip(table.column("bucket").to_pylist(), table.column("kind").to_pylist(), table.column("blob").to_pylist(), strict=True)
    return sorted(came, key=lambda x: (x[0], x[1]))


def buckets(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the buckets that own some, and where each one's run begins (with the end)."""
    owner = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(owner.astype(np.int64), prepend=-1))
    return owner[first].astype(np.int64), np.append(first, len(keys))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, one after another; the types are agreed on."""
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpacked(blob: bytes, *types: str) -> list[np.ndarray]:
    kinds = [np.dtype(t) for t in types]
    n, at, out = len(blob) // sum(k.itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.frombuffer(blob, k, n, at))
        at += n * k.itemsize
    return out
