"""Exact top-k search by inner product as a Voronoi kNN join.

Pivots are rows of the table, about the square root of their number. Queries and data are both grouped
by their nearest pivot. A cell's summary is its radius, for a cell of queries also the least bound
for their k-th best scores: each query's k-th best among `PROBES` rows bounds its k-th best from
below. With pivots p and c and radii u and v, no query of one cell scores more with a row of the other
than p*c + u*|c| + v*|p| + u*v; where that is under the cell's bound, the two cells never meet. In cells
that may meet, a row s goes to the queries' cell only if p*s + u*|s| reaches the bound.

Cells of queries are gathered into groups of about GROUP queries, neighbours together, and groups into bands.
Rows are dealt in blocks to slices. A slice and a band meet in one task, neither of more than about
MEET bytes: a row goes once to each band that has a cell it must meet, a query to each slice, and there a
group's queries are scored against the rows that must meet the group. Nothing is broadcast. The k best of the slices'
k best are exact. Summaries have a row for each pivot, `MOST_PIVOTS` at most; beyond that number of cells
they grow, and nothing else changes.

Components are floor(256 * x). Vectors that are null or hold null or non-finite components take no
part. A query meets candidates of its own length only. Of query rows with one vec_id the least vector
asks, once. Rows with the query's own vec_id are no candidates; other repeated rows are. Ties go to
the smaller vec_id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.text import release, tidy
from claimweave.llm.shared import partitions, stored

SCALE = 256
GROUP = 512  # queries that meet a row together, about
MEET = 1 << 25  # bytes of a slice of rows, and twice those of a band of queries, about
MOST_PIVOTS = 256
PROBES = 2048
BLOCK = 4096  # rows scored at once
COPIES = 1 << 20  # queries that may be sent besides one for each row, for more slices than memory asks for


def integers(embeddings: DataFrame) -> DataFrame:
    """vec_id, dim and the integer components of each usable vector."""
    v = F.col("embedding")
    usable = v.isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return embeddings.filter(usable).select(F.col("vec_id").cast("long"), F.size(v).alias("dim"), whole.alias("v"))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.int64).reshape(len(flat), dim)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query row."""
    spark = embeddings.sparkSession
    data = stored(integers(embeddings), "vectors")
    queries = data.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q")).select("vec_id", "q.*")
    dims = [r["dim"] for r in queries.select("dim").distinct().collect()]
    found = None
    for dim in sorted(dims):
        one = _search(data.filter(F.col("dim") == dim), queries.filter(F.col("dim") == dim), dim, k, partitions(spark))
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


class Cells:
    """The pivots, what the summaries say, and which cells have to meet."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.squares = (pivots.astype(float) ** 2).sum(1)
        self.length = np.sqrt(self.squares)

    def nearest(self, rows: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = (rows.astype(float) ** 2).sum(1)[:, None] - 2.0 * products + self.squares
        cell = far.argmin(1)
        return cell, np.sqrt(np.maximum(far[np.arange(len(rows)), cell], 0))

    def summarise(self, asks: list, has: list) -> None:
        """asks: (cell, radius, least bound, queries) of each cell of queries; has: (cell, radius, greatest component, rows)."""
        asks = sorted(asks, key=lambda x: x[0])
        self.used = np.array([x[0] for x in asks], np.int64)
        self.radius, self.least = np.array([x[1] for x in asks], float), np.array([x[2] for x in asks], float)
        reach = np.zeros(len(self.pivots))
        for cell, far, _, _ in has:
            reach[cell] = far
        between = _product(self.pivots, self.pivots[self.used]).astype(float)
        most = between + self.radius * self.length[:, None] + reach[:, None] * (self.length[self.used] + self.radius)
        self.meet = _reached(most, self.least)
        self.group = self._groups([x[3] for x in asks])
        self.type = _type(max(x[2] for x in has))
        self.rows, self.queries = sum(x[3] for x in has), sum(x[3] for x in asks)
        held = max(1, MEET // (self.type.itemsize * max(1, self.pivots.shape[1])))
        self.slice = max(BLOCK, held)
        self._bands([x[3] for x in asks], max(GROUP, held // 2))

    def _bands(self, n: list[int], most: int) -> None:
        """Groups into bands of about `most` queries: each group's first band, and over how many its queries are dealt."""
        sizes = np.bincount(self.group, n).astype(np.int64)
        self.band, self.dealt = np.zeros(len(sizes), np.int64), -(-sizes // most)
        band, size = 0, 0
        for group, queries in enumerate(sizes):
            if size and size + queries > most:
                band, size = band + 1, 0
            self.band[group] = band
            band, size = band + int(self.dealt[group]) - 1, size + int(queries)

    def slices(self, parallel: int) -> int:
        """As many slices as memory asks for, or as tasks as long as queries are not sent much more often than rows."""
        return max(-(-self.rows // self.slice), min(parallel, (self.rows + COPIES) // self.queries), 1)

    def _groups(self, n: list[int]) -> np.ndarray:
        """A group for each cell of queries: from cell to nearest cell, a new group when one has GROUP queries."""
        group, left, number, size = np.zeros(len(n), np.int64), np.ones(len(n), bool), 0, 0
        at = 0
        while left.any():
            own = self.pivots[self.used[at]].astype(float)
            far = ((self.pivots[self.used].astype(float) - own) ** 2).sum(1)
            at = int(np.where(left, far, np.inf).argmin())
            if size >= GROUP:
                number, size = number + 1, 0
            group[at], left[at], size = number, False, size + n[at]
        return group

    def wanted(self, rows: np.ndarray) -> np.ndarray:
        """Which rows have to meet which cells of queries."""
        products = _product(rows, self.pivots)
        cell, _ = self.nearest(rows, products)
        length = np.sqrt((rows.astype(float) ** 2).sum(1))
        most = products[:, self.used] + self.radius * length[:, None]
        return self.meet[cell] & _reached(most, self.least)

    def wanted_by_group(self, rows: np.ndarray) -> np.ndarray:
        """Which rows have to meet which groups of queries."""
        order = np.argsort(self.group, kind="stable")
        starts = np.searchsorted(self.group[order], np.arange(len(self.band)))
        return np.logical_or.reduceat(self.wanted(rows)[:, order], starts, 1)


def _type(most: int) -> np.dtype:
    """The narrowest type that holds integers up to `most` of either sign."""
    return np.dtype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def _reached(most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether bounds reach others, in spite of rounding."""
    return most + 1e-9 * np.abs(most) + 1e-6 >= least


def _search(data: DataFrame, queries: DataFrame, dim: int, k: int, parallel: int) -> DataFrame:
    cells, asking, ready = _cells(data, queries, dim, k)
    slices = cells.slices(parallel)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_slice = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                b = batch.slice(at, BLOCK)
                s, ids = _matrix(b.column("v"), dim), np.asarray(b.column("vec_id"))
                groups, at_slice, out = cells.wanted_by_group(s), at_slice + 1, []
                for band in range(int((cells.band + cells.dealt).max())):
                    of = (cells.band <= band) & (band < cells.band + cells.dealt)
                    take = groups[:, of].any(1)
                    if take.any():
                        out.append((band, at_slice % slices, ids[take].tobytes(), s[take].astype(cells.type).tobytes()))
                columns = list(zip(*out, strict=True)) or [()] * 4
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["band", "slice", "ids", "rows"]
                )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, ids, q = np.asarray(batch.column("cell")), np.asarray(batch.column("query_id")), None
            q = _matrix(batch.column("q"), dim) if batch.num_rows else np.zeros((0, dim), np.int64)
            band = cells.band[cell] + ids % cells.dealt[cell]
            out = []
            for b, c in sorted(set(zip(band.tolist(), cell.tolist(), strict=True))):
                mine = np.flatnonzero((cell == c) & (band == b))
                for at in range(0, len(mine), GROUP):
                    part = mine[at : at + GROUP]
                    out.append((b, c, ids[part].tobytes(), q[part].astype(cells.type).tobytes()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["band", "cell", "query_ids", "queries"]
            )

    # queries of one group lie together; a hot one is cut, as the id completes the range key
    ready = asking.repartitionByRange(ready, "cell", "query_id").mapInArrow(
        tidy(chunks), "band int, cell int, query_ids binary, queries binary"
    )
    ready = ready.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    sent = data.select("vec_id", "v").mapInArrow(tidy(blocks), "band int, slice int, ids binary, rows binary")

    def solve(rows: pa.Table, asked: pa.Table) -> pa.Table:
        chunks = [
            (cell.as_py(), np.frombuffer(q.as_buffer(), cells.type), Best(np.frombuffer(ids.as_buffer(), np.int64), k))
            for cell, ids, q in zip(asked["cell"], asked["query_ids"], asked["queries"], strict=True)
        ]
        for block_ids, block in zip(rows["ids"], rows["rows"], strict=True):
            ids = np.frombuffer(block_ids.as_buffer(), np.int64)
            s = np.frombuffer(block.as_buffer(), cells.type).reshape(len(ids), dim).astype(np.int64)
            groups = cells.wanted_by_group(s)
            for cell, q, best in chunks:
                take = groups[:, cell]
                if take.any():
                    q = q.reshape(len(best.query_ids), dim).astype(np.int64)
                    best.offer(ids[take], _product(q, s[take]))
        found = [(np.zeros(0, np.int64),) * 3, *(best.rows() for _, _, best in chunks)]
        release()
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["query_id", "vec_id", "score"])

    met = sent.groupBy("band", "slice").cogroup(ready.groupBy("band", "slice"))
    return met.applyInArrow(solve, "query_id long, vec_id long, score long")


class Best:
    """The k best candidates of each query of a chunk among the blocks of rows offered so far."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.query, self.ids, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.bound = np.full(len(query_ids), np.iinfo(np.int64).min)

    def offer(self, ids: np.ndarray, score: np.ndarray) -> None:
        own = self.query_ids[:, None] == ids[None, :]
        score[own] = np.iinfo(np.int64).min
        if len(ids) > self.k and not len(self.query):  # the first block has a k-th best score of its own
            self.bound = np.partition(score, -self.k, 1)[:, -self.k].copy()
        query, at = np.nonzero((score >= self.bound[:, None]) & ~own)
        if not len(query):
            return
        score = np.concatenate([self.score, score[query, at]])
        query, ids = np.concatenate([self.query, query]), np.concatenate([self.ids, ids[at]])
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep, last = rank < self.k, rank == self.k - 1
        self.query, self.ids, self.score = query[keep], ids[keep], score[keep]
        self.bound[query[last]] = score[last]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.query_ids[self.query], self.ids, self.score


def _cells(data: DataFrame, queries: DataFrame, dim: int, k: int) -> tuple[Cells, DataFrame, int]:
    """The cells with their summaries; the queries, with the group that is called their cell; the number of groups."""
    n_pivots = min(MOST_PIVOTS, max(1, int(data.count() ** 0.5)))
    # stored, as otherwise each task would send the driver as many rows
    probes = stored(data.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(PROBES), "probes").toPandas()
    rows = np.array(probes["v"].tolist(), np.int64).reshape(len(probes), dim)
    row_ids = probes["vec_id"].to_numpy()
    cells = Cells(rows[:n_pivots])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, ids = _matrix(b.column("v"), dim), np.asarray(b.column("vec_id"))
            cell, far = cells.nearest(q, _product(q, cells.pivots))
            other = row_ids[None, :] != ids[:, None]
            scores = np.where(other, _product(q, rows), np.iinfo(np.int64).min)
            least = -np.sort(-scores, 1)[:, min(k, scores.shape[1]) - 1].astype(float)
            least = np.where(other.sum(1) >= k, least, -np.inf)
            yield pa.record_batch(
                [pa.array(cell.astype(np.int32)), pa.array(far), pa.array(least), b.column("vec_id"), b.column("v")],
                ["cell", "far", "least", "query_id", "q"],
            )

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, rows, top = np.full(n_pivots, -1.0), np.zeros(n_pivots, np.int64), 0
        for b in batches:
            s = _matrix(b.column("v"), dim)
            cell, far = cells.nearest(s, _product(s, cells.pivots))
            np.maximum.at(most, cell, far)
            rows += np.bincount(cell, minlength=n_pivots)
            top = max(top, int(s.max(initial=0)), -int(s.min(initial=0)))
        have = np.flatnonzero(most >= 0)
        columns = [have.astype(np.int32), most[have], np.full(len(have), min(top, np.iinfo(np.int64).max)), rows[have]]
        yield pa.record_batch([pa.array(c) for c in columns], ["cell", "far", "top", "n"])

    schema = "cell int, far double, least double, query_id long, q array<long>"
    asking = stored(queries.select("vec_id", "v").mapInArrow(tidy(placed), schema), "queries")
    asks = asking.groupBy("cell").agg(F.max("far"), F.min("least"), F.count("*")).collect()
    has = data.select("v").mapInArrow(tidy(reach), "cell int, far double, top long, n long")
    has = has.groupBy("cell").agg(F.max("far"), F.max("top"), F.sum("n")).collect()
    cells.summarise([tuple(r) for r in asks], [tuple(r) for r in has])
    groups = F.create_map(*(F.lit(int(x)) for pair in zip(cells.used, cells.group, strict=True) for x in pair))
    return cells, asking.select(groups[F.col("cell")].cast("int").alias("cell"), "query_id", "q"), int(cells.group.max()) + 1
