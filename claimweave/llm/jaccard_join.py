"""Near-duplicate join on n-gram sets by prefix trees.

A text's set holds its distinct runs of `size` words (A-Z lower-cased); a text with fewer words has
its whole sequence as the one element, a text without words or a null text the empty set, which is
linked with nothing. Two sets are linked if 100 * |both| >= percent * |either|.

1. The elements get one global order, rare ones first: by the count of an element's cell in a table
   of CELLS counters over the whole corpus (its size is fixed), then by the element's hash.
2. Of every set of n elements the first n - ceil(percent% of n) + 1 go to the bucket of their hash.
   Linked sets meet there, in a group for each element that they share. Copies have one set id and
   count once.
3. Elements with the same members make one group. Groups are cut into salted blocks of about BLOCK
   sets, and each pair of blocks is work of its own, dealt over all tasks. In it every two sets are
   compared by their sketches: a sketch holds four bits or more for each element, the parity of the
   elements that fall on it; sets whose sketches differ in more bits than linked sets can differ in
   elements are not linked. A pair belongs to the largest group that it shares, so it
   goes on from there only.
4. Pairs that the sketches leave are compared exactly, within their pair of blocks. Its ordered sets
   form a prefix tree, kept as sorted sequences with the length that each shares with the one before:
   a shared beginning is compared with a set once, and a sequence is left as soon as what remains of
   it can't reach the overlap that a link needs.
5. All links are kept, with their overlap: `join` lists them. They make a document's number of links,
   copies included, and the components.

Repeated rows are copies of each other. An empty table gives no rows. Other columns are ignored. A
component is named by its smallest doc_id; rows without one don't name a component unless all its
rows are such. Sets are told apart by a 64-bit hash and their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.shared import partitions, stored
from claimweave.llm.text import LOWER, Rolling, Texts, Words, mixed, pieces, texts, tidy

SIZE = 5
PERCENT = 80
CELLS = 1 << 20
SLICE = 1 << 14  # cells that are added up together
BUCKET = 1 << 20  # about how many elements of beginnings a bucket gets
HOT = 1 << 17  # an element that may be in more sets than that goes to several buckets
BLOCK = 256  # sets of a group that meet each other in one piece of work
PAIRS = 1 << 21  # pairs of sketches held at once

_bytes, _words = Rolling(51), Rolling(52)


class Sets:
    """The sets of some texts: distinct elements' hashes, one text after another, and where each begins."""

    def __init__(self, t: Texts, size: int):
        w = Words(t)
        word = _bytes.of(_bytes.sums(LOWER[t.data]), w.starts, w.ends)
        n = np.diff(w.first)
        sums = _words.sums_of(word)
        count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        doc = np.repeat(np.arange(len(t)), count)
        starts = np.repeat(w.first[:-1] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        ends = np.minimum(starts + size, w.first[1:][doc])
        element = _words.of(sums, starts, ends)
        order = np.lexsort((element, doc))
        element, doc = element[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (element[1:] != element[:-1]) | (doc[1:] != doc[:-1])
        self.elements, self.doc = element[new], doc[new]
        self.first = np.searchsorted(self.doc, np.arange(len(t) + 1))
        self.n = np.diff(self.first)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.elements ^ np.uint64(0x5EED)))])
        self.ids = mixed(np.diff(total[self.first]) + self.n.astype(np.uint64)).view(np.int64)

    def sketches(self) -> list[bytes]:
        """For each set the parities of the elements that share their low bits."""
        bits = sketch_bits(self.n)
        begin = np.cumsum(bits) - bits
        low = (self.elements & (bits[self.doc] - 1).astype(np.uint64)).astype(np.int64)
        parity = np.bincount(begin[self.doc] + low, minlength=int(bits.sum())) & 1
        packed = np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()
        return [packed[x // 8 : (x + y) // 8] for x, y in zip(begin.tolist(), bits.tolist(), strict=True)]

    def ordered(self, counts: np.ndarray) -> np.ndarray:
        """The elements, each set's in the global order."""
        return self.elements[np.lexsort((self.elements, counts[_cell(self.elements)], self.doc))]


def _cell(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(44)).astype(np.int64)


def sketch_bits(n: np.ndarray) -> np.ndarray:
    """The power of two from 4 * n on, 64 at least: sets of similarity below about 0.79 show as such."""
    return np.maximum(64, 1 << np.ceil(np.log2(np.maximum(4 * n, 1))).astype(np.int64))


def most_apart(n: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """The most elements that only one of two linked sets can have; below 0 if their sizes rule out a link."""
    total = n + other
    need = -(-percent * total // (100 + percent))
    return np.where(need <= np.minimum(n, other), total - 2 * need, -1)


def _census(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """doc_id, text_id, set_id, n and sketch of every row; and the corpus counts of the cells."""
    names = ["doc_id", "text_id", "set_id", "n", "sketch", "slice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part, t in pieces(batch):
                s = Sets(t, size)
                counts += np.bincount(_cell(s.elements), minlength=CELLS)
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("text_id"),
                        pa.array(s.ids),
                        pa.array(s.n),
                        pa.array(s.sketches(), pa.binary()),
                        pa.array([None] * len(t), pa.int32()),
                    ],
                    names,
                )
        if counts.any():
            rows = CELLS // SLICE
            nothing = [pa.array([None] * rows, pa.int64())] * 4
            slices = [part.tobytes() for part in counts.reshape(rows, SLICE)]
            yield pa.record_batch([*nothing, pa.array(slices, pa.binary()), pa.array(range(rows), pa.int32())], names)

    table = stored(
        docs.mapInArrow(tidy(run), "doc_id long, text_id long, set_id long, n long, sketch binary, slice int"), "sets"
    )

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for blob in part.column("sketch"):
            total += np.frombuffer(blob.as_py(), np.int64)
        return pa.table({"slice": part.column("slice")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    slices = table.filter(F.col("slice").isNotNull()).select("slice", "sketch")
    slices = slices.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()
    counts = np.zeros(CELLS, np.int64)
    for row in slices:
        counts[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["counts"], np.int64)
    return table.filter(F.col("slice").isNull()).drop("slice"), counts


def bucket_count(counts: np.ndarray, percent: int, least: int) -> int:
    """Buckets grow in number with the elements, not in size."""
    return max(least, -(-int(counts.sum()) * (100 - percent) // (100 * BUCKET)))


def hot_cells(counts: np.ndarray, n_buckets: int) -> np.ndarray:
    """Over how many buckets the elements of each cell are spread: more than one for hot cells only."""
    hot = max(HOT, 4 * int(counts.mean()))
    return np.minimum(np.maximum(-(-counts // hot), 1), n_buckets)


def bucket_of(element: np.ndarray, sid: np.ndarray, spread: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of an element, for a hot one salted by the set."""
    bucket = ((element >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    salt = mixed(sid.view(np.uint64)) % spread[_cell(element)].astype(np.uint64)
    return ((bucket + salt) % np.uint64(n_buckets)).astype(np.int32)


def _groups(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """(element, set_id) for every beginning's element that two different sets or more share; of those in
    hot cells, which lie in several buckets, also for such that one set has."""
    n_buckets = bucket_count(counts, percent, partitions(docs.sparkSession))
    spread = hot_cells(counts, n_buckets)
    hot = np.packbits(spread > 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, t in pieces(batch):
                s = Sets(t, size)
                ordered = s.ordered(counts)
                begin = s.n - (s.n * percent + 99) // 100 + 1
                place = np.arange(len(ordered)) - s.first[s.doc]
                take = place < begin[s.doc]
                element, of = ordered[take], s.doc[take]
                sid = s.ids[of]
                bucket = bucket_of(element, sid, spread, n_buckets)
                order = np.lexsort((sid, element, bucket))
                element, sid, bucket = element[order], sid[order], bucket[order]
                new = np.ones(len(element), bool)
                new[1:] = (element[1:] != element[:-1]) | (sid[1:] != sid[:-1])
                element, sid, bucket = element[new], sid[new], bucket[new]
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                bounds = [*first.tolist(), len(bucket)]
                blobs = [element[a:b].tobytes() + sid[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.record_batch([pa.array(bucket[first]), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        element, sid = [], []
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                m = len(blob) // 16
                element.append(np.frombuffer(blob, np.uint64, m))
                sid.append(np.frombuffer(blob, np.int64, m, 8 * m))
        if not element:
            return
        element, sid = np.concatenate(element), np.concatenate(sid)
        order = np.lexsort((sid, element))
        element, sid = element[order], sid[order]
        new = np.ones(len(element), bool)
        new[1:] = (element[1:] != element[:-1]) | (sid[1:] != sid[:-1])
        element, sid = element[new], sid[new]
        salted = np.unpackbits(hot)[_cell(element)].astype(bool)
        many = salted.copy()
        many[1:] |= element[1:] == element[:-1]
        many[:-1] |= element[:-1] == element[1:]
        element, sid, salted = element[many], sid[many], salted[many]
        # elements with the very same members make one group; not yet if some members lie elsewhere
        first = np.flatnonzero(np.diff(element, prepend=~element[:1]) != 0) if len(element) else np.zeros(0, np.int64)
        if len(first):
            sums = np.add.reduceat(mixed(sid.view(np.uint64)), first)
            size = np.diff(np.append(first, len(element)))
            kind = np.stack([sums, size.astype(np.uint64), salted[first].astype(np.uint64)], 1)
            _, one = np.unique(kind, axis=0, return_index=True)
            keep = np.zeros(len(first), bool)
            keep[one] = True
            keep = np.repeat(keep, size) | salted
            element, sid = element[keep], sid[keep]
        for at in range(0, len(element), 1 << 16):
            run = slice(at, at + (1 << 16))
            yield pa.record_batch([pa.array(element[run].view(np.int64)), pa.array(sid[run])], ["element", "set_id"])

    sent = docs.select("text").mapInArrow(tidy(send), "bucket int, blob binary").repartitionById(n_buckets, F.col("bucket"))
    return stored(sent.select("blob").mapInArrow(tidy(meet), "element long, set_id long"), "groups")


def _tree_key(own: np.ndarray, counts: np.ndarray) -> bytes:
    """Orders sets as the paths of the prefix tree."""
    out = np.empty(len(own), [("count", ">u8"), ("element", ">u8")])
    out["count"], out["element"] = counts[_cell(own)], own
    return out.tobytes()


def tree_counts(leader: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """How many elements each member shares with the leader, 0 for those that aren't linked with it; members
    come in the order of the tree, their elements in the global order."""
    known = np.sort(leader)
    out = []
    before, overlap = np.zeros(0, np.uint64), np.zeros(1, np.int64)  # the last path of the tree and its overlaps
    for own in members:
        both = min(len(own), len(before))
        differ = np.flatnonzero(own[:both] != before[:both])
        shared = int(differ[0]) if len(differ) else both
        # |both| >= percent * (|a| + |b|) / (100 + percent)
        need = -(-percent * (len(own) + len(leader)) // (100 + percent))
        if overlap[shared] + min(len(own) - shared, len(leader) - overlap[shared]) < need:
            # the subtree is left; the path up to here stays for the next member
            before, overlap = before[:shared], overlap[: shared + 1]
            out.append(0)
            continue
        rest = own[shared:]
        place = np.minimum(np.searchsorted(known, rest), len(known) - 1)
        hits = np.cumsum(known[place] == rest)
        overlap = np.concatenate([overlap[: shared + 1], overlap[shared] + hits])
        before = own
        out.append(int(overlap[-1]) if overlap[-1] >= need else 0)
    return out


def tree_overlaps(leader: np.ndarray, members: list[np.ndarray], counts: np.ndarray, percent: int) -> list[bool]:
    """Whether each member's set is linked with the leader's; all are in the global order."""
    order = sorted(range(len(members)), key=lambda i: _tree_key(members[i], counts))
    linked = [False] * len(members)
    for i, both in zip(order, tree_counts(leader, [members[i] for i in order], percent), strict=True):
        linked[i] = both > 0
    return linked


def _whole(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The rows of sorted batches, those of one key never apart."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        first = _firsts(table, key)
        if len(first) > 1:
            yield table.slice(0, first[-1])
        held = table.slice(first[-1])
    if held is not None:
        yield held


def _firsts(table: pa.Table, key: list[str]) -> np.ndarray:
    """Where each key's rows begin."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for c in key:
        x = table.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


PLACE = ["element", "i", "j"]  # a group and two of its blocks


def _candidates(groups: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The sets of each pair of blocks that may have links there (element, i, j, set_id), each with the ids of its
    `partners`: every pair of sets that shares a group and that sketches don't rule out, once."""
    same = [F.bit_xor(F.xxhash64("set_id")).alias("x"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("y")]
    sizes = groups.groupBy("element").agg(F.count("*").alias("m"), *same).filter("m > 1")
    # elements with the very same members make one group
    kept = sizes.groupBy("m", "x", "y").agg(F.min("element").alias("element"))
    kept = kept.select("element", (-F.col("m")).alias("order"), F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    # large groups come first; one whose members all begin with the same other group has no pair of its own
    own = F.sort_array(F.collect_list(F.struct("order", "element", "blocks"))).alias("own")
    lists = stored(groups.join(kept, "element").groupBy("set_id").agg(own), "lists")
    light = lists.select("set_id", F.col("own")[0]["element"].alias("head"), F.explode("own").alias("group"))
    heads = light.groupBy("group.element").agg(F.min("head").alias("low"), F.max("head").alias("high"))
    heads = heads.filter("low != high OR low = element").select("element")
    light = light.select("set_id", "group.*").join(heads, "element")
    lists = light.groupBy("set_id").agg(own)
    rows = nodes.select("set_id", "n", "sketch").join(lists, "set_id").select("*", F.posexplode("own").alias("at", "group"))
    block = F.pmod(F.xxhash64("set_id", "group.element"), F.col("group.blocks")).cast("int")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group.blocks") - 1)))
    rows = rows.select(
        "group.element",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "set_id",
        "n",
        "block",
        "sketch",
        F.slice("own.element", F.lit(1), F.col("at")).alias("before"),
    )

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, n, block = (table.column(c).to_numpy() for c in ("set_id", "n", "block"))
        inside = table.column("i").to_numpy() == table.column("j").to_numpy()
        sketch = texts(table.column("sketch"))
        flat, begin = np.frombuffer(sketch.data.tobytes(), np.uint64), sketch.offsets[:-1] // 8
        words = np.diff(sketch.offsets) // 8
        before = table.column("before")
        earlier: dict[int, frozenset] = {}

        def met(x: int) -> frozenset:
            if x not in earlier:
                earlier[x] = frozenset(before[x].as_py())
            return earlier[x]

        first = _firsts(table, PLACE)
        size = np.diff(np.append(first, len(ids)))
        left = np.repeat(first + size, size) - np.arange(len(ids)) - 1  # members after each one in its pair of blocks
        found: list[np.ndarray] = []
        held: list[np.ndarray] = []
        ahead, waiting = 1, 0
        rows = np.flatnonzero(left >= 1)
        while len(rows):
            held.append(np.stack([rows, rows + ahead], 1))
            waiting += len(rows)
            ahead += 1
            rows = rows[left[rows] >= ahead]
            if waiting >= PAIRS or not len(rows):
                a, b = np.concatenate(held).T
                held, waiting = [], 0
                most = most_apart(n[a], n[b], percent)
                keep = (most >= 0) & (inside[a] | (block[a] != block[b]))
                a, b, most = a[keep], b[keep], most[keep]
                keep = _apart(flat, begin, words, a, b) <= most
                a, b = a[keep], b[keep]
                new = [met(x).isdisjoint(met(y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                found.append(np.stack([a, b], 1)[np.array(new, bool)])
        if not found:
            return
        pair = np.concatenate(found)
        pair = pair[np.lexsort((pair[:, 1], pair[:, 0]))]
        part = np.unique(pair)
        low, high = np.searchsorted(pair[:, 0], part), np.searchsorted(pair[:, 0], part, "right")
        partner = ids[pair[:, 1]]
        blobs = [partner[x:y].tobytes() for x, y in zip(low.tolist(), high.tolist(), strict=True)]
        out = table.select([*PLACE, "set_id"]).take(pa.array(part)).append_column("partners", pa.array(blobs, pa.binary()))
        yield from out.combine_chunks().to_batches()

    def all_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, PLACE):
            yield from run(table)

    placed = rows.repartition(partitions(groups.sparkSession), *PLACE).sortWithinPartitions(*PLACE, "set_id")
    found = placed.mapInArrow(tidy(all_), "element long, i int, j int, set_id long, partners binary")
    return stored(found, "candidates")


def _verified(candidates: DataFrame, elements: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """What each pair of blocks has of each set with links there: `root`, a set that these lead to, the same for all
    that they lead to; `near`, how many rows are linked; `partners` and `overlaps`, each link at one of its ends."""

    def run(table: pa.Table) -> Iterator[tuple[int, int, int, bytes, bytes]]:
        blobs = table.column("elements").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in blobs]
        order = sorted(range(len(sets)), key=lambda i: _tree_key(sets[i], counts))
        ids, copies = table.column("set_id").to_pylist(), table.column("copies").to_pylist()
        place = {ids[i]: rank for rank, i in enumerate(order)}
        root = list(range(len(ids)))
        near = [0] * len(ids)

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        links = []
        for x, blob in enumerate(table.column("partners").to_pylist()):
            ranks = sorted(place[y] for y in np.frombuffer(blob, np.int64).tolist())
            both = tree_counts(sets[x], [sets[order[r]] for r in ranks], percent)
            yes = [(order[r], c) for r, c in zip(ranks, both, strict=True) if c]
            for y, _ in yes:
                near[x] += copies[y]
                near[y] += copies[x]
                root[top(y)] = top(x)
            links.append(yes)
        for x, yes in enumerate(links):
            if near[x]:
                partners = np.array([ids[y] for y, _ in yes], np.int64).tobytes()
                yield ids[x], ids[top(x)], near[x], partners, np.array([c for _, c in yes], np.int32).tobytes()

    def all_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, PLACE):
            first = [*_firsts(table, PLACE).tolist(), len(table)]
            out = [r for a, b in zip(first[:-1], first[1:], strict=True) for r in run(table.slice(a, b - a))]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                arrays = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.record_batch(arrays, ["set_id", "root", "near", "partners", "overlaps"])

    rows = candidates.join(elements, "set_id").select(*PLACE, "set_id", "partners", "copies", "elements")
    placed = rows.repartition(partitions(rows.sparkSession), *PLACE).sortWithinPartitions(*PLACE, "set_id")
    found = placed.mapInArrow(tidy(all_), "set_id long, root long, near long, partners binary, overlaps binary")
    return stored(found, "found")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the ends of links (a, b): the smallest node that links lead to.

    Each round takes the least label among the neighbours and then that label's own label.
    """
    links = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(links.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = links.join(labels, links["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        closer = labels.join(near, labels["node"] == near["a"]).select(
            "node", "label", F.least("label", "near").alias("next")
        )
        ahead = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        moved = closer.join(ahead, "next").select("node", F.least("next", "beyond").alias("label"), F.col("label").alias("old"))
        moved = stored(moved, "labels")
        labels = moved.select("node", "label")
        if moved.filter(F.col("label") != F.col("old")).isEmpty():
            return labels


def link(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links, the number of other rows that it is linked with, of every document."""
    named = _named(docs, size, percent)
    least = named.filter(F.col("n") > 0).groupBy("label").agg(F.min("doc_id").alias("least"))
    return named.join(least, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        "n_links",
    )


def join(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links (a, b, overlap) between different sets, a < b; and the members of the sets: doc_id, set_id and
    n_shingles of every document. Documents of one set are copies, linked unless the set is empty."""
    census, links = _linked(docs, size, percent)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, ids, both in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                ids = np.frombuffer(ids, np.int64)
                arrays = (np.minimum(own, ids), np.maximum(own, ids), np.frombuffer(both, np.int32).astype(np.int64))
                yield pa.record_batch([pa.array(x) for x in arrays], ["a", "b", "overlap"])

    listed = links.select("set_id", "partners", "overlaps").mapInArrow(tidy(pairs), "a long, b long, overlap long")
    return listed, census.select("doc_id", "set_id", F.col("n").alias("n_shingles"))


def _apart(flat: np.ndarray, begin: np.ndarray, words: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many bits the sketches of members i and j differ, the larger one folded to the smaller."""
    out = np.empty(len(i), np.int64)
    swap = words[i] > words[j]
    small, large = np.where(swap, j, i), np.where(swap, i, j)
    kind = words[small] * 2 + (words[large] > words[small])
    for code in np.unique(kind):
        w, folded = divmod(int(code), 2)
        at = np.flatnonzero(kind == code)
        step = max(1, (1 << 20) // w)
        for x in range(0, len(at), step):
            some = at[x : x + step]
            place = np.arange(w)
            bits = flat[begin[small[some]][:, None] + place] ^ flat[begin[large[some]][:, None] + place]
            if folded:
                bits ^= flat[begin[large[some]][:, None] + place + w]
            out[some] = np.bitwise_count(bits).sum(1, dtype=np.int64)
    return out


MARKS = 1 << 22
MOST = 100_000


def _mark(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    key = mixed(a.view(np.uint64) + mixed(b.view(np.uint64)))
    return (key % np.uint64(MARKS)).astype(np.int64)


def _elements(docs: DataFrame, wanted: DataFrame, counts: np.ndarray, size: int) -> DataFrame:
    """The ordered sets (set_id, copies, elements) of `wanted`, one row for each, made from its document.

    The documents are filtered by a table of MARKS bits, whose size is fixed; others that pass, such
    as copies of a wanted set, go when the wanted documents are joined.
    """

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = np.unique(_mark(np.asarray(batch.column("doc_id")), np.asarray(batch.column("text_id"))))
            word, bit = np.divmod(mark, 64)
            value = np.left_shift(np.uint64(1), bit.astype(np.uint64)).view(np.int64)
            yield pa.record_batch([pa.array(word), pa.array(value)], ["word", "bits"])

    ids = wanted.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text_id")
    rows = ids.mapInArrow(tidy(marks), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(MARKS // 64, np.int64)
    table[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    bits = np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)
    packed = np.packbits(bits)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(packed).astype(bool)
        last: set[tuple[int, int]] = set()  # of MOST rows at most, so that repeated rows mostly go here
        for batch in batches:
            doc, text = np.asarray(batch.column("mark_id")), np.asarray(batch.column("text_id"))
            keep = known[_mark(doc, text)]
            for i in np.flatnonzero(keep).tolist():
                row = (int(doc[i]), int(text[i]))
                keep[i] = row not in last
                if len(last) >= MOST:
                    last.clear()
                last.add(row)
            for part, t in pieces(batch.filter(pa.array(keep))):
                s = Sets(t, size)
                ordered = s.ordered(counts)
                blobs = [ordered[a:b].tobytes() for a, b in zip(s.first[:-1], s.first[1:], strict=True)]
                yield pa.record_batch(
                    [part.column("mark_id"), part.column("text_id"), pa.array(s.ids), pa.array(blobs, pa.binary())],
                    ["mark_id", "text_id", "set_id", "elements"],
                )

    marked = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("mark_id"), "text_id", "text")
    made = marked.mapInArrow(tidy(sets), "mark_id long, text_id long, set_id long, elements binary")
    asked = wanted.select("set_id", "copies", F.coalesce("doc_id", F.lit(-1)).alias("mark_id"), "text_id")
    return stored(made.join(asked, ["mark_id", "text_id", "set_id"]).dropDuplicates(["set_id"]).select("set_id", "copies", "elements"), "elements")


def _linked(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The census, and all links between its sets as _verified gives them; tables in the shared folder."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_id", F.xxhash64("text"))
    census, counts = _census(docs, size)
    groups = _groups(docs, counts, size, percent)
    # the sets that groups hold, with one document of each
    one = F.min(F.struct("doc_id", "text_id", "n", "sketch")).alias("one")
    nodes = census.join(groups.select("set_id").distinct(), "set_id").groupBy("set_id").agg(one, F.count("*").alias("copies"))
    nodes = stored(nodes.select("set_id", "copies", "one.*"), "nodes")
    candidates = _candidates(groups, nodes, percent)
    wanted = nodes.join(candidates.select("set_id").distinct(), "set_id").select("set_id", "copies", "doc_id", "text_id")
    elements = _elements(docs, stored(wanted, "wanted"), counts, size)
    return census, _verified(candidates, elements, counts, percent)


def _named(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, text_id, set_id, n, n_links and the component's label of every row; a table in the shared folder."""
    census, links = _linked(docs, size, percent)
    labels = components(links.filter("set_id != root").select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    near = links.groupBy("set_id").agg(F.sum("near").alias("near"))
    copies = census.groupBy("set_id").agg(F.count("*").alias("copies")).filter("copies > 1")
    facts = copies.join(near.join(labels.withColumnRenamed("node", "set_id"), "set_id"), "set_id", "full")
    n_links = F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("near", F.lit(0))
    named = census.join(facts, "set_id", "left").select(
        "doc_id",
        "text_id",
        "set_id",
        "n",
        F.when(F.col("n") > 0, n_links).otherwise(0).alias("n_links"),
        F.coalesce("label", "set_id").alias("label"),
    )
    return stored(named, "named")


def first_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, all columns, that come first in their component: one row for each.

    First is the smallest doc_id, rows without one last, then the text's hash. Rows without words
    are linked with nothing and all stay. Of rows with words that repeat doc_id and text one stays.
    """
    named = _named(docs, size, percent).filter(F.col("n") > 0)
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_id")
    first = named.groupBy("label").agg(F.min(row).alias("first"))
    other = ~F.col("doc_id").eqNullSafe(F.col("first.doc_id")) | (F.col("text_id") != F.col("first.text_id"))
    gone = named.join(first, "label").filter(other).select("doc_id", "text_id").distinct()
    own_text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    def same(keys: DataFrame) -> Column:
        return docs["doc_id"].cast("long").eqNullSafe(keys["doc_id"]) & (own_text == keys["text_id"])

    repeated = named.groupBy("doc_id", "text_id").count().filter("count > 1").drop("count")
    rows = docs.join(gone, same(gone), "left_anti")
    once = rows.join(repeated, same(repeated), "left_anti")
    return once.unionByName(rows.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))
