"""The prefix trie of conversations by a van Emde Boas recursion.

A sequence of up to 2**k steps is cut at half depth. The first half is named, by the name of the tree
it stands in and what it holds, and that name is the tree of the second half: equal beginnings have
equal names, wherever they occur. The first halves make the upper trie and the second halves a forest
below it, and both are cut again in the same way (`prefixes`). All halves of a level, of all
conversations, are one table, so k levels name every prefix, however long a single conversation is.

A node is a distinct prefix; counts of members and children are plain aggregates. Totals over subtrees
come back up the same cuts, smallest first (`totals`): when the trees of height 2**(k-1) know their own
totals, those of the forests are grafted to the node above the cut and to all above that one in its
tree of height 2**(k-1), the nodes of one conversation's run of 2**(k-1) steps. After k levels each
node has received every node below it exactly once, and no task has seen a whole subtree.

Names are 128-bit hashes (MD5). What is shuffled is names and numbers, the text only to bring the
turns into order. Each level holds half the runs of the one before. Aggregates are combined before the
shuffle, as the root and common beginnings are in all sequences, and joins are on (conversation, run).
The list of members that end in one node is hashed in order, in constant memory: runs of ids are joined
to texts of many ids where they are sorted, and these texts pass one task for each node in turn.

Turns are ordered by turn, null first, then role and text; null roles and texts become empty. Rows
without a conv_id belong to no conversation and take no part. Repeated rows are turns of their own.
Without conversations there is no node, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.sequences import numbered, place
from claimweave.llm.shared import partitions, stored
from claimweave.llm.text import tidy

HEAD = 5  # turns that a conversation takes from its group's first at most
GROUP = 100
IDS = 4096  # ids joined to one text


def _named(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _root() -> Column:
    return F.unhex(F.md5(F.lit("").cast("binary")))


def turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each turn's name and code points, numbered, and the spans of `sequences.numbered`."""
    filled = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    kept, spans = numbered(filled, "conv_id", [("turn", False), ("role", True), ("text", True)])
    role, text = F.col("role"), F.col("text")
    name = _named(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return kept.select("conv_id", "part", "at", name.alias("name"), F.char_length("text").cast("long").alias("chars")), spans


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, i, name and chars of each step of the rebuilt conversations, and a last step without a name.

    Conversation c is the first h turns of conversation c - c % 100 (all if fewer, none if absent),
    then its own turns after its first h; h = crc32 of c in decimal, modulo 6.
    """
    rows, spans = turns(conversations)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEAD + 1))
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    step = F.struct(place().alias("i"), "name", "chars")
    heads = rows.filter(F.col("conv_id") % GROUP == 0).join(spans, ["conv_id", "part"]).filter(place() < HEAD)
    heads = heads.groupBy(F.col("conv_id").alias("first")).agg(F.sort_array(F.collect_list(step)).alias("head"))
    own = spans.groupBy("conv_id").agg(F.max("total").alias("total"))
    own = own.withColumns({"h": h, "first": first}).join(heads, "first", "left")
    taken = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("h").cast("int"))
    own = stored(own.select("conv_id", "total", "h", taken.alias("head")), "rebuilt")
    shift = own.select("conv_id", "h", (F.size("head") - F.col("h")).alias("shift"))
    rest = rows.join(spans.join(shift, "conv_id"), ["conv_id", "part"]).filter(place() >= F.col("h"))
    rest = rest.select("conv_id", (place() + F.col("shift")).alias("i"), "name", "chars")
    taken = own.select("conv_id", F.inline("head"))
    length = F.size("head") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    last = own.select("conv_id", length.alias("i"), F.lit(None).cast("binary").alias("name"), F.lit(None).cast("long").alias("chars"))
    return rest.unionByName(taken).unionByName(last)


def prefixes(steps: DataFrame) -> DataFrame:
    """conv_id, depth, name, parent (its name), chars of the last step, and whether the sequence ends there.

    `steps` has the steps of each sequence from i = 0 on and one without a name at its end.
    """
    steps = stored(steps, "steps")
    longest = steps.agg(F.max("i")).first()[0]
    height = int(longest or 0).bit_length()
    cuts, runs = [], steps
    for level in range(height):
        half = F.col("i") % 2
        values = [F.max(F.when(half == 0, F.col("name"))).alias("left"), F.max(F.when(half == 1, F.col("name"))).alias("right")]
        values.append(F.max(half).alias("cut"))
        if not level:
            values += [F.max(F.when(half == s, F.col("chars"))).alias(f"chars{s}") for s in (0, 1)]
        pairs = runs.groupBy("conv_id", F.shiftright("i", 1).alias("i")).agg(*values)
        # a sequence that ends before the cut is a tree of half the height
        small = (F.col("i") == 0) & (F.col("cut") == 0)
        pairs = stored(pairs.withColumn("small", small), "cut")
        cuts.append(pairs)
        both = F.coalesce("right", F.unhex(F.lit("")))
        runs = pairs.filter(~F.col("small")).select("conv_id", "i", _named(F.col("left"), both).alias("name"))
    trees = steps.filter("i = 0").select("conv_id", "i", _root().alias("root"), F.col("chars").alias("next")) if not height else None
    for level in reversed(range(height)):
        pairs = cuts[level]
        roots = pairs.filter(F.col("i") == 0 if trees is None else F.col("small")).select("conv_id", "i", _root().alias("root"))
        trees = roots if trees is None else trees.unionByName(roots)
        nexts = [F.col("chars0").alias("next"), F.col("chars1").alias("next")] if not level else []
        upper = F.struct((F.col("i") * 2).alias("i"), F.col("root"), *nexts[:1])
        lower = F.struct((F.col("i") * 2 + 1).alias("i"), _named(F.col("root"), F.col("left")).alias("root"), *nexts[1:])
        trees = trees.join(pairs, ["conv_id", "i"])
        trees = trees.select("conv_id", F.inline(F.when(F.col("cut") == 1, F.array(upper, lower)).otherwise(F.array(upper))))
    found = stored(trees, "prefixes")
    above = found.select("conv_id", (F.col("i") + 1).alias("i"), F.col("root").alias("parent"), F.col("next").alias("chars"))
    return found.join(above, ["conv_id", "i"], "left").select(
        "conv_id", F.col("i").alias("depth"), F.col("root").alias("name"), "parent", "chars", F.col("next").isNull().alias("ends")
    )


def totals(own: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """depth, name and, over each node's subtree, the sums of `leaves` and `saved`.

    `own` has each node's depth, name, parent, the parent's `above` (a member), leaves and saved; `paths` has conv_id, depth and name.
    """
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    grafts = []
    for level in range(height):
        half = 1 << level
        tops = own.filter(F.col("depth") % (2 * half) == half).select("depth", "name", "parent", "above", "leaves", "saved")
        for graft in grafts:
            late = graft.filter(F.col("depth") % (2 * half) == half)
            tops = tops.unionByName(late, allowMissingColumns=True)
        if grafts:
            tops = tops.groupBy("depth", "name").agg(F.max("parent").alias("parent"), F.max("above").alias("above"), *sums)
        cut = tops.groupBy("depth", "parent").agg(F.max("above").alias("conv_id"), *sums)
        cut = cut.select("conv_id", F.shiftright(F.col("depth") - 1, level).alias("run"), "leaves", "saved")
        run = paths.select("conv_id", "depth", "name", F.shiftright("depth", level).alias("run")).filter(F.col("run") % 2 == 0)
        graft = run.join(cut, ["conv_id", "run"]).groupBy("depth", "name").agg(*sums)
        grafts.append(stored(graft, "graft"))
    out = own.select("depth", "name", "leaves", "saved")
    for graft in grafts:
        out = out.unionByName(graft)
    return out.groupBy("depth", "name").agg(*sums)


def trie(steps: DataFrame) -> DataFrame:
    """One row for each node: name, parent (names), conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. `steps` as for `prefixes`.

    saved_tokens sums, over the subtree, (n_convs - 1) * code points of the node's last text.
    """
    paths = stored(prefixes(steps), "paths")
    nodes = paths.groupBy("depth", "name").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")
    )
    nodes = stored(nodes, "nodes")
    height = int(nodes.agg(F.max("depth")).first()[0] or 0).bit_length()
    children = nodes.filter(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(children, ["depth", "name"], "left").join(above, ["depth", "parent"], "left")
    nodes = stored(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    own = nodes.select(
        "depth",
        "name",
        "parent",
        F.col("parent_conv_id").alias("above"),
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).alias("saved"),
    )
    summed = totals(own, paths, height).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})
    ends = digests(paths.filter("ends").select("depth", "name", "conv_id"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return (
        nodes.join(summed, ["depth", "name"])
        .join(ends, ["depth", "name"], "left")
        .select(
            "name", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )


def digests(ends: DataFrame) -> DataFrame:
    """For each (depth, name) the SHA-256 of its conv_ids in decimal, in rising order, joined by commas."""
    n = partitions(ends.sparkSession)
    key = F.concat(F.col("name"), F.encode(F.col("depth").cast("string"), "utf-8"))
    spread = ends.select(key.alias("node"), "depth", "name", "conv_id").repartitionByRange(n, "node", "conv_id")
    spread = spread.sortWithinPartitions("node", "conv_id").mapInArrow(tidy(_joined), "depth long, name binary, first long, ids binary")
    gathered = spread.repartition(n, "depth", "name").sortWithinPartitions("depth", "name", "first")
    return gathered.mapInArrow(tidy(_hashed), "depth long, name binary, ends_sha256 string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ids of one node as texts of at most IDS ids."""
    names = ["depth", "name", "first", "ids"]
    node, ids = None, []

    def text():
        return node[0], node[1], ids[0], ",".join(map(str, ids)).encode()

    for batch in batches:
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "conv_id")), strict=True)
        for depth, name, conv in rows:
            if (depth, name) != node or len(ids) == IDS:
                if ids:
                    out.append(text())
                node, ids = (depth, name), []
            ids.append(conv)
        yield _batch(out, names, (pa.int64(), pa.binary(), pa.int64(), pa.binary()))
    if ids:
        yield _batch([text()], names, (pa.int64(), pa.binary(), pa.int64(), pa.binary()))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["depth", "name", "ends_sha256"], (pa.int64(), pa.binary(), pa.string())
    node, digest = None, None
    for batch in batches:
        out = []
        for depth, name, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "ids")), strict=True):
            if (depth, name) != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (depth, name), hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        yield _batch(out, names, kinds)
    if node:
        yield _batch([(*node, digest.hexdigest())], names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
