"""Repair of conversations as a lightest derivation, found with Knuth's agenda.

A conversation is well formed when its roles' initials are (s?(ua)+)?. Edits go over its rows in order:
Keep costs nothing, Rerole (to user or assistant) 1, Delete 2, Insert (a user or assistant row without
text, anywhere) 5. Blank rows (nothing but white space) and duplicates (role and text seen earlier)
have to be deleted; a truncated row (its last character that isn't white space is none of .!?) adds 5
unless it is deleted. Of the cheapest edits those count whose initials, in order, are least in ASCII.

An item [i, q] says that the rows from i on can be completed from grammar state q. Axioms are the
accepting states at the end; each edit of row i, or an insertion before it, is a hyperedge from an item
and that row to another item, and raises its weight: (cost, rows covered, initial of the edit). The
agenda pops the lightest item, which is thereby final, until the goal [0, start] is popped (`derive`). An
insertion costs 5 and every other edit covers a row more, so each hyperedge yields more than what it
comes from: weights are superior functions, also where a cost is 0. At one item each initial belongs to
one hyperedge, so equal costs are told apart by the first initial alone, and no audit text is carried.

A conversation of up to `segment_rows` rows is repaired at once, within a stream of sorted rows. A longer one,
which may hold any share of all rows, is cut into segments that tasks share: each finds the
lightest derivations between all pairs of states, with the order of their audits (`matrix`);
the segments' 4 by 4 tables, one row for each, meet in one task for each conversation and are chained
from the end; then each segment is repaired between its states. Its texts pass through one task once
more, in order and constant memory, for the hash of the whole. Duplicates are found by an aggregate on
(conversation, role, text) that is combined before its shuffle.

Rows are ordered by turn, null first, then role and text. Null roles and texts become one space and so
does a null turn in `damage`'s key. Rows without a conv_id are one conversation with the id null. A role
without an initial, or another than s, u, a, can't be kept. Repeated rows are duplicates. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.blocks import schema_of
from claimweave.llm.sequences import numbered, place
from claimweave.llm.shared import partitions, stored
from claimweave.llm.text import tidy

SEGMENT = 4096  # rows of a conversation that are repaired at once

SPACES = " \t\n\x0b\x0c\r"
GOOD, BLANK, DUPLICATE, TRUNCATED = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)  # states, by what came last
ACCEPTING = (START, ASSISTANT)
BEFORE = {SYSTEM: ((START, "s"),), USER: ((START, "u"), (SYSTEM, "u"), (ASSISTANT, "u")), ASSISTANT: ((USER, "a"),), START: ()}
NEXT = {(p, c): q for q, came in BEFORE.items() for p, c in came}
ROLE = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, OPEN_END = 1, 2, 5, 5


def derive(initials: str, faults: list[int], ends: tuple[int, ...], last: bool, goals: tuple[int, ...]) -> dict:
    """The final items: (i, state) to (cost, edit, the item it comes from), as far as the `goals`, states at 0, need.

    `ends` are the axioms' states. Rows are only inserted behind the last row of a `last` segment.
    """
    n = len(initials)
    final: dict[tuple[int, int], tuple] = {}
    agenda = [(0, 0, "", q, None) for q in ends]
    wanted = set(goals)
    while agenda and wanted:
        cost, covered, edit, q, came = heapq.heappop(agenda)
        i = n - covered
        if (i, q) in final:
            continue
        item = (i, q)
        final[item] = (cost, edit, came)
        if not i:
            wanted.discard(q)
        if i < n or last:
            for p, c in BEFORE[q]:
                if c != "s" and (i, p) not in final:
                    heapq.heappush(agenda, (cost + INSERT, covered, "I", p, item))
        if i:
            fault, initial = faults[i - 1], initials[i - 1]
            heapq.heappush(agenda, (cost + DELETE, covered + 1, "D", q, item))
            if fault in (GOOD, TRUNCATED):
                extra = cost + OPEN_END * (fault == TRUNCATED)
                for p, c in BEFORE[q]:
                    if c == initial:
                        heapq.heappush(agenda, (extra, covered + 1, "K", p, item))
                    if c != "s":
                        heapq.heappush(agenda, (extra + REROLE, covered + 1, "R", p, item))
    return final


def audit_of(final: dict, state: int) -> str:
    """The edits' initials from [0, state] on."""
    out, item = [], (0, state)
    while item is not None:
        _, edit, item = final[item]
        out.append(edit)
    return "".join(out)


def matrix(initials: str, faults: list[int], last: bool) -> tuple[list[int], list[int]]:
    """By 4 * from + to: the least cost between two states (-1: there is no way), and where its audit stands among those from the same state."""
    costs, audits = [-1] * 16, [""] * 16
    for end in ACCEPTING if last else range(4):
        final = derive(initials, faults, (end,), last, tuple(range(4)))
        for q in range(4):
            if (0, q) in final:
                costs[4 * q + end], audits[4 * q + end] = final[0, q][0], audit_of(final, q)
    ranks = [sorted(audits[k & ~3 : (k & ~3) + 4]).index(audits[k]) for k in range(16)]
    return costs, ranks


def chain(segments: list[tuple[list[int], list[int]]]) -> list[int]:
    """The state at the start of each segment and at the end, for the lightest derivation of all."""
    best = [0 if q in ACCEPTING else None for q in range(4)]
    steps = []
    for costs, ranks in reversed(segments):
        found, step = [None] * 4, [None] * 4
        for q in range(4):
            ways = [(costs[4 * q + p] + best[p], ranks[4 * q + p], p) for p in range(4) if costs[4 * q + p] >= 0 and best[p] is not None]
            if ways:
                found[q], _, step[q] = min(ways)
        best = found
        steps.append(step)
    states = [START]
    for step in reversed(steps):
        states.append(step[states[-1]])
    return states


def applied(audit: str, rows: list[tuple[str, str]], state: int) -> list[str]:
    """The repaired rows as role:text."""
    out, rest, q = [], iter(rows), state
    for edit in audit:
        role, text = next(rest) if edit != "I" else ("", "")
        if edit == "D":
            continue
        c = role[0] if edit == "K" else "a" if q == USER else "u"
        q = NEXT[q, c]
        out.append(f"{role if edit == 'K' else ROLE[c]}:{text}")
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage that crc32 of "conv_id:turn", modulo 20, deals each row.

    0 drops it, 1 empties the text, 2 takes .!? out of it, 3 repeats the row, 4 makes it a user's.
    """
    space = F.lit(" ")
    filled = {c: F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn", "role", "text")}
    hit = F.pmod(F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", filled["role"].alias("role"), filled["text"].alias("text"), hit.alias("hit")).filter("hit <> 0")
    text = F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _fault(again: Column) -> Column:
    ink = F.rtrim("text", F.lit(SPACES))
    ended = F.substring(ink, -1, 1).isin(".", "!", "?")
    return F.when(ink == "", BLANK).when(again, DUPLICATE).when(~ended, TRUNCATED).otherwise(GOOD)


COUNTS = "blank long, duplicate long, truncated long, illegal long, cost long"
FOUND = f"conv struct<conv_id:long>, segment long, whole boolean, {COUNTS}, audit string, sha string, opens string, closes string, costs array<long>, ranks array<long>"
CHAINED = f"conv struct<conv_id:long>, segment long, begins int, {COUNTS}, ends int, last boolean"
PARTS = "conv struct<conv_id:long>, segment long, audit string, said binary"
WHOLE = "conv struct<conv_id:long>, audit string, sha string"


def repair(conversations: DataFrame, segment_rows: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation.

    gaps: turns missing between the first and the last; illegal: adjacent initials other than su, ua,
    au; the hash is of the repaired role:text, joined by line feeds. Nulls as in `damage`.
    """
    n = partitions(conversations.sparkSession)
    # a struct, as a null id is one conversation
    rows = conversations.select(
        F.struct(F.col("conv_id").cast("long").alias("conv_id")).alias("conv"),
        "turn",
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    )
    rows, spans = numbered(rows, "conv", [("turn", False), ("role", True), ("text", True)])
    said = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    segment = F.floor(F.col("i") / segment_rows).cast("long")
    rows = rows.join(spans, ["conv", "part"]).withColumns({"i": place(), "said": said})
    rows = stored(rows.select("conv", "turn", "role", "text", "i", "total", "said"), "placed")
    seen = rows.groupBy("conv", "said").agg(F.min("i").alias("seen"), F.count("*").alias("times")).filter("times > 1")
    judged = rows.join(seen.drop("times"), ["conv", "said"], "left").select(
        "conv",
        segment.alias("segment"),
        "i",
        "role",
        "text",
        F.substring("role", 1, 1).alias("initial"),
        _fault(F.coalesce(F.col("seen") < F.col("i"), F.lit(False))).alias("fault"),
        (segment == F.floor((F.col("total") - 1) / segment_rows)).alias("last"),
        (F.col("total") <= segment_rows).alias("whole"),
    )
    judged = stored(judged, "judged")
    found = stored(_in_order(judged, n).mapInArrow(tidy(partial(_solved, schema_of(FOUND))), FOUND), "segments")
    done = found.filter("whole").select("conv", *_names(COUNTS), "audit", "sha")
    fields = schema_of(CHAINED)
    chained = found.filter("not whole").groupBy("conv").applyInArrow(lambda table: _chained(fields, table), CHAINED)
    chained = stored(chained, "chained")
    between = chained.select("conv", "segment", "begins", "ends")
    parts = _in_order(judged.filter("not whole").join(between, ["conv", "segment"]), n).mapInArrow(tidy(partial(_applied, schema_of(PARTS))), PARTS)
    parts = parts.repartition(n, "conv").sortWithinPartitions("conv", "segment").mapInArrow(tidy(partial(_hashed, schema_of(WHOLE))), WHOLE)
    long = chained.filter("last").select("conv", *_names(COUNTS)).join(parts, "conv")
    turns = rows.groupBy("conv").agg(F.max("turn").alias("most"), F.min("turn").alias("least"), F.count_distinct("turn").alias("n"))
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("n"), F.lit(0)).cast("long")
    out = done.unionByName(long).join(turns, "conv")
    return out.select("conv.conv_id", gaps.alias("gaps"), *_names(COUNTS), "audit", F.col("sha").alias("repaired_sha256"))


def damaged_and_repaired(conversations: DataFrame, segment_rows: int = SEGMENT) -> DataFrame:
    """`repair` of the damaged rows, with a row of zeros, an empty audit and an empty text's hash for a conversation that lost all."""
    key = F.struct(F.col("conv_id").cast("long").alias("conv_id")).alias("conv")
    fixed = repair(damage(conversations), segment_rows)
    columns = [c for c in fixed.columns if c != "conv_id"]
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    out = conversations.select(key).distinct().join(fixed.select(key, *columns), "conv", "left")
    return out.select("conv.conv_id", *(F.coalesce(c, none.get(c, F.lit(0).cast("long"))).alias(c) for c in columns))


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _in_order(rows: DataFrame, n: int) -> DataFrame:
    """Segments one after another, each one's rows in order."""
    return rows.repartition(n, "conv", "segment").sortWithinPartitions("conv", "segment", "i")


def _groups(batches: Iterator[pa.RecordBatch], key: int, *columns: str) -> Iterator[list[tuple]]:
    """Runs of rows that are alike in the first `key` columns."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if rows and row[:key] != rows[0][:key]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _batches(rows: Iterator[tuple], fields: pa.Schema, most: int = 1024) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(dict(zip(fields.names, row, strict=True)))
        if len(out) == most:
            yield pa.RecordBatch.from_pylist(out, schema=fields)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema=fields)


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _text_hash(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _solved(fields: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for group in _groups(batches, 2, "conv", "segment", "role", "text", "initial", "fault", "last", "whole"):
            conv, segment, *_, last, whole = group[0]
            initials, faults = [r[4] for r in group], [r[5] for r in group]
            counts = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)] + [_illegal(initials)]
            edges = (initials[0], initials[-1])
            if whole:
                final = derive(initials, faults, ACCEPTING, True, (START,))
                audit = audit_of(final, START)
                sha = _text_hash(applied(audit, [(r[2], r[3]) for r in group], START))
                yield conv, segment, True, *counts, final[0, START][0], audit, sha, *edges, None, None
            else:
                costs, ranks = matrix(initials, faults, last)
                yield conv, segment, False, *counts, None, None, None, *edges, costs, ranks

    yield from _batches(rows(), fields)


def _chained(fields: pa.Schema, table: pa.Table) -> pa.Table:
    """One conversation's segments in order, each with its states; the last has the sums."""
    rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
    states = chain([(r["costs"], r["ranks"]) for r in rows])
    sums = [sum(r[c] for r in rows) for c in _names(COUNTS)[:4]]
    sums[3] += sum(_illegal([a["closes"], b["opens"]]) for a, b in zip(rows, rows[1:], strict=False))
    cost = sum(r["costs"][4 * a + b] for r, a, b in zip(rows, states, states[1:], strict=False))
    out = [(r["conv"], r["segment"], a, *sums, cost, b, r is rows[-1]) for r, a, b in zip(rows, states, states[1:], strict=False)]
    return pa.Table.from_batches(_batches(iter(out), fields))


def _applied(fields: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for group in _groups(batches, 2, "conv", "segment", "role", "text", "initial", "fault", "last", "begins", "ends"):
            conv, segment, *_, last, begins, ends = group[0]
            final = derive([r[4] for r in group], [r[5] for r in group], (ends,), last, (begins,))
            audit = audit_of(final, begins)
            lines = applied(audit, [(r[2], r[3]) for r in group], begins)
            yield conv, segment, audit, "\n".join(lines).encode() if lines else None

    yield from _batches(rows(), fields, 16)


def _hashed(fields: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        conv, audits, digest, some = None, [], None, False
        for batch in batches:
            for one, audit, said in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "said")), strict=True):
                if one != conv:
                    if conv:
                        yield conv, "".join(audits), digest.hexdigest()
                    conv, audits, digest, some = one, [], hashlib.sha256(), False
                audits.append(audit)
                if said is not None:
                    digest.update(b"\n" + said if some else said)
                    some = True
        if conv:
            yield conv, "".join(audits), digest.hexdigest()

    yield from _batches(rows(), fields, 16)
