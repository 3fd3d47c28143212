"""Rows in order within their groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.shared import partitions, stored

PREFIX = 64  # characters of a string that take part in the range


def numbered(rows: DataFrame, group: str, order: list[tuple[str, bool]]) -> tuple[DataFrame, DataFrame]:
    """`rows` with `part` and `at`, and for each (group, part) its `first` at, `before` and `total`.

    A row's place in its group, from 0, is at - first + before; a group has `total` rows. `order`
    lists columns, and whether each is a long string. Rows are dealt out by ranges of group and order, so a group may
    span any number of tasks; only rows alike in all of that (and the first PREFIX characters of
    strings) lie together. Nulls come first. The second table has at most one row for each group and
    task, and a join with it on (group, part) has no hot key.
    """
    keys = [F.substring(c, 1, PREFIX) if long else F.col(c) for c, long in order]
    names = [c for c, _ in order]
    spread = rows.repartitionByRange(partitions(rows.sparkSession), group, *keys).sortWithinPartitions(group, *names)
    at = F.monotonically_increasing_id()  # the task's number from bit 33 on, below it the row's place there
    kept = stored(spread.withColumn("at", at).withColumn("part", F.shiftright("at", 33)), "numbered")
    counts = kept.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    parts = Window.partitionBy(group)
    earlier = parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.select(
        group,
        "part",
        "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(parts).alias("total"),
    )
    return kept, spans


def place() -> Column:
    return F.col("at") - F.col("first") + F.col("before")
