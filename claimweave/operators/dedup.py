"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """Keep one row per key: the greatest by `newest_first`, ties by all other columns.

    The order is total, so reruns pick the same row. Spark prunes each input
    partition to one row per key before the shuffle (WindowGroupLimit), so a
    key that was resent many times does not pile up in one task.
    """
    if set(df.columns) == set(keys):
        return df.distinct()
    ties = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.desc(c) for c in [*newest_first, *ties]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
