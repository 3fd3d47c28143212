"""Many-to-one lookups that hold up under hot keys and dimensions of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 256


def lookup(
    facts: DataFrame, dim: DataFrame, key: str, spread_by: list[str], how: str = "left"
) -> DataFrame:
    """Join `facts` to `dim` (one row per `key`) without overloading any task.

    Nothing runs while the plan is built. Spark joins a dimension under its broadcast threshold
    map-side, whatever the keys are. A larger one is shuffled: rows with a NULL key, which match
    nothing, are spread over SALTS buckets by hashing `spread_by`, and a key that holds many rows
    is cut by adaptive execution's skew join, which repeats its one dimension row.
    """
    bucket = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    spread = facts.withColumn("_salt", F.when(F.col(key).isNull(), bucket).otherwise(F.lit(0)))
    return spread.join(dim.withColumn("_salt", F.lit(0)), [key, "_salt"], how).drop("_salt")
