"""Data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.functions.columns import UNRESOLVED, pct
from claimweave.sources.footers import counting_session, row_count


def _stack(pairs: list[tuple[str, Column]], name: str, value: str) -> Column:
    """(label, value) rows from columns of one row."""
    return F.inline(
        F.array(*(F.struct(F.lit(label).alias(name), v.alias(value)) for label, v in pairs))
    )


def reconcile(stages: dict[str, DataFrame]) -> DataFrame:
    """Row count of each stage and its difference from the stage before."""
    return _differences({name: df.agg(F.count(F.lit(1)).alias("row_count")) for name, df in stages.items()})


def reconcile_stored(spark: SparkSession, stages: dict[str, DataFrame | str]) -> DataFrame:
    """`reconcile` for Parquet tables as they are stored, by path or as read, counted by their footers alone."""
    session = counting_session(spark)
    return _differences({name: row_count(df, session) for name, df in stages.items()})


def _differences(counted: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.select(F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), "row_count")
        for i, (name, df) in enumerate(counted.items(), start=1)
    ]
    before = F.lag("row_count").over(Window.orderBy("stage_no"))  # one row per stage
    return reduce(DataFrame.unionByName, counts).withColumn("delta", F.col("row_count") - before)


def unresolved_keys(
    fact: DataFrame, columns: tuple[str, ...] = ("patient_sk", "provider_sk", "plan_sk")
) -> DataFrame:
    """How many facts carry the sentinel in each key column; columns without any are left out."""
    counts = fact.agg(*(F.count_if(F.col(c) == UNRESOLVED).alias(c) for c in columns))
    rows = counts.select(_stack([(c, F.col(c)) for c in columns], "key_column", "row_count"))
    return rows.filter("row_count > 0")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Count of fact rows whose key the dimension does not hold.

    Rows with the -1 sentinel are left to `unresolved_keys`. Rows are counted
    per distinct key first, so the join sees each key once.
    """
    sentinel = F.col(key).cast("string").eqNullSafe(F.lit(str(UNRESOLVED)))
    per_key = fact.filter(~sentinel).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    lost = per_key.join(dim.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"))


def outliers(df: DataFrame, column: str, k: float = 3) -> DataFrame:
    """Rows above mean + k standard deviations of the whole column."""
    limit = df.agg(
        (F.avg(column).cast("double") + k * F.stddev_samp(column)).alias("limit")
    ).scalar()
    return df.filter(F.col(column) > limit)


def fill_rate(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of rows in which each column is filled."""
    filled = df.agg(
        F.count(F.lit(1)).alias("_rows"), *(F.count(c).alias(c) for c in columns)
    )
    pairs = [(c, pct(F.col(c), F.col("_rows"))) for c in columns]
    return filled.select(_stack(pairs, "field", "fill_pct"))


def column_presence(bronze: DataFrame, by: str = "_ingest_date") -> DataFrame:
    """Non-null count of every column per `by`, flagged where a column starts or stops filling."""
    columns = [c for c in bronze.columns if c != by]
    counts = bronze.groupBy(by).agg(*(F.count(c).alias(c) for c in columns))
    long = counts.select(by, _stack([(c, F.col(c)) for c in columns], "column_name", "filled"))
    before = F.lag("filled").over(Window.partitionBy("column_name").orderBy(by))
    return long.withColumns(
        {
            "previous": before,
            "drifted": F.coalesce((before == 0) != (F.col("filled") == 0), F.lit(False)),
        }
    )


def expectation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Failures per named rule; a rule that evaluates to NULL has failed."""
    failed = df.agg(
        *(F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items())
    )
    return failed.select(_stack([(n, F.col(n)) for n in rules], "rule", "failures"))


def gate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows passing every rule, failing rows with the names of the rules they broke)."""
    broken = F.array_compact(
        F.array(*(F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()))
    )
    judged = df.withColumn("_broken_rules", broken)
    passed = judged.filter(F.size("_broken_rules") == 0).drop("_broken_rules")
    return passed, judged.filter(F.size("_broken_rules") > 0)
