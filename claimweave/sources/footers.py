"""Row counts of stored tables from Parquet footers, without reading a column."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.sources.tables import glob_escaped

V1 = "spark.sql.sources.useV1SourceList"


def counting_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose Parquet scans answer counts from footers."""
    session = spark.newSession()
    session.conf.set(V1, ",".join(f for f in spark.conf.get(V1).split(",") if f != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def row_count(stored: DataFrame | str, session: SparkSession) -> DataFrame:
    """One row, `row_count`, of a Parquet table: a path, or a frame as it is read with nothing applied to it.

    `session` is a `counting_session`. Tasks open footers alone, in parallel; a table without files
    counts 0. A frame is counted by its list of files, those that the catalog's partitions name now;
    a path, which holds nothing but the table, spares the driver that list.
    """
    if isinstance(stored, str):
        scan = session.read.parquet(glob_escaped(stored))
    else:
        files = [glob_escaped(unquote(file)) for file in stored.inputFiles()]
        if not files:
            return session.range(0).agg(F.count(F.lit(1)).alias("row_count"))
        scan = session.read.schema(stored.schema).parquet(*files)
    counted = scan.agg(F.count(F.lit(1)).alias("_rows"))
    return counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"))
