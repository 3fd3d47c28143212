"""Reading and writing lake tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimweave.sources.schemas import CPT, ICD10, PLANS
from claimweave.sources.scratch import scratch_dir

FORMAT = "parquet"
COMPRESSION = "zstd"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
REFERENCE_LISTS = {"icd10": ICD10, "cpt": CPT, "plans": PLANS}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Statements that run inside remove their shuffle files when they end.

    Otherwise these stay until the driver happens to collect what refers to them, so a chain of many
    statements holds the shuffles of all.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def frees_shuffles(run: Callable) -> Callable:
    """A function of a session or a frame, run under `shuffles_freed`."""

    @wraps(run)
    def freeing(first: SparkSession | DataFrame, *args, **options):
        with shuffles_freed(first if isinstance(first, SparkSession) else first.sparkSession):
            return run(first, *args, **options)

    return freeing


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = FORMAT
) -> DataFrame:
    """A table by path.

    Without a schema the columns of all files are merged, which opens every
    file's footer; with one, only the files that are scanned are opened, and
    columns a file lacks are NULL.
    """
    if schema is not None:
        return spark.read.schema(schema).format(fmt).load(path)
    return spark.read.option("mergeSchema", "true").format(fmt).load(path)


def read_reference(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A static code list; the fixed schema keeps leading zeros of codes."""
    schema: StructType = REFERENCE_LISTS[name]
    return spark.read.schema(schema).option("header", True).csv(path)


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    writer = df.write.format(fmt)
    return writer.option("compression", COMPRESSION) if fmt == FORMAT else writer


@frees_shuffles
def append(df: DataFrame, path: str, by: tuple[str, ...] = (), fmt: str = FORMAT) -> None:
    _writer(df, fmt).mode("append").partitionBy(*by).save(path)


@frees_shuffles
def overwrite(
    df: DataFrame,
    path: str,
    by: tuple[str, ...] = (),
    fmt: str = FORMAT,
    cluster: tuple[str, ...] = (),
    like: DataFrame | None = None,
) -> None:
    """Replace a table. `df` must not read from `path`.

    Partitioned output is rebalanced on the partition columns first: AQE merges
    small partitions and splits one that holds most of the rows, so neither many
    tiny files nor a single overloaded writer results. With `cluster` columns
    the rows are laid out for lookups on any of them instead (`cluster_by_each`);
    the last completes the range key, `like` is passed on.
    """
    if cluster and like is None:
        with ExitStack() as until:
            df = written(df, "layout", until)
            overwrite(df, path, by, fmt, cluster, df)
        return
    if cluster:
        df = cluster_by_each(df, [*cluster[:-1]], cluster[-1], by, like=like)
    elif by:
        df = df.hint("rebalance", *by)
    _writer(df, fmt).mode("overwrite").partitionBy(*by).save(path)


def glob_escaped(path: str) -> str:
    """A path whose special characters are not taken for a glob."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _file_system(spark, path)
    return files.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table."""
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def written(df: DataFrame, name: str, until: ExitStack | None = None) -> DataFrame:
    """`df` stored in the shared scratch folder and read back.

    Cuts lineage where a frame is used several times, survives the loss of
    executors, and gives the joins that follow a known size. `until`, where given, deletes it when it closes.
    """
    path = scratch_dir(df.sparkSession, name)
    if until is not None:
        until.callback(remove, df.sparkSession, path)
    overwrite(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register(spark: SparkSession, name: str, path: str, fmt: str = FORMAT) -> None:
    """Make the data at a location queryable by name, its current partitions included."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def cluster_by(df: DataFrame, columns: list[str], files: int | None = None) -> DataFrame:
    """Range-partition and sort for lookups on the first of `columns`.

    End `columns` with one of many values (the claim id): it completes the range
    key, so that a hot combination of the others is cut into several files.
    """
    ranges = [files] if files else []
    return df.repartitionByRange(*ranges, *columns).sortWithinPartitions(*columns)


RANKS = 6  # bits


def range_bounds(df: DataFrame, column: str) -> list:
    """Values that cut a column's rows into 2**RANKS ranges at most, of like numbers of rows."""
    ranges = df.select(column).filter(F.col(column).isNotNull()).repartitionByRange(1 << RANKS, column)
    lows = ranges.groupBy(F.spark_partition_id()).agg(F.min(column).alias("low")).collect()
    return sorted(row.low for row in lows)[1:]


def range_rank(column: str, bounds: list, base: int = 0) -> Column:
    """How many of the bounds a value reaches, by halving; NULL has rank 0."""
    if not bounds:
        return F.lit(base)
    half = len(bounds) // 2
    upper = range_rank(column, bounds[half + 1 :], base + half + 1)
    return F.when(F.col(column) >= F.lit(bounds[half]), upper).otherwise(range_rank(column, bounds[:half], base))


def morton_key(ranks: list[Column]) -> Column:
    """The ranks' bits in turn, highest first: rows near in all ranks have keys near each other."""
    bits = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(ranks) + len(ranks) - 1 - i)
        for bit in range(RANKS)
        for i, rank in enumerate(ranks)
    ]
    return reduce(Column.bitwiseOR, bits)


def cluster_by_each(
    df: DataFrame,
    columns: list[str],
    last: str,
    by: tuple[str, ...] = (),
    files: int | None = None,
    like: DataFrame | None = None,
) -> DataFrame:
    """Lay rows out so that a lookup on any one of `columns` meets few files and row groups.

    The rows follow a Morton curve over the ranks of the columns, which keeps every column's values
    in narrow ranges: of n files a lookup on one of two columns opens about the root of n. `last`, a
    column of many values, completes the range key, so that a hot combination is cut into several
    files. The rows are stored once, as their ranges are sampled from them, unless `like` is given:
    rows that lie in storage and hold values of `columns` like theirs, which the ranks are then taken from.
    They move where a row lies in the layout and nothing else.
    """
    if like is None:
        df = like = written(df, "layout")
    key = morton_key([range_rank(c, range_bounds(like, c)) for c in columns])
    ranges = [files] if files else []
    curve = df.withColumn("_curve", key).repartitionByRange(*ranges, *by, "_curve", last)
    return curve.sortWithinPartitions(*by, "_curve", *columns, last).drop("_curve")


def is_empty(df: DataFrame) -> bool:
    """One-row probe."""
    return df.isEmpty()
