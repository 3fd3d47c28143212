"""Operations reports over the audit log, Bronze and the quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.columns import AsOf, as_date, pct

TERMINAL = ("COMPLETED", "FAILED")
NEWEST = ["event_timestamp", "job_run_id", "pipeline_name", "layer", "status"]


def breached(pct_limit: float) -> Column:
    """Quarantined share strictly above the limit; an empty input never breaches."""
    over = F.col("quarantine_rows") * 100 > F.col("input_rows") * F.lit(pct_limit)
    return F.coalesce(over & (F.col("input_rows") != 0), F.lit(False))


def threshold_breached(audit: DataFrame, pct_limit: float = 5) -> DataFrame:
    return audit.withColumns(
        {
            "quarantine_pct": pct(F.col("quarantine_rows"), F.col("input_rows")),
            "threshold_breached": breached(pct_limit),
        }
    )


def recent_runs(audit: DataFrame, n: int = 10) -> DataFrame:
    return audit.orderBy(*(F.desc(c) for c in NEWEST)).limit(n)


def health(audit: DataFrame, pipeline: str, pct_limit: float = 5) -> DataFrame:
    """The pipeline's latest finished run and whether it calls for an alert."""
    finished = audit.filter(
        (F.col("pipeline_name") == pipeline) & F.col("status").isin(*TERMINAL)
    )
    return recent_runs(finished, 1).select(
        "pipeline_name",
        "status",
        "input_rows",
        "output_rows",
        "quarantine_rows",
        "event_timestamp",
        breached(pct_limit).alias("threshold_breached"),
        ((F.col("status") == "FAILED") | breached(pct_limit)).alias("alert"),
    )


def run_durations(audit: DataFrame) -> DataFrame:
    """First start, last completion and the seconds between, per run and layer."""
    started = F.min(F.when(F.col("status") == "STARTED", F.col("event_timestamp")))
    finished = F.max(F.when(F.col("status") == "COMPLETED", F.col("event_timestamp")))
    spans = audit.groupBy("job_run_id", "layer").agg(
        started.alias("started_at"), finished.alias("finished_at")
    )
    return spans.withColumn("duration_sec", F.timestamp_diff("SECOND", "started_at", "finished_at"))


def stream_runs(batches: DataFrame) -> DataFrame:
    """What each run of the stream took in, and the seconds that its micro-batches were at work."""
    busy = F.col("finished_at").cast("double") - F.col("started_at").cast("double")
    return batches.groupBy("job_run_id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("files").alias("files"),
        F.sum("input_bytes").alias("input_bytes"),
        F.sum("landed_rows").alias("landed_rows"),
        F.sum(busy).alias("busy_sec"),
        F.max("finished_at").alias("last_finished_at"),
    )


def last_days(day: str, as_of: AsOf, days: int) -> Column:
    """True for the `days` dates that end at `as_of`."""
    end = as_date(as_of)
    return (F.col(day) > F.date_sub(end, days)) & (F.col(day) <= end)


def ingestion_velocity(
    bronze: DataFrame, as_of: AsOf = None, days: int = 30, day: str = "_ingest_date"
) -> DataFrame:
    return (
        bronze.filter(last_days(day, as_of, days))
        .groupBy(day)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def open_quarantine(quarantined: DataFrame, silver: DataFrame) -> DataFrame:
    """Rejected rows that Silver has neither taken in by a replay nor overtaken by a newer version."""
    held = silver.select(F.col("claim_id").alias("_held"), F.col("_ingestion_ts").alias("_held_ts"))
    same = (F.col("claim_id") == F.col("_held")) & (F.col("_held_ts") >= F.col("_ingestion_ts"))
    return quarantined.join(held, same, "left_anti")


def ops_metrics(
    bronze: DataFrame,
    silver: DataFrame,
    quarantined: DataFrame,
    anomalies: list[DataFrame],
    as_of: AsOf = None,
    days: int = 30,
) -> DataFrame:
    """One row of headline numbers.

    `anomalies` are one-column frames of counts (orphans, unresolved keys).
    Accuracy is the share of Bronze rows that reached Silver.
    """
    recent = F.count_if(last_days("_ingest_date", as_of, days))
    parts = [
        bronze.agg(
            F.count(F.lit(1)).alias("bronze_rows"),
            recent.alias("throughput"),
            F.max("_ingestion_ts").alias("last_sync"),
        ),
        silver.agg(F.count(F.lit(1)).alias("silver_rows")),
        open_quarantine(quarantined, silver).agg(F.count(F.lit(1)).alias("quarantine_backlog")),
        *(a.agg(F.sum(a.columns[0]).alias("anomalies")) for a in anomalies),
    ]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    total = merged.agg(
        F.max("throughput").alias("throughput_30d"),
        pct(F.max("silver_rows"), F.max("bronze_rows")).alias("accuracy_pct"),
        F.max("quarantine_backlog").alias("quarantine_backlog"),
        F.coalesce(F.sum("anomalies"), F.lit(0)).alias("recon_anomalies"),
        F.max("last_sync").alias("last_sync"),
    )
    return total


def quarantine_report(quarantined: DataFrame) -> DataFrame:
    return quarantined.select(
        "claim_id", "_reject_reason", F.col("_quarantine_ts").alias("detected_at")
    )


def quarantine_reasons(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("_reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


def feed_delay(bronze: DataFrame, expected: DataFrame, source: str) -> DataFrame:
    """Minutes each source's last arrival lies past its expected time (never below zero).

    `expected` has one row per source: the source column and `expected_at`. A
    source that has sent nothing has no delay yet.
    """
    arrived = bronze.groupBy(source).agg(F.max("_ingestion_ts").alias("last_arrival"))
    late = F.timestamp_diff("MINUTE", "expected_at", "last_arrival")
    return expected.join(arrived, source, "left").withColumn(
        "delay_minutes", F.when(late < 0, F.lit(0).cast("bigint")).otherwise(late)
    )


