"""Silver: typed, validated, deduplicated claims, and the rows that failed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.columns import (
    AsOf,
    clean_code,
    parse_date,
    parse_money,
    reject_reason,
    valid_mask,
)
from claimweave.operators.dedup import latest_per_key
from claimweave.operators.merge import missing_from, row_digest
from claimweave.sources.schemas import MALFORMED, RAW_CLAIM_COLUMNS

Expected = dict[str, str] | None  # expectations: SQL conditions by name

NEWEST_FIRST = ["_ingestion_ts", "_source_file"]
QUARANTINE_COLUMNS = ["_reject_reason", "_bronze_run_id", "_quarantine_ts", "_row_digest"]


def newer_than(df: DataFrame, watermark: str | Column, ts: str = "_ingestion_ts") -> DataFrame:
    """Rows ingested strictly after the watermark; also prunes `_ingest_date` partitions."""
    mark = F.lit(watermark) if isinstance(watermark, str) else watermark
    mark = mark.cast(df.schema[ts].dataType)
    rows = df.filter(F.col(ts) > mark)
    if "_ingest_date" in df.columns:
        rows = rows.filter(F.col("_ingest_date") >= mark.cast("date"))
    return rows


def conform_raw(df: DataFrame) -> DataFrame:
    """Add contract columns the feed left out, and the mark of malformed records, as NULL text."""
    absent = [c for c in (*RAW_CLAIM_COLUMNS, MALFORMED) if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def coerce_claims(df: DataFrame) -> DataFrame:
    """Text columns to money and dates; unreadable text becomes NULL."""
    dates = {c: parse_date(F.col(c)) for c in ("claim_date", "admission_date", "discharge_date")}
    return df.withColumns({"claim_amount": parse_money(F.col("claim_amount")), **dates})


def normalize_codes(
    df: DataFrame, columns: tuple[str, ...] = ("claim_status", "diagnosis_code", "procedure_code")
) -> DataFrame:
    return df.withColumns({c: clean_code(F.col(c)) for c in columns})


def typed_claims(bronze: DataFrame) -> DataFrame:
    return normalize_codes(coerce_claims(conform_raw(bronze)))


def sound_mask(as_of: AsOf = None, expected: Expected = None) -> Column:
    """True exactly where a record fits its file's header and no rule or expectation is broken."""
    return F.col(MALFORMED).isNull() & valid_mask(as_of, expected)


def rejection(as_of: AsOf = None, expected: Expected = None) -> Column:
    """Why a record is rejected, `malformed` before all rules, these before expectations; NULL for a sound one."""
    return F.when(F.col(MALFORMED).isNotNull(), "malformed").otherwise(reject_reason(as_of, expected))


def split_valid(df: DataFrame, mask: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad); every row lands in exactly one because the mask is never NULL."""
    return df.filter(mask), df.filter(~mask)


def quarantine(bad: DataFrame, run_id: str, as_of: AsOf = None, expected: Expected = None) -> DataFrame:
    """Rejected rows with their reason; the Bronze run id moves to `_bronze_run_id`."""
    return conform_raw(bad).withColumns(
        {
            "_reject_reason": rejection(as_of, expected),
            "_bronze_run_id": F.col("_job_run_id"),
            "_quarantine_ts": F.current_timestamp(),
            "_job_run_id": F.lit(run_id),
            "_row_digest": row_digest([*RAW_CLAIM_COLUMNS, *NEWEST_FIRST, MALFORMED]),
        }
    )


def unseen_quarantine(rejected: DataFrame, stored: DataFrame) -> DataFrame:
    """Rejected rows a failed earlier attempt has not stored already."""
    return missing_from(rejected, stored, ["_row_digest"])


def latest_claims(good: DataFrame) -> DataFrame:
    """One row per claim, and the load stamp."""
    latest = latest_per_key(good, ["claim_id"], NEWEST_FIRST)
    return latest.withColumn("_silver_updated_at", F.current_timestamp())


def cleanse(
    bronze: DataFrame, run_id: str, as_of: AsOf = None, expected: Expected = None
) -> tuple[DataFrame, DataFrame]:
    """Bronze increment -> (latest valid claims, rejected rows).

    A row that fails an expectation is rejected with its name, so an older row of the claim that
    meets all of them stays in force.
    """
    good, bad = split_valid(typed_claims(bronze), sound_mask(as_of, expected))
    return latest_claims(good.drop(MALFORMED)), quarantine(bad, run_id, as_of, expected)


def replay_quarantine(
    stored: DataFrame, silver: DataFrame, as_of: AsOf = None, expected: Expected = None
) -> tuple[DataFrame, DataFrame]:
    """Re-validate quarantined rows: (rows to upsert into Silver, rows that stay).

    Only the newest passing version of a claim is promoted, and only when
    Silver holds none that is as new. Malformed records stay.
    """
    passing, failing = split_valid(conform_raw(stored), sound_mask(as_of, expected))
    # the digest follows from the other columns, so it need not be shuffled to rank them
    newest = latest_per_key(passing.drop("_row_digest"), ["claim_id"], NEWEST_FIRST)
    held = silver.select(
        F.col("claim_id").alias("_held_id"), F.col("_ingestion_ts").alias("_held_ts")
    )
    newer = (F.col("claim_id") == F.col("_held_id")) & (F.col("_held_ts") >= F.col("_ingestion_ts"))
    promoted = newest.join(held, newer, "left_anti")
    restored = promoted.withColumns(
        {"_job_run_id": F.col("_bronze_run_id"), "_silver_updated_at": F.current_timestamp()}
    ).drop(*QUARANTINE_COLUMNS, MALFORMED)
    return restored, failing


def reprocess(silver: DataFrame, day: str, column: str = "_ingest_date") -> DataFrame:
    """Silver without one day's rows; rerun it from `watermark_before(day)`."""
    return silver.filter(~F.col(column).eqNullSafe(F.lit(day).cast("date")))


def watermark_before(day: str) -> str:
    """The last instant before a day, so that a rerun includes rows stamped at midnight."""
    start = dt.datetime.fromisoformat(day)
    return str(start - dt.timedelta(microseconds=1))
