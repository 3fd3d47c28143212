"""Warehouse: staging contract, key resolution and the fact load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions.columns import UNRESOLVED, date_sk
from claimweave.operators.dedup import latest_per_key
from claimweave.operators.dimensions import assign_sk, highest_key
from claimweave.operators.gold import current_rows
from claimweave.operators.lookup import SALTS, lookup
from claimweave.operators.merge import matching, without_keys
from claimweave.sources.schemas import FACT_CLAIMS, STAGED_CLAIMS, conform

CLAIM_KEY_DIGITS = 5  # about a million buckets when numbering claims


def to_staging(gold: DataFrame) -> DataFrame:
    """Gold rows in the shape of the claims staging contract."""
    return conform(gold, STAGED_CLAIMS)


def _or_unresolved(sk: str) -> Column:
    return F.coalesce(F.col(sk), F.lit(UNRESOLVED).cast("bigint"))


def resolve_keys(
    staged: DataFrame, patients: DataFrame | None, providers: DataFrame, plans: DataFrame
) -> DataFrame:
    """Add the three current surrogate keys, -1 where the natural key is unknown.

    Without `patients` the member's key is left out, for `resolve_patient_as_of` to add.
    """
    rows = staged
    if patients is not None:
        members = current_rows(patients).select("member_id", "patient_sk")
        rows = lookup(rows, members, "member_id", ["claim_id"])
    rows = lookup(
        rows,
        current_rows(providers).select("provider_id", "provider_sk"),
        "provider_id",
        ["claim_id"],
    )
    known_plans = current_rows(plans).select(F.col("plan_id").alias("insurance_plan_id"), "plan_sk")
    rows = lookup(rows, known_plans, "insurance_plan_id", ["claim_id"])
    found = (["patient_sk"] if patients is not None else []) + ["provider_sk", "plan_sk"]
    return rows.withColumns({c: _or_unresolved(c) for c in found})


def _versions_by_month(patients: DataFrame) -> DataFrame:
    """Each version of a member at the day on which it begins; versions that hold on no day are left out."""
    holds = F.col("effective_to").isNull() | (F.col("effective_from") < F.col("effective_to"))
    return patients.filter(F.col("member_id").isNotNull() & F.col("effective_from").isNotNull() & holds).select(
        "member_id",
        F.trunc("effective_from", "month").alias("_month"),
        F.col("effective_from").alias("_day"),
        F.lit(1).alias("_kind"),
        F.struct("effective_to", "patient_sk").alias("_version"),
    )


def _carried(days: DataFrame, versions: DataFrame) -> DataFrame:
    """For each member and month of `days` or `versions`, the last version that began in an earlier month."""
    newest = F.max_by("_version", "_day").alias("_newest")
    ends = versions.groupBy("member_id", "_month").agg(newest)
    months = ends.unionByName(days.select("member_id", F.trunc("claim_date", "month").alias("_month")).distinct(), True)
    months = months.groupBy("member_id", "_month").agg(F.first("_newest", ignorenulls=True).alias("_newest"))
    earlier = Window.partitionBy("member_id").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last("_newest", ignorenulls=True).over(earlier)
    return months.select("member_id", "_month", F.col("_month").alias("_day"), F.lit(0).alias("_kind"), carried.alias("_version"))


def resolve_patient_as_of(staged: DataFrame, patients: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Attach the member version that was valid on the claim date instead of the current one.

    The versions of a member don't overlap; a claim dated before the first of them, or without
    member or date, stays unresolved. Versions and claims are sorted together once, by member and
    month, and each claim takes the version last met, so a claim is not held against every version of
    its member. The version in force as a month begins comes from a frame of one row for each
    member and month, so that a member with very many claims is spread over the months. Claims without
    member or date pass with the others, spread by their id. `days`, where given, holds at least the members and dates of `staged` and is cheaper to read.
    """
    dated = F.col("member_id").isNotNull() & F.col("claim_date").isNotNull()
    versions = _versions_by_month(patients)
    spread = F.pmod(F.xxhash64("claim_id"), F.lit(SALTS)).cast("int")
    claims = staged.withColumns(
        {
            "_month": F.trunc("claim_date", "month"),
            "_day": F.col("claim_date"),
            "_kind": F.lit(2),
            "_salt": F.when(dated, F.lit(0)).otherwise(spread),
        }
    )
    met = versions.unionByName(_carried((staged if days is None else days).filter(dated), versions))
    passed = Window.partitionBy("member_id", "_month", "_salt").orderBy("_day", "_kind")
    passed = passed.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = claims.unionByName(met.withColumn("_salt", F.lit(0)), True)
    seen = seen.withColumn("_version", F.last("_version", ignorenulls=True).over(passed))
    until = F.col("_version.effective_to")
    valid = until.isNull() | (F.col("claim_date") < until)
    found = seen.filter("_kind = 2").withColumn("patient_sk", F.when(valid, F.col("_version.patient_sk")))
    rows = found.select(*staged.columns, "patient_sk")
    return rows.withColumn("patient_sk", _or_unresolved("patient_sk"))


def fact_rows(
    staged: DataFrame,
    patients: DataFrame,
    providers: DataFrame,
    plans: DataFrame,
    as_of_version: bool = False,
) -> DataFrame:
    """Staged claims as fact rows, still without their claim keys."""
    batch = latest_per_key(staged, ["claim_id"], ["_gold_updated_at"])
    rows = resolve_keys(batch, None if as_of_version else patients, providers, plans)
    if as_of_version:
        rows = resolve_patient_as_of(rows, patients, staged)
    stamps = {
        "claim_date_sk": date_sk(F.col("claim_date")),
        "admission_date_sk": date_sk(F.col("admission_date")),
        "discharge_date_sk": date_sk(F.col("discharge_date")),
        "_dw_inserted_at": F.current_timestamp(),
        "_source_updated_at": F.col("_gold_updated_at"),
    }
    return conform(rows, FACT_CLAIMS, stamps)


def keyed_batch(
    fact: DataFrame,
    staged: DataFrame,
    patients: DataFrame,
    providers: DataFrame,
    plans: DataFrame,
    as_of_version: bool = False,
) -> DataFrame:
    """Staged claims as complete fact rows.

    A claim the fact already holds keeps its `claim_sk`; new claims are
    numbered above the highest key in use.
    """
    rows = fact_rows(staged, patients, providers, plans, as_of_version).drop("claim_sk")
    known = matching(fact.select("claim_id", "claim_sk"), staged, ["claim_id"])
    keyed = assign_sk(
        rows.join(known, "claim_id", "left"),
        "claim_id",
        "claim_sk",
        highest_key(fact, "claim_sk"),
        CLAIM_KEY_DIGITS,
        keep=True,
    )
    return keyed.select(*FACT_CLAIMS.fieldNames())


def load_fact(
    fact: DataFrame,
    staged: DataFrame,
    patients: DataFrame,
    providers: DataFrame,
    plans: DataFrame,
    as_of_version: bool = False,
) -> DataFrame:
    """Delete the claims named by the batch and insert their resolved rows.

    Loading a batch twice changes nothing.
    """
    batch = keyed_batch(fact, staged, patients, providers, plans, as_of_version)
    return without_keys(fact, staged, ["claim_id"]).unionByName(batch)
