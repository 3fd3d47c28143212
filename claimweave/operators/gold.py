"""Gold: the enriched claims fact and the provider KPIs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.columns import (
    UNRESOLVED,
    count_where,
    pct,
    processing_days,
    risk_tier,
)
from claimweave.operators.lookup import lookup
from claimweave.operators.merge import upsert, without_keys


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter("is_active")


def enrich_claims(claims: DataFrame, patients: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims with the current member and provider attributes and the derived columns."""
    members = current_rows(patients).select(
        "member_id", F.col("patient_sk").alias("member_sk"), "insurance_plan_id"
    )
    doctors = current_rows(providers).select(
        "provider_id", "provider_sk", "specialization", "state"
    )
    enriched = lookup(claims, members, "member_id", ["claim_id"])
    enriched = lookup(enriched, doctors, "provider_id", ["claim_id"])
    return enriched.withColumns(
        {
            "processing_days": processing_days(),
            "claim_risk_tier": risk_tier(F.col("claim_amount")),
            "claim_year": F.year("claim_date"),
            "claim_month": F.month("claim_date"),
            "_gold_updated_at": F.current_timestamp(),
        }
    )


FACT_COLUMNS = [
    "claim_id",
    "member_id",
    "provider_id",
    "member_sk",
    "provider_sk",
    "claim_date",
    "claim_year",
    "claim_month",
    "admission_date",
    "discharge_date",
    "processing_days",
    "claim_amount",
    "diagnosis_code",
    "procedure_code",
    "claim_status",
    "claim_risk_tier",
    "insurance_plan_id",
    "_gold_updated_at",
]


def fact_columns(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def build_fact(claims: DataFrame, patients: DataFrame, providers: DataFrame) -> DataFrame:
    return fact_columns(enrich_claims(claims, patients, providers))


def provider_kpi(enriched: DataFrame) -> DataFrame:
    """One row per provider; claims of unknown providers share the row keyed -1."""
    known = F.col("provider_sk").isNotNull()
    keyed = enriched.withColumns(
        {
            "provider_id": F.when(known, F.col("provider_id")),
            "provider_sk": F.coalesce("provider_sk", F.lit(UNRESOLVED).cast("bigint")),
        }
    )
    kpi = keyed.groupBy("provider_sk", "provider_id", "state", "specialization").agg(
        F.count("claim_id").alias("total_claims"),
        F.sum("claim_amount").cast("decimal(18,2)").alias("total_billed"),
        F.round(F.avg("claim_amount"), 2).cast("double").alias("avg_claim_amount"),
        F.round(F.avg("processing_days"), 1).alias("avg_processing_days"),
        count_where(F.col("claim_status") == "REJECTED").alias("rejected_claims"),
    )
    return kpi.withColumns(
        {
            "rejection_rate_pct": pct(F.col("rejected_claims"), F.col("total_claims")),
            "last_refreshed": F.current_timestamp(),
        }
    )


def kpi_replace(target: DataFrame, touched: DataFrame, fresh: DataFrame) -> DataFrame:
    """KPIs with those of all `touched` providers (provider_sk) taken out and the fresh ones put in.

    A provider that has lost all its claims is touched and has no fresh row.
    """
    return without_keys(target, touched, ["provider_sk"], null_safe=True).unionByName(fresh)


def touched_providers(*changes: DataFrame) -> DataFrame:
    """The keys of the providers whose KPIs a change may move, -1 for unknown providers.

    Pass the new rows and the rows they replace: a claim that moves between
    providers changes both.
    """
    key = F.coalesce("provider_sk", F.lit(UNRESOLVED).cast("bigint")).alias("provider_sk")
    return reduce(DataFrame.union, [c.select(key) for c in changes]).distinct()


def kpi_of(fact: DataFrame, providers: DataFrame, touched: DataFrame) -> DataFrame:
    """KPIs of the touched providers from stored Gold rows, which hold the provider's key already."""
    key = F.coalesce("provider_sk", F.lit(UNRESOLVED).cast("bigint"))
    rows = fact.join(touched.select(F.col("provider_sk").alias("_touched")), key == F.col("_touched"), "left_semi")
    doctors = current_rows(providers).select("provider_sk", "specialization", "state")
    return provider_kpi(lookup(rows, doctors, "provider_sk", ["claim_id"]))


def refresh_gold(
    fact: DataFrame,
    batch: DataFrame,
    patients: DataFrame,
    providers: DataFrame,
) -> DataFrame:
    """Incremental Gold: enrich only the batch and upsert it by claim."""
    return upsert(fact, build_fact(batch, patients, providers), ["claim_id"], null_safe=False)
