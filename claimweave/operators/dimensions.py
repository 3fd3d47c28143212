"""Dimensions: slowly changing members and providers, plans, calendar, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimweave.functions.columns import AsOf, age_band, any_changed, as_date, date_sk
from claimweave.operators.dedup import latest_per_key
from claimweave.operators import merge
from claimweave.operators.merge import new_keys
from claimweave.sources.schemas import DIM_PATIENT, DIM_PLAN, DIM_PROVIDER, conform

# --- surrogate keys ----------------------------------------------------------


def highest_key(dim: DataFrame, sk: str) -> Column:
    """The largest key in use, or 0, as a scalar subquery."""
    return dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint").alias(sk)).scalar()


def assign_sk(
    rows: DataFrame, key: str, sk: str, above: Column, digits: int = 3, keep: bool = False
) -> DataFrame:
    """Give each row (unique `key`) a surrogate key greater than `above`.

    Rows are numbered inside 16 ** digits buckets of the key's MD5 and the
    buckets are interleaved, so keys are unique and repeatable and no task sees
    more than one bucket at a time. With `keep`, rows that have a key keep it.
    """
    buckets = 16**digits
    bucket = F.conv(F.substring(F.md5(key), 1, digits), 16, 10).cast("bigint")
    rows = rows.withColumn("_bucket", bucket)
    scope = ["_bucket"]
    if keep:
        rows = rows.withColumn("_keyed", F.col(sk).isNotNull())
        scope.append("_keyed")
    place = F.row_number().over(Window.partitionBy(*scope).orderBy(key))
    fresh = above + (place.cast("bigint") - 1) * buckets + F.col("_bucket") + 1
    value = F.coalesce(F.col(sk), fresh) if keep else fresh
    return rows.withColumn(sk, value).drop("_bucket", "_keyed")


# --- type 2: members ---------------------------------------------------------

PATIENT_TRACKED = ["insurance_plan_id", "state", "policy_end_date"]


def scd2_load(
    dim: DataFrame,
    source: DataFrame,
    key: str,
    tracked: list[str],
    sk: str,
    schema: StructType,
    as_of: AsOf = None,
    derive: dict[str, Column] | None = None,
) -> DataFrame:
    """Close the current versions that changed, add new versions and new members.

    A closed version ends on the day its successor starts. The source is
    reduced to one row per key first; ties are broken by its own columns.
    """
    day = as_date(as_of)
    source = latest_per_key(source, [key], [])
    active, history = dim.filter("is_active"), dim.filter("NOT is_active")

    pair = active.alias("cur").join(
        source.select(key, *tracked).alias("src"), F.col(f"cur.{key}") == F.col(f"src.{key}"), "left"
    )
    changed = F.col(f"src.{key}").isNotNull() & any_changed(tracked, "cur", "src")
    judged = pair.select("cur.*", changed.alias("_changed"))
    closed = judged.withColumns(
        {
            "is_active": ~F.col("_changed"),
            "effective_to": F.when(F.col("_changed"), day).otherwise(F.col("effective_to")),
        }
    ).drop("_changed")

    still_current = judged.filter("NOT _changed").select(key)
    fresh = source.join(still_current, key, "left_anti").withColumns(derive or {})
    stamps = {
        "is_active": F.lit(True),
        "effective_from": day,
        "effective_to": F.lit(None),
        "_dw_inserted_at": F.current_timestamp(),
    }
    added = assign_sk(conform(fresh, schema, stamps), key, sk, highest_key(dim, sk))
    return history.unionByName(closed).unionByName(added)


def load_patients(dim: DataFrame, members: DataFrame, as_of: AsOf = None) -> DataFrame:
    bands = {"age_band": age_band(F.col("date_of_birth"), as_of)}
    return scd2_load(
        dim, members, "member_id", PATIENT_TRACKED, "patient_sk", DIM_PATIENT, as_of, bands
    )


# --- type 1: providers -------------------------------------------------------

PROVIDER_ATTRIBUTES = [
    "provider_name",
    "npi_number",
    "specialization",
    "hospital_name",
    "city",
    "state",
    "network_status",
]


def scd1_load(
    dim: DataFrame,
    source: DataFrame,
    key: str,
    attributes: list[str],
    sk: str,
    schema: StructType,
    track_from: str,
    as_of: AsOf = None,
) -> DataFrame:
    """Overwrite active rows from the source; `effective_from` moves when `track_from` changed.

    Inactive rows are left alone, and a key the dimension holds in any state is
    not inserted again.
    """
    day = as_date(as_of)
    source = latest_per_key(source, [key], [])
    incoming = source.select(
        F.col(key).alias("_key"), *(F.col(c).alias(f"_new_{c}") for c in attributes)
    )
    paired = dim.join(incoming, (F.col(key) == F.col("_key")) & F.col("is_active"), "left")
    hit = F.col("_key").isNotNull()
    moved = hit & ~F.col(track_from).eqNullSafe(F.col(f"_new_{track_from}"))
    updated = paired.select(
        *(
            F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in attributes
            else F.when(moved, day).otherwise(F.col(c)).alias(c)
            if c == "effective_from"
            else F.when(hit, F.current_timestamp()).otherwise(F.col(c)).alias(c)
            if c == "_dw_inserted_at"
            else F.col(c)
            for c in dim.columns
        )
    )
    stamps = {
        "is_active": F.lit(True),
        "effective_from": day,
        "effective_to": F.lit(None),
        "_dw_inserted_at": F.current_timestamp(),
    }
    fresh = conform(new_keys(source, dim, key), schema, stamps)
    added = assign_sk(fresh, key, sk, highest_key(dim, sk))
    return updated.unionByName(added)


def load_providers(dim: DataFrame, providers: DataFrame, as_of: AsOf = None) -> DataFrame:
    return scd1_load(
        dim,
        providers,
        "provider_id",
        PROVIDER_ATTRIBUTES,
        "provider_sk",
        DIM_PROVIDER,
        "network_status",
        as_of,
    )


# --- plans and calendar ------------------------------------------------------


def load_plans(dim: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The plan dimension after a catalogue: plans keep their keys, and plans that it lacks stay.

    Attributes are overwritten. A new plan is numbered above the highest key. Inactive plans stay,
    flagged.
    """
    plans = conform(latest_per_key(catalogue, ["plan_id"], []), DIM_PLAN)
    held = dim.select("plan_id", F.col("plan_sk").alias("_sk"))
    listed = plans.drop("plan_sk").join(held, "plan_id", "left").withColumnRenamed("_sk", "plan_sk")
    absent = merge.without_keys(dim, plans, ["plan_id"])
    keyed = assign_sk(listed, "plan_id", "plan_sk", highest_key(dim, "plan_sk"), keep=True)
    stamps = {"_dw_inserted_at": F.current_timestamp()}
    return conform(keyed, DIM_PLAN, stamps).unionByName(absent)


def calendar(
    spark: SparkSession,
    start: str = "2010-01-01",
    end: str = "2035-12-31",
    fiscal_start_month: int = 1,
    holidays: list[str] | None = None,
) -> DataFrame:
    """One row per day. The fiscal year is named after the year it starts in."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return calendar_between(bounds, fiscal_start_month, holidays)


def calendar_between(
    bounds: DataFrame, fiscal_start_month: int = 1, holidays: list[str] | None = None
) -> DataFrame:
    """Calendar over a one-row frame of `first_day` and `last_day`."""
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date")
    )
    day = F.col("full_date")
    fiscal = F.add_months(day, 1 - fiscal_start_month)
    closed = day.isin([F.lit(h).cast("date") for h in holidays]) if holidays else F.lit(False)
    return days.select(
        date_sk(day).alias("date_sk"),
        day,
        F.year(day).alias("calendar_year"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("calendar_quarter"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        closed.alias("is_holiday"),
        F.year(fiscal).alias("fiscal_year"),
        F.quarter(fiscal).alias("fiscal_quarter"),
    )
