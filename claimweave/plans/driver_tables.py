"""Claims, members, providers and audit events derived from the given tables.

Orders and their lines play the claims, customers the members, suppliers the
providers and events the audit log. Defects (missing ids and amounts, negative
amounts, dates ahead of `AS_OF`, mixed date formats, padded codes, resent
claims) come from column values, so every rule of the library meets data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-01-01"
FIRST_LOAD = "2000-01-01"
SPLIT = "1999-01-01"  # ingestion date that separates the first load from the second


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(day: str) -> Column:
    return F.col(day).cast("date").cast("string")


def _text_date(iso: Column) -> Column:
    """Even line numbers send month/day/year, odd ones ISO."""
    slashed = F.concat(
        F.substring(iso, 6, 2), F.lit("/"), F.substring(iso, 9, 2), F.lit("/"), F.left(iso, F.lit(4))
    )
    return F.when(F.col("l_linenumber") % 2 == 0, slashed).otherwise(iso)


def bronze_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims feed as Bronze stores it: text columns plus lineage."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", _iso("o_orderdate").alias("_ordered"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    # Two tables that grow together: both are shuffled, whatever their size, and AQE splits an
    # order that holds too many lines. Each task hashes its orders, so no line is sorted.
    feed = lines.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    # Each day is written out once, that of an order once for all its lines.
    feed = feed.withColumn("_shipped", _iso("l_shipdate"))
    feed = feed.withColumns({c: _text_date(F.col(c)) for c in ("_ordered", "_shipped")})
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    return feed.select(
        F.when(
            F.col("l_quantity") != 1, F.concat_ws("-", "l_orderkey", "l_linenumber")
        ).alias("claim_id"),
        # claims with a mistyped id, which no member or provider has
        F.when(F.col("l_quantity") == 50, F.concat(F.lit("X"), "o_custkey"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("member_id"),
        F.when(F.col("l_quantity") == 49, F.concat(F.lit("X"), "l_suppkey"))
        .otherwise(F.col("l_suppkey").cast("string"))
        .alias("provider_id"),
        F.col("_ordered").alias("claim_date"),
        F.col("_ordered").alias("admission_date"),
        F.col("_shipped").alias("discharge_date"),
        F.when(F.col("l_discount") == 0.1, None)
        .when(F.col("l_tax") == 0.08, -amount)
        .otherwise(amount)
        .cast("string")
        .alias("claim_amount"),
        F.concat(F.lit(" "), F.lower("p_brand")).alias("diagnosis_code"),
        F.lower("p_type").alias("procedure_code"),
        F.when(F.col("l_returnflag") == "R", " rejected ")
        .when(F.col("l_returnflag") == "A", "approved")
        .otherwise("Pending")
        .alias("claim_status"),
        F.col("l_shipdate").alias("_ingestion_ts"),
        F.concat(F.lit("claims_"), F.lower("l_linestatus"), F.lit(".csv")).alias("_source_file"),
        F.lit("seed").alias("_job_run_id"),
        F.col("l_shipdate").cast("date").alias("_ingest_date"),
    )


def members(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """Members of the first load, or all of them with the second load's changes."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    people = (
        table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    plan, policy_end = F.col("c_mktsegment"), F.lit(None).cast("date")
    if second:
        plan = F.when(key % 10 == 0, "BUILDING").otherwise(plan)
        policy_end = F.when(key % 10 == 1, F.lit("2002-12-31").cast("date"))
    else:  # members whose balance is negative joined later
        people = people.filter(F.col("c_acctbal") >= 0)
    born = F.make_date((F.lit(1930) + key % 80).cast("int"), F.lit(1), F.lit(1))
    return people.select(
        key.cast("string").alias("member_id"),
        F.col("c_name").alias("member_name"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(key % 13 != 0, born).alias("date_of_birth"),
        plan.alias("insurance_plan_id"),
        F.lit("1995-01-01").cast("date").alias("policy_start_date"),
        policy_end.alias("policy_end_date"),
        F.col("n_name").alias("state"),
    )


def providers(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("s_suppkey")
    doctors = (
        table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    network = key % 2
    city = F.concat(F.lit("City "), (key % 10).cast("string"))
    if second:
        network = F.when(key % 5 == 0, 1 - network).otherwise(network)
        city = F.when(key % 3 == 0, "Moved").otherwise(city)
    else:  # providers whose balance is negative joined later
        doctors = doctors.filter(F.col("s_acctbal") >= 0)
    return doctors.select(
        key.cast("string").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.when(key % 4 != 0, F.lpad(key.cast("string"), 10, "1")).alias("npi_number"),
        F.concat(F.lit("Specialty "), (key % 6).cast("string")).alias("specialization"),
        F.concat(F.lit("Hospital "), (key % 9).cast("string")).alias("hospital_name"),
        city.alias("city"),
        F.col("n_name").alias("state"),
        F.when(network == 0, "IN_NETWORK").otherwise("OUT_OF_NETWORK").alias("network_status"),
    )


def plan_catalogue(spark: SparkSession, sf_dir: str, first: bool = False) -> DataFrame:
    """One plan per market segment; the plan named MACHINERY is inactive.

    The first catalogue lacks BUILDING, has a plan LEGACY that the second one
    lacks, and counts members of the first load only.
    """
    customers = table(spark, sf_dir, "customer")
    if first:
        renamed = F.when(F.col("c_mktsegment") == "BUILDING", "LEGACY").otherwise(F.col("c_mktsegment"))
        customers = customers.filter(F.col("c_acctbal") >= 0).withColumn("c_mktsegment", renamed)
    segments = customers.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return segments.select(
        F.col("c_mktsegment").alias("plan_id"),
        F.concat(F.lit("Plan "), F.initcap("c_mktsegment")).alias("plan_name"),
        F.when(F.length("c_mktsegment") % 2 == 0, "HMO").otherwise("PPO").alias("plan_type"),
        F.col("n").cast("decimal(10,2)").alias("deductible_amount"),
        (F.col("n") * 2).cast("decimal(10,2)").alias("oop_max"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 0).otherwise(1).alias("is_active"),
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    rejected = event % 60
    arrived = 100 + event % 900
    status = (
        F.when(F.col("event_type") == "signup", "STARTED")
        .when(F.col("event_type").isin("view", "click"), "COMPLETED")
        .when(F.col("event_type") == "error", "FAILED")
        .otherwise("SKIPPED")
    )
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("ts").cast("date")).alias(
            "job_run_id"
        ),
        F.concat(F.lit("job_"), (F.col("user_id") % 5).cast("string")).alias("pipeline_name"),
        F.element_at(
            F.array(F.lit("bronze"), F.lit("silver"), F.lit("gold")),
            (F.col("user_id") % 3 + 1).cast("int"),
        ).alias("layer"),
        status.alias("status"),
        arrived.alias("input_rows"),
        (arrived - rejected).alias("output_rows"),
        rejected.alias("quarantine_rows"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.col("ts").alias("event_timestamp"),
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a feed by day and source."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("source"),
        "value",
        F.col("ts").alias("_ingestion_ts"),
        F.col("ts").cast("date").alias("_ingest_date"),
    )
