"""Every registered query: the library's operators over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.functions import columns as fn
from claimweave.functions.protect import decrypt, encrypt, pseudonymise
from claimweave.operators import (
    dimensions,
    gold,
    merge,
    ops,
    profile,
    quality,
    silver,
    views,
    warehouse,
)
from claimweave.operators.dedup import latest_per_key
from claimweave.plans import driver_tables as src
from claimweave.plans import nightly, profiles, sums
from claimweave.plans.driver_tables import AS_OF, FIRST_LOAD, SPLIT
from claimweave.sources import catalog, control, tables
from claimweave.sources.schemas import (
    BRONZE_CLAIMS,
    DIM_PATIENT,
    DIM_PROVIDER,
    DIM_PLAN,
    FACT_CLAIMS,
    MALFORMED,
    RAW_CLAIM_COLUMNS,
    empty,
)
from claimweave.sources.scratch import scratch_dir
from claimweave.streaming.bronze import ingest_bronze, read_batches, read_bronze

REPLAY_AS_OF = "2001-06-01"
QUIET_AS_OF = "1997-01-01"
REPROCESSED_DAY = "1998-06-15"
AUDIT_DAY = "2024-01-25"


class Lake:
    """The layers over one data directory.

    Silver and the star schema are stored tables, as they are in a running
    lake. Each lake stores its own, so every registered query starts from the
    given tables. Everything else is lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A stored table. Its size is known, which is what joins are planned by."""
        if name not in self._tables:
            self._tables[name] = tables.written(build(), name)
        return self._tables[name]

    # Bronze and Silver

    @cached_property
    def bronze(self) -> DataFrame:
        return src.bronze_claims(self.spark, self.sf_dir)

    def store_bronze(self) -> None:
        """Keep Bronze as a stored table, for queries that read it several times: the feed's joins run once."""
        feed = self.bronze
        self.bronze = self._table("bronze", lambda: feed)

    @cached_property
    def typed(self) -> DataFrame:
        return silver.typed_claims(self.bronze)

    def cleansed(self, bronze: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        return silver.cleanse(self.bronze if bronze is None else bronze, "check", AS_OF)

    @cached_property
    def silver(self) -> DataFrame:
        return self._table("silver_claims", lambda: self.cleansed()[0])

    @cached_property
    def silver_first(self) -> DataFrame:
        return self._table("silver_first", lambda: self.cleansed(self.first_half)[0])

    @cached_property
    def silver_second(self) -> DataFrame:
        return self._table("silver_second", lambda: self.cleansed(self.second_half)[0])

    @cached_property
    def quarantined(self) -> DataFrame:
        return self.cleansed()[1]

    @cached_property
    def first_half(self) -> DataFrame:
        return self.bronze.filter(F.col("_ingest_date") < F.lit(SPLIT).cast("date"))

    @cached_property
    def second_half(self) -> DataFrame:
        return silver.newer_than(self.bronze, silver.watermark_before(SPLIT))

    # Dimensions

    def patients_after(self, loads: int) -> DataFrame:
        dim = dimensions.load_patients(
            empty(self.spark, DIM_PATIENT), src.members(self.spark, self.sf_dir), FIRST_LOAD
        )
        if loads == 1:
            return dim
        return dimensions.load_patients(dim, src.members(self.spark, self.sf_dir, True), AS_OF)

    def providers_after(self, loads: int) -> DataFrame:
        dim = dimensions.load_providers(
            empty(self.spark, DIM_PROVIDER), src.providers(self.spark, self.sf_dir), FIRST_LOAD
        )
        if loads == 1:
            return dim
        return dimensions.load_providers(dim, src.providers(self.spark, self.sf_dir, True), AS_OF)

    @cached_property
    def patients(self) -> DataFrame:
        second = src.members(self.spark, self.sf_dir, True)
        return self._table(
            "dim_patient", lambda: dimensions.load_patients(self.first_patients, second, AS_OF)
        )

    @cached_property
    def first_patients(self) -> DataFrame:
        return self._table("dim_patient_1", lambda: self.patients_after(1))

    @cached_property
    def providers(self) -> DataFrame:
        return self._table("dim_provider", lambda: self.providers_after(2))

    @cached_property
    def plans(self) -> DataFrame:
        return self._table("dim_plan", self.plans_after_two)

    def plans_after_two(self) -> DataFrame:
        nothing = empty(self.spark, DIM_PLAN)
        first = tables.written(
            dimensions.load_plans(nothing, src.plan_catalogue(self.spark, self.sf_dir, True)), "dim_plan_1"
        )
        return dimensions.load_plans(first, src.plan_catalogue(self.spark, self.sf_dir))

    @property
    def days(self) -> DataFrame:
        """The first and the last day that a claim can have."""
        orders = src.table(self.spark, self.sf_dir, "orders")
        return orders.agg(
            F.min("o_orderdate").cast("date").alias("first_day"),
            F.max("o_orderdate").cast("date").alias("last_day"),
        )

    @cached_property
    def dates(self) -> DataFrame:
        return dimensions.calendar_between(self.days)

    # Gold and warehouse

    def claims_once(self) -> DataFrame:
        """Silver for a plan that reads it once: the stored table if there is one, otherwise a part of that plan.

        Claims that are still dealt by their id, as the cleansing leaves them, are not shuffled for the fact load again.
        """
        return self._tables.get("silver_claims") or self.cleansed()[0]

    def enriched(self, claims: DataFrame | None = None) -> DataFrame:
        claims = self.silver if claims is None else claims
        return gold.enrich_claims(claims, self.patients, self.providers)

    def staged(self, claims: DataFrame | None = None) -> DataFrame:
        return warehouse.to_staging(gold.fact_columns(self.enriched(claims)))

    def loaded(self, fact: DataFrame, staged: DataFrame, **options) -> DataFrame:
        return warehouse.load_fact(
            fact, staged, self.patients, self.providers, self.plans, **options
        )

    def first_fact(self) -> DataFrame:
        """The fact load of all claims into an empty warehouse."""
        return self.loaded(empty(self.spark, FACT_CLAIMS), self.staged(self.claims_once()))

    @cached_property
    def fact(self) -> DataFrame:
        return self._table("fact_claims", self.first_fact)

    @cached_property
    def history_fact(self) -> DataFrame:
        """Facts that hold the first load's member keys, some of them expired since."""
        return self._table(
            "history_fact",
            lambda: warehouse.load_fact(
                empty(self.spark, FACT_CLAIMS),
                self.staged(self.claims_once()),
                self.first_patients,
                self.providers,
                self.plans,
            ),
        )

    # Operations

    @cached_property
    def audit(self) -> DataFrame:
        return src.audit_log(self.spark, self.sf_dir)


def without(df: DataFrame, *stamps: str) -> DataFrame:
    """Drop load stamps, which differ on every run."""
    return df.drop(*stamps)


CLAIM = [
    "claim_id",
    "member_id",
    "provider_id",
    "claim_date",
    "admission_date",
    "discharge_date",
    "claim_amount",
    "diagnosis_code",
    "procedure_code",
    "claim_status",
    "_ingestion_ts",
    "_source_file",
]


# --- Bronze and Silver -------------------------------------------------------


def claims_coerce_normalize(lake: Lake) -> DataFrame:
    return lake.typed.select(*CLAIM)


def claims_valid(lake: Lake) -> DataFrame:
    return silver.split_valid(lake.typed, fn.valid_mask(AS_OF))[0].select(*CLAIM)


def claims_quarantine(lake: Lake) -> DataFrame:
    return lake.quarantined.select(*CLAIM, "_reject_reason", "_bronze_run_id")


def quarantine_reasons(lake: Lake) -> DataFrame:
    return ops.quarantine_reasons(lake.quarantined)


def quarantine_report(lake: Lake) -> DataFrame:
    return ops.quarantine_report(lake.quarantined).drop("detected_at")


def claims_latest(lake: Lake) -> DataFrame:
    return lake.cleansed()[0].select(*CLAIM)


def silver_upsert(lake: Lake) -> DataFrame:
    batch = lake.silver_second
    return merge.upsert(lake.silver_first, batch, ["claim_id"], null_safe=False).select(*CLAIM)


def silver_clustered(lake: Lake) -> DataFrame:
    return tables.cluster_by_each(lake.silver, ["member_id", "provider_id"], "claim_id").select(*CLAIM)


def silver_merged(lake: Lake) -> DataFrame:
    """The second half merged into a catalog table of the first, by month, past its key summaries."""
    root, by = scratch_dir(lake.spark, "merged"), nightly.SILVER_PARTS
    name = f"silver_{uuid.uuid4().hex[:12]}"
    for part in (lake.silver_first, lake.silver_second):
        catalog.merge_into(nightly.by_month(part), name, root, ["claim_id"], by, cluster=nightly.CLUSTER, stored=True)
    return lake.spark.table(name).select(*CLAIM)


def incremental_since_watermark(lake: Lake) -> DataFrame:
    return silver.newer_than(lake.bronze, f"{SPLIT} 00:00:00").select(
        "claim_id", "member_id", "_ingestion_ts"
    )


def append_evolving(lake: Lake) -> DataFrame:
    return merge.append_evolving(*_evolving(lake)).select(
        "claim_id", "member_id", "referral_code", "_ingest_date"
    )


def _evolving(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """The feed before and after it gained a column."""
    return lake.first_half, lake.second_half.withColumn("referral_code", F.col("provider_id"))


def column_presence(lake: Lake) -> DataFrame:
    feed = merge.append_evolving(*_evolving(lake)).select(
        "claim_id", "claim_amount", "claim_status", "referral_code", "_ingest_date"
    )
    return quality.column_presence(feed)


def quarantine_replay(lake: Lake) -> DataFrame:
    lake.store_bronze()
    promoted, _ = silver.replay_quarantine(lake.quarantined, lake.silver, REPLAY_AS_OF)
    return merge.upsert(lake.silver, promoted, ["claim_id"], null_safe=False).select(*CLAIM)


def reprocess_day(lake: Lake) -> DataFrame:
    remaining = silver.reprocess(lake.silver, REPROCESSED_DAY)
    again = silver.newer_than(lake.bronze, silver.watermark_before(REPROCESSED_DAY))
    rerun = lake.cleansed(again)[0]
    return merge.upsert(remaining, rerun, ["claim_id"], null_safe=False).select(*CLAIM)


def bronze_stream_count(lake: Lake) -> DataFrame:
    """Events as CSV drops, streamed into Bronze and counted per day, type, run and kind of file.

    Two layouts, one compressed and in a folder whose name looks like a glob; then a third drop that
    arrives under a renewed checkpoint.
    """
    drop, land = scratch_dir(lake.spark, "drop"), scratch_dir(lake.spark, "bronze")
    events = src.table(lake.spark, lake.sf_dir, "events").select("event_id", "ts", "event_type", "value")
    part = F.col("event_id") % 3
    write = {"header": True}
    events.filter(part == 0).drop("value").write.options(**write, compression="gzip").csv(f"{drop}/1/day[1]")
    events.filter(part == 1).select("value", "event_type", "ts").write.options(**write).csv(f"{drop}/1/plain")
    events.filter(part == 2).write.options(**write).csv(f"{drop}/2")
    ingest_bronze(lake.spark, f"{drop}/1", land, f"{land}-checkpoint-1", "r1")
    ingest_bronze(lake.spark, f"{drop}/2", land, f"{land}-checkpoint-2", "r2")
    return (
        read_bronze(lake.spark, land)
        .groupBy(
            F.col("ts").cast("timestamp").cast("date").alias("day"),
            "event_type",
            "_job_run_id",
            F.endswith("_source_file", F.lit(".csv.gz")).alias("compressed"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def reference_codes(lake: Lake) -> DataFrame:
    """A code list with leading zeros, written from `part`, read back and joined to its lines."""
    path = scratch_dir(lake.spark, "codes")
    parts = src.table(lake.spark, lake.sf_dir, "part").withColumn(
        "cpt_code", F.lpad(F.col("p_size").cast("string"), 5, "0")
    )
    parts.groupBy("cpt_code").agg(
        F.max("p_name").alias("description"),
        F.max("p_type").alias("category"),
        F.max("p_retailprice").cast("decimal(10,2)").alias("avg_reimbursement"),
    ).write.option("header", True).csv(path)
    codes = tables.read_reference(lake.spark, "cpt", path)
    lines = src.table(lake.spark, lake.sf_dir, "lineitem").select("l_partkey")
    per_part = lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    per_code = (
        per_part.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("cpt_code")
        .agg(F.sum("n").alias("line_count"))
    )
    return codes.join(per_code, "cpt_code")


# --- Gold --------------------------------------------------------------------


def gold_fact(lake: Lake) -> DataFrame:
    return without(gold.fact_columns(lake.enriched()), "_gold_updated_at")


def gold_refresh(lake: Lake) -> DataFrame:
    """Gold of the first half, refreshed with the second half's claims only."""
    fact = gold.fact_columns(lake.enriched(lake.silver_first))
    fresh = gold.refresh_gold(fact, lake.silver_second, lake.patients, lake.providers)
    return without(fresh, "_gold_updated_at")


def risk_tier_counts(lake: Lake) -> DataFrame:
    tier = fn.risk_tier(F.col("claim_amount")).alias("claim_risk_tier")
    good = silver.split_valid(lake.typed, fn.valid_mask(AS_OF))[0]
    return good.groupBy(tier).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("claim_amount").cast("decimal(18,2)").alias("billed"),
    )


def provider_kpi(lake: Lake) -> DataFrame:
    """From raw claims in one plan: parse, validate, deduplicate, enrich, aggregate."""
    claims = lake.cleansed()[0]
    return without(gold.provider_kpi(lake.enriched(claims)), "last_refreshed")


def kpi_upsert(lake: Lake) -> DataFrame:
    """KPIs of the first half, then those that the second half's claims move, from stored Gold."""
    fact = lake._table("gold_first", lambda: gold.fact_columns(lake.enriched(lake.silver_first)))
    batch = lake._table("gold_batch", lambda: gold.fact_columns(lake.enriched(lake.silver_second)))
    everyone = gold.touched_providers(fact)
    touched = gold.touched_providers(batch, merge.matching(fact, batch, ["claim_id"]))
    merged = merge.upsert(fact, batch, ["claim_id"], null_safe=False)
    old = gold.kpi_of(fact, lake.providers, everyone)
    return without(
        gold.kpi_replace(old, touched, gold.kpi_of(merged, lake.providers, touched)), "last_refreshed"
    )


def _new_job(lake: Lake) -> nightly.Job:
    root = scratch_dir(lake.spark, "lake")
    database = f"nightly_{uuid.uuid4().hex[:12]}"
    lake.spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/{database}'")
    return nightly.Job(root, f"{root}/landing", database)


def _land(job: nightly.Job, night: int, drop: DataFrame) -> None:
    """All rows as CSV; those of a claim that is sent again in one night in folders of rising names."""
    resent = Window.partitionBy("claim_id").orderBy("_ingestion_ts", "provider_id", "claim_amount")
    number = F.when(F.col("claim_id").isNull(), 1).otherwise(F.row_number().over(resent))
    named = drop.select(*RAW_CLAIM_COLUMNS, F.lpad(number.cast("string"), 6, "0").alias("sent"))
    with tables.shuffles_freed(drop.sparkSession):
        named.write.options(header=True, compression="gzip").partitionBy("sent").csv(f"{job.landing}/{night}")


def _night(lake: Lake, job: nightly.Job, night: int, as_of: str = AS_OF) -> None:
    nightly.run_nightly(
        lake.spark,
        job,
        f"night_{night}",
        src.members(lake.spark, lake.sf_dir, night == 1),
        src.providers(lake.spark, lake.sf_dir, night == 1),
        src.plan_catalogue(lake.spark, lake.sf_dir, night == 0),
        as_of,
    )


def nightly_two_runs(lake: Lake) -> DataFrame:
    """KPIs after two nights of the whole chain, from CSV drops to Gold refreshed by what changed.

    All rows land, claims sent several times in one night included. On the second night providers
    appear, members and plans change, and claims of one diagnosis come again with another provider.
    """
    job = _new_job(lake)
    first, second = lake.first_half, lake.second_half
    newest = latest_per_key(first.filter("claim_id IS NOT NULL"), ["claim_id"], ["_ingestion_ts", "provider_id", "claim_amount"])
    moved = newest.filter(F.trim("diagnosis_code") == "brand#11").withColumn("provider_id", F.lit("1"))
    moved = merge.without_keys(moved, second, ["claim_id"])
    for night, drop in enumerate((first, second.unionByName(moved))):
        _land(job, night, drop)
        _night(lake, job, night)
    return without(lake.spark.table(job.table("provider_kpi")), "last_refreshed")


def quiet_night(lake: Lake) -> DataFrame:
    """The warehouse's fact after a night without files, on which a replay and changed dimensions are due.

    On the first night, at an earlier day, claims dated later are quarantined.
    """
    job = _new_job(lake)
    _land(job, 0, lake.bronze)
    _night(lake, job, 0, QUIET_AS_OF)
    nightly.replay(lake.spark, job, AS_OF)
    _night(lake, job, 1)
    fact = lake.spark.table(job.table("fact_claims"))
    return fact.select("claim_id", "patient_sk", "provider_sk", "plan_sk", "claim_date_sk", "claim_amount", "claim_status")


def malformed_rows(lake: Lake) -> DataFrame:
    """Claims as CSV with surplus fields, short records and quoted line breaks, through Bronze to their outcome.

    fields: how many a malformed record has.
    """
    values = [F.coalesce(c, F.lit("")) for c in RAW_CLAIM_COLUMNS]
    line, ends = F.col("claim_id"), F.col("provider_id")
    broken = F.concat(F.lit('"'), values[8], F.lit('\nsecond line"'))
    text = (
        F.when(line.endswith("-3") & ends.endswith("7"), F.concat_ws(",", *values, F.lit("EXTRA")))
        .when(line.endswith("-4") & ends.endswith("1"), F.concat_ws(",", *values[:6]))
        .when(line.endswith("-5"), F.concat_ws(",", *values[:8], broken, values[9]))
        .otherwise(F.concat_ws(",", *values))
    )
    files = max(4, lake.bronze.count() // 20_000)
    records = lake.bronze.select(F.pmod(F.xxhash64(*RAW_CLAIM_COLUMNS), F.lit(files)).alias("file"), F.lit(1).alias("at"), text.alias("value"))
    headers = lake.spark.range(files).select(F.col("id").alias("file"), F.lit(0).alias("at"), F.lit(",".join(RAW_CLAIM_COLUMNS)).alias("value"))
    drop, land = scratch_dir(lake.spark, "drop"), scratch_dir(lake.spark, "bronze")
    lines = records.unionByName(headers).repartition("file").sortWithinPartitions("file", "at")
    lines.drop("at").write.partitionBy("file").text(drop)
    ingest_bronze(lake.spark, drop, land, f"{land}-checkpoint", "r1")
    landed = silver.typed_claims(read_bronze(lake.spark, land, BRONZE_CLAIMS))
    whole = F.col(MALFORMED).isNull()
    return landed.select(
        "claim_id",
        "member_id",
        F.coalesce(silver.rejection(AS_OF), F.lit("valid")).alias("outcome"),
        F.when(whole, F.col("procedure_code")).alias("procedure_code"),
        F.when(~whole, F.size(F.split(MALFORMED, ","))).alias("fields"),
    )


# --- dimensions --------------------------------------------------------------


def scd2_patient(lake: Lake) -> DataFrame:
    return without(lake.patients_after(2), "_dw_inserted_at")


def scd1_provider(lake: Lake) -> DataFrame:
    return without(lake.providers_after(2), "_dw_inserted_at")


def plan_dim(lake: Lake) -> DataFrame:
    """After two catalogues: kept, changed, new and absent plans."""
    return without(lake.plans_after_two(), "_dw_inserted_at")


def calendar_dim(lake: Lake) -> DataFrame:
    """The calendar over the order dates, with a fiscal year from October and a holiday."""
    return dimensions.calendar_between(lake.days, 10, ["1998-12-25"])


def age_band_counts(lake: Lake) -> DataFrame:
    people = src.members(lake.spark, lake.sf_dir, True)
    band = fn.age_band(F.col("date_of_birth"), AS_OF).alias("age_band")
    return people.groupBy(band).agg(F.count(F.lit(1)).alias("members"))


def surrogate_keys(lake: Lake) -> DataFrame:
    """One load of all members into an empty dimension."""
    everyone = src.members(lake.spark, lake.sf_dir, True)
    dim = dimensions.load_patients(empty(lake.spark, DIM_PATIENT), everyone, FIRST_LOAD)
    return dim.select("member_id", "patient_sk")


def new_members(lake: Lake) -> DataFrame:
    first = src.members(lake.spark, lake.sf_dir)
    second = src.members(lake.spark, lake.sf_dir, True)
    return merge.new_keys(second, first, "member_id").select("member_id", "member_name", "state")


def masked_members(lake: Lake) -> DataFrame:
    people = src.members(lake.spark, lake.sf_dir, True).select("member_id", "member_name", "state")
    return pseudonymise(people, ["member_name"], F.lit("salt:"))


def encrypted_members(lake: Lake) -> DataFrame:
    """Names encrypted with a key that lies in a table, and decrypted again."""
    people = src.members(lake.spark, lake.sf_dir, True).select("member_id", "member_name", "state")
    regions = src.table(lake.spark, lake.sf_dir, "region")
    key = regions.agg(F.left(F.sha2(F.max("r_name"), 256), F.lit(32)).alias("key")).scalar()
    hidden = encrypt(people.withColumn("plain", F.col("member_name")), ["member_name"], key)
    hidden = hidden.withColumn("hidden", F.col("member_name") != F.col("plain")).drop("plain")
    return decrypt(hidden, ["member_name"], key)


def gated_claims(lake: Lake) -> DataFrame:
    """Claims that an expectation keeps out of Silver, and the expectations they break."""
    rules = {
        "has_id": F.col("claim_id").isNotNull(),
        "amount_not_negative": F.col("claim_amount") >= 0,
        "discharged_after_admission": F.col("discharge_date") >= F.col("admission_date"),
    }
    _, failing = quality.gate(lake.typed, rules)
    return failing.select("claim_id", "member_id", F.array_join("_broken_rules", ",").alias("broken"))


def expected_claims(lake: Lake) -> DataFrame:
    """Silver behind expectations, and what they and the rules reject, each row with its outcome."""
    expected = {
        "discharged_in_time": "discharge_date <= claim_date + INTERVAL 100 DAYS",
        "known_member": "member_id NOT LIKE 'X%'",
    }
    lake.store_bronze()
    clean, rejected = silver.cleanse(lake.bronze, "check", AS_OF, expected)
    shown = ("claim_id", "member_id", "_ingestion_ts")
    kept = clean.select(*shown, F.lit("silver").alias("outcome"))
    return kept.unionByName(rejected.select(*shown, F.col("_reject_reason").alias("outcome")))


def diagnosis_codes(lake: Lake) -> DataFrame:
    """A diagnosis list, written from `part` and read back by its contract."""
    path = scratch_dir(lake.spark, "codes")
    parts = src.table(lake.spark, lake.sf_dir, "part")
    code = F.lpad(F.col("p_size").cast("string"), 5, "0").alias("icd10_code")
    parts.groupBy(code).agg(
        F.max("p_name").alias("description"),
        F.max("p_type").alias("category"),
        F.max(F.col("p_size") % 2).alias("chronic_flag"),
    ).write.option("header", True).csv(path)
    return tables.read_reference(lake.spark, "icd10", path)


# --- warehouse ---------------------------------------------------------------

FACT_STAMPS = ("_dw_inserted_at", "_source_updated_at")


def staging_claims(lake: Lake) -> DataFrame:
    return without(lake.staged(), "_gold_updated_at")


def fact_load(lake: Lake) -> DataFrame:
    return without(lake.first_fact(), *FACT_STAMPS)


def fact_delete_insert(lake: Lake) -> DataFrame:
    """The second half loaded over the fact table that holds the first."""
    nothing = empty(lake.spark, FACT_CLAIMS)
    fact = lake._table(
        "first_half_fact", lambda: lake.loaded(nothing, lake.staged(lake.silver_first))
    )
    return without(lake.loaded(fact, lake.staged(lake.silver_second)), *FACT_STAMPS)


def fact_as_of_version(lake: Lake) -> DataFrame:
    fact = lake.loaded(empty(lake.spark, FACT_CLAIMS), lake.staged(), as_of_version=True)
    return fact.select("claim_id", "patient_sk", "claim_date_sk")


def watermarks(lake: Lake) -> DataFrame:
    """Control rows by event type; the row written last is the one in force."""
    events = src.table(lake.spark, lake.sf_dir, "events")
    log = events.select(
        F.col("event_type").alias("source_name"),
        F.col("ts").alias("last_watermark"),
        F.col("ts").alias("updated_at"),
    )
    return control.current_watermarks(log).select("source_name", "last_watermark")


# --- views -------------------------------------------------------------------


def monthly_summary(lake: Lake) -> DataFrame:
    return views.monthly_claims_summary(lake.fact, lake.dates)


def _fact_in_two_loads(lake: Lake) -> str:
    """A fact table with its sums, the second half merged over the first."""
    root, name = scratch_dir(lake.spark, "fact"), f"fact_{uuid.uuid4().hex[:12]}"
    first = lake.staged(lake.cleansed(lake.first_half)[0])  # read once, and so not stored
    sums.merge_fact(lake.loaded(empty(lake.spark, FACT_CLAIMS), first), name, root)
    second = warehouse.keyed_batch(
        lake.spark.table(name).drop("claim_month"), lake.staged(lake.silver_second), lake.patients, lake.providers, lake.plans
    )
    sums.merge_fact(second, name, root)
    return name


def monthly_from_sums(lake: Lake) -> DataFrame:
    """The monthly view after two loads, from sums of which the second renewed its months only."""
    return sums.monthly_claims_summary(lake.spark, _fact_in_two_loads(lake), lake.dates)


def provider_from_changes(lake: Lake) -> DataFrame:
    """The provider view after two loads, from sums, those of the rows that came and those of the rows that left."""
    fact = lake._table("first_half_fact", lambda: lake.loaded(empty(lake.spark, FACT_CLAIMS), lake.staged(lake.silver_first)))
    batch = warehouse.keyed_batch(fact, lake.staged(lake.silver_second), lake.patients, lake.providers, lake.plans)
    batch = lake._table("second_batch", lambda: batch)
    before, came, left = (views.provider_sums(f) for f in (fact, batch, merge.matching(fact, batch, ["claim_id"])))
    return views.performance_of(views.changed_sums(before, came, left, ["provider_sk", "claim_month"]), lake.providers)


def month_over_month(lake: Lake) -> DataFrame:
    return views.month_over_month(monthly_summary(lake)).drop("avg_turnaround")


def provider_performance(lake: Lake) -> DataFrame:
    return views.provider_performance(lake.fact, lake.providers)


def claims_by_state(lake: Lake) -> DataFrame:
    return views.claims_by_state(lake.fact, lake.providers)


def patient_claims(lake: Lake) -> DataFrame:
    return views.patient_claims(lake.history_fact, lake.patients, lake.plans)


def patient_claims_all(lake: Lake) -> DataFrame:
    return views.patient_claims_all(lake.history_fact, lake.patients, lake.plans)


# --- quality and operations --------------------------------------------------


def reconcile_layers(lake: Lake) -> DataFrame:
    return quality.reconcile(
        {
            "raw": src.table(lake.spark, lake.sf_dir, "lineitem"),
            "bronze": lake.bronze,
            "silver": lake.silver,
            "gold": lake.enriched(),
        }
    )


def reconcile_stored(lake: Lake) -> DataFrame:
    """The same counts from the footers of the stored layers; Silver is a catalog table by month, merged into."""
    spark, root = lake.spark, scratch_dir(lake.spark, "lake")
    lake.store_bronze()
    name = f"silver_{uuid.uuid4().hex[:12]}"
    first = lake.cleansed(lake.first_half)[0]
    catalog.publish(nightly.by_month(first), name, root, nightly.SILVER_PARTS)
    catalog.merge_into(nightly.by_month(lake.silver), name, root, ["claim_id"], nightly.SILVER_PARTS, stored=True)
    return quality.reconcile_stored(
        spark,
        {
            "raw": src.table(spark, lake.sf_dir, "lineitem"),
            "bronze": lake.bronze,
            "silver": spark.table(name),
            "gold": lake._table("gold_fact", lambda: gold.fact_columns(lake.enriched())),
        },
    )


def stream_runs(lake: Lake) -> DataFrame:
    """What each run of the stream brought to Bronze, by the rows that its micro-batches keep on themselves.

    Events arrive as CSV in two drops; stored_rows are counted in Bronze itself.
    """
    spark = lake.spark
    drop, land, state = (scratch_dir(spark, name) for name in ("drop", "bronze", "state"))
    events = src.table(spark, lake.sf_dir, "events").select("event_id", "ts", "event_type", "value")
    for run, part in (("r1", F.col("event_id") % 3 == 0), ("r2", F.col("event_id") % 3 > 0)):
        events.filter(part).write.option("header", True).csv(f"{drop}/{run}")
        ingest_bronze(spark, drop, land, state, run, batches=f"{land}_batches")
    runs = ops.stream_runs(read_batches(spark, f"{land}_batches"))
    stored = read_bronze(spark, land).groupBy("_job_run_id").agg(F.count(F.lit(1)).alias("stored_rows"))
    both = runs.join(stored, F.col("job_run_id") == F.col("_job_run_id"), "full")
    return both.select("job_run_id", "landed_rows", "stored_rows", (F.col("busy_sec") > 0).alias("timed"))


def unresolved_keys(lake: Lake) -> DataFrame:
    return quality.unresolved_keys(lake.fact)


def orphans(lake: Lake) -> DataFrame:
    return quality.orphans(lake.silver, gold.current_rows(lake.patients), "member_id")


def outliers(lake: Lake) -> DataFrame:
    events = src.table(lake.spark, lake.sf_dir, "events")
    return quality.outliers(events.select("event_id", "value"), "value")


def fill_rate(lake: Lake) -> DataFrame:
    return quality.fill_rate(
        lake.typed, ["member_id", "provider_id", "procedure_code", "claim_id", "claim_amount"]
    )


def _profile_in_two_loads(lake: Lake, table: DataFrame, numbers: tuple[str, ...], others: tuple[str, ...]) -> DataFrame:
    """The stored profile of a table whose days from SPLIT on, and the day before, came with a second load."""
    root, name = scratch_dir(lake.spark, "profile"), f"profile_{uuid.uuid4().hex[:12]}"
    split = F.lit(SPLIT).cast("date")
    second = table.filter(F.col("_ingest_date") >= split - 1)
    profiles.renew(table.filter(F.col("_ingest_date") < split), None, name, root, numbers, others)
    profiles.renew(table, second.select("_ingest_date").distinct(), name, root, numbers, others)
    return lake.spark.table(name)


def outliers_from_profile(lake: Lake) -> DataFrame:
    """Claims above mean + sigma of all days (amounts here end below 2 sigma), the limit from the profile by day after two loads."""
    known = _profile_in_two_loads(lake, lake.typed, ("claim_amount",), ())
    return profile.outliers(lake.typed, known, "claim_amount", 1).select("claim_id", "member_id", "claim_amount")


def fill_rate_from_profile(lake: Lake) -> DataFrame:
    columns = ("member_id", "provider_id", "procedure_code", "claim_id")
    return profile.fill_rate(_profile_in_two_loads(lake, lake.typed, ("claim_amount",), columns))


def presence_from_profile(lake: Lake) -> DataFrame:
    feed = merge.append_evolving(*_evolving(lake))
    known = _profile_in_two_loads(lake, feed, (), ("claim_id", "claim_amount", "claim_status", "referral_code"))
    return profile.presence(known, "_ingest_date")


def expectations(lake: Lake) -> DataFrame:
    return quality.expectation_counts(
        lake.typed,
        {
            "has_id": F.col("claim_id").isNotNull(),
            "amount_not_negative": F.col("claim_amount") >= 0,
            "dated_by_today": F.col("claim_date") <= fn.as_date(AS_OF),
            "discharged_after_admission": F.col("discharge_date") >= F.col("admission_date"),
        },
    )


def threshold_breach(lake: Lake) -> DataFrame:
    return ops.threshold_breached(lake.audit).select(
        "job_run_id",
        "event_timestamp",
        "input_rows",
        "quarantine_rows",
        "quarantine_pct",
        "threshold_breached",
    )


def recent_runs(lake: Lake) -> DataFrame:
    return ops.recent_runs(lake.audit)


def health_probe(lake: Lake) -> DataFrame:
    return ops.health(lake.audit, "job_3")


def run_durations(lake: Lake) -> DataFrame:
    return ops.run_durations(lake.audit)


def ingestion_velocity(lake: Lake) -> DataFrame:
    return ops.ingestion_velocity(src.bronze_events(lake.spark, lake.sf_dir), AUDIT_DAY, 20)


def ops_metrics(lake: Lake) -> DataFrame:
    lake.store_bronze()
    lost = quality.orphans(lake.silver, gold.current_rows(lake.patients), "member_id")
    unresolved = quality.unresolved_keys(lake.fact).select("row_count")
    return ops.ops_metrics(
        lake.bronze, lake.silver, lake.quarantined, [lost, unresolved], AS_OF, 30
    )


def feed_delay(lake: Lake) -> DataFrame:
    feed = src.bronze_events(lake.spark, lake.sf_dir)
    noon = F.date_trunc("DAY", F.max("_ingestion_ts")) + F.expr("interval 12 hours")
    expected = feed.groupBy("source").agg(noon.cast("timestamp_ntz").alias("expected_at"))
    return ops.feed_delay(feed, expected, "source")


CATALOGUE: dict[str, Callable[[Lake], DataFrame]] = {
    f.__name__: f
    for f in (
        claims_coerce_normalize,
        claims_valid,
        claims_quarantine,
        quarantine_reasons,
        quarantine_report,
        claims_latest,
        silver_upsert,
        silver_clustered,
        silver_merged,
        incremental_since_watermark,
        append_evolving,
        column_presence,
        quarantine_replay,
        reprocess_day,
        bronze_stream_count,
        reference_codes,
        gold_fact,
        gold_refresh,
        risk_tier_counts,
        provider_kpi,
        kpi_upsert,
        nightly_two_runs,
        quiet_night,
        malformed_rows,
        scd2_patient,
        scd1_provider,
        plan_dim,
        calendar_dim,
        age_band_counts,
        surrogate_keys,
        new_members,
        masked_members,
        encrypted_members,
        gated_claims,
        expected_claims,
        diagnosis_codes,
        staging_claims,
        fact_load,
        fact_delete_insert,
        fact_as_of_version,
        watermarks,
        monthly_summary,
        monthly_from_sums,
        provider_from_changes,
        month_over_month,
        provider_performance,
        claims_by_state,
        patient_claims,
        patient_claims_all,
        reconcile_layers,
        reconcile_stored,
        unresolved_keys,
        orphans,
        outliers,
        fill_rate,
        outliers_from_profile,
        fill_rate_from_profile,
        presence_from_profile,
        expectations,
        threshold_breach,
        recent_runs,
        health_probe,
        run_durations,
        stream_runs,
        ingestion_velocity,
        ops_metrics,
        feed_delay,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Lake], DataFrame]):
        return lambda spark, sf_dir: build(Lake(spark, sf_dir))

    return {name: bind(build) for name, build in CATALOGUE.items()}
