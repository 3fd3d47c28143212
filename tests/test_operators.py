"""Operators on hand-made rows."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimweave.operators import dimensions, gold, merge, ops, profile, quality, silver, views, warehouse
from claimweave.operators.dedup import latest_per_key
from claimweave.sources import audit, control
from claimweave.sources.tables import written
from claimweave.sources.schemas import (
    DIM_PATIENT,
    DIM_PLAN,
    DIM_PROVIDER,
    FACT_CLAIMS,
    MEMBERS,
    PROVIDERS,
    empty,
)

DAY = dt.date


def settle(df):
    """A stored copy, as tables are between the loads of a real run."""
    return written(df, "settled")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- dedup and merge ---------------------------------------------------------


def test_latest_row_is_the_same_on_every_run(spark):
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", 5, "q")]
    for shuffled in (data, data[::-1], data[2:] + data[:2]):
        df = spark.createDataFrame(shuffled, "k string, ts int, v string").repartition(3)
        assert rows(latest_per_key(df, ["k"], ["ts"]), "k", "v") == [("a", "y"), ("b", "q")]


def test_upsert_twice_equals_upsert_once(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    once = merge.upsert(target, batch, ["k"])
    assert rows(once, "k", "v") == [("a", 1), ("b", 20), ("c", 30)]
    assert rows(merge.upsert(once, batch, ["k"]), "k", "v") == rows(once, "k", "v")
    assert rows(merge.upsert(None, batch, ["k"]), "k", "v") == [("b", 20), ("c", 30)]


def test_null_key_is_merged_not_repeated(spark):
    kpi = spark.createDataFrame([(None, 1), (1, 2)], "provider_sk bigint, v int")
    assert len(rows(merge.upsert(merge.upsert(kpi, kpi, ["provider_sk"]), kpi, ["provider_sk"]), "provider_sk", "v")) == 2


def test_delete_insert_keeps_one_row_per_claim(spark):
    target = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, ts int, v int")
    batch = spark.createDataFrame([("b", 2, 5), ("b", 3, 6), ("c", 1, 7)], "k string, ts int, v int")
    result = merge.delete_insert(target, batch, ["k"], ["ts"])
    assert rows(result, "k", "v") == [("a", 1), ("b", 6), ("c", 7)]


def test_append_evolving_fills_old_rows_with_null(spark):
    old = spark.createDataFrame([("a",)], "k string")
    new = spark.createDataFrame([("b", "x")], "k string, extra string")
    assert rows(merge.append_evolving(old, new), "k", "extra") == [("a", None), ("b", "x")]


# --- silver ------------------------------------------------------------------

BRONZE = (
    "claim_id string, member_id string, claim_date string, claim_amount string, "
    "claim_status string, _ingestion_ts timestamp, _source_file string, "
    "_job_run_id string, _ingest_date date"
)


def bronze(spark, *claims):
    """Rows of (id, date, amount, second of arrival)."""
    start = dt.datetime(2024, 1, 1)
    data = [
        (i, "m", d, a, " pending ", start + dt.timedelta(seconds=s), "f.csv", "b1", DAY(2024, 1, 1))
        for i, d, a, s in claims
    ]
    return spark.createDataFrame(data, BRONZE)


def test_cleanse_keeps_every_row_on_one_side(spark):
    feed = bronze(
        spark,
        ("a", "2024-01-01", "10", 1),
        ("a", "01/02/2024", "11", 2),
        ("b", "2024-01-01", "abc", 1),
        (None, "2024-01-01", "-5", 1),
        ("c", "2099-01-01", "5", 1),
        ("d", "nonsense", "5", 1),
    )
    clean, bad = silver.cleanse(feed, "run", "2024-06-01")
    assert rows(clean, "claim_id", "claim_amount", "claim_date", "claim_status") == [
        ("a", Decimal("11.00"), DAY(2024, 1, 2), "PENDING")
    ]
    assert rows(bad, "claim_id", "_reject_reason", "_bronze_run_id", "_job_run_id") == [
        ("b", "null_amount", "b1", "run"),
        ("c", "future_claim_date", "b1", "run"),
        ("d", "null_claim_date", "b1", "run"),
        (None, "null_claim_id", "b1", "run"),
    ]


def test_absent_contract_columns_become_null(spark):
    typed = silver.typed_claims(bronze(spark, ("a", "2024-01-01", "1", 1)))
    assert rows(typed, "diagnosis_code", "admission_date") == [(None, None)]


def test_repeated_batch_adds_nothing_to_quarantine(spark):
    feed = bronze(spark, ("a", "2024-01-01", None, 1), ("a", "2024-01-01", None, 1), ("b", "x", "1", 1))
    bad = silver.cleanse(feed, "run", "2024-06-01")[1]
    nothing = bad.filter(F.lit(False))
    assert silver.unseen_quarantine(bad, nothing).count() == 3
    assert silver.unseen_quarantine(bad, bad).count() == 0


def test_watermark_is_strict(spark):
    feed = bronze(spark, ("a", "", "", 1), ("b", "", "", 2))
    assert rows(silver.newer_than(feed, "2024-01-01 00:00:01"), "claim_id") == [("b",)]


def test_replay_promotes_only_rows_silver_has_not_overtaken(spark):
    future = bronze(spark, ("a", "2024-03-01", "1", 1), ("b", "2024-03-01", "1", 1), ("c", "2025-01-01", "1", 1))
    stored = silver.cleanse(future, "run", "2024-02-01")[1]
    current = silver.cleanse(bronze(spark, ("b", "2024-01-01", "9", 5)), "run", "2024-02-01")[0]
    promoted, remaining = silver.replay_quarantine(stored, current, "2024-04-01")
    assert rows(promoted, "claim_id", "_job_run_id") == [("a", "b1")]
    assert rows(remaining, "claim_id") == [("c",)]
    assert set(promoted.columns) == set(current.columns)


def test_reprocess_drops_one_day(spark):
    claims = silver.cleanse(bronze(spark, ("a", "2024-01-01", "1", 1)), "r", "2024-02-01")[0]
    assert silver.reprocess(claims, "2024-01-01").isEmpty()
    assert silver.reprocess(claims, "2024-01-02").count() == 1
    assert silver.watermark_before("2024-01-02") == "2024-01-01 23:59:59.999999"


# --- dimensions --------------------------------------------------------------


def member(i, plan="P1", state="CA", end=None, name="N"):
    return (i, name, "F", DAY(1990, 1, 1), plan, DAY(2020, 1, 1), end, state)


def test_scd2_versions(spark):
    first = spark.createDataFrame([member("same"), member("plan"), member("end"), member("gone")], MEMBERS)
    second = spark.createDataFrame(
        [
            member("same", name="Renamed"),
            member("plan", plan="P2"),
            member("end", end=DAY(2024, 12, 31)),
            member("new"),
            member("new"),
        ],
        MEMBERS,
    )
    one = settle(dimensions.load_patients(empty(spark, DIM_PATIENT), first, "2024-01-01"))
    two = settle(dimensions.load_patients(one, second, "2024-02-01"))
    versions = dict(tuple(r) for r in two.groupBy("member_id").count().collect())
    assert versions == {"same": 1, "plan": 2, "end": 2, "gone": 1, "new": 1}
    active = two.filter("is_active").groupBy("member_id").count()
    assert active.filter("count <> 1").isEmpty() and active.count() == 5
    assert rows(two.filter("member_id = 'plan'"), "is_active", "effective_from", "effective_to") == [
        (False, DAY(2024, 1, 1), DAY(2024, 2, 1)),
        (True, DAY(2024, 2, 1), None),
    ]
    keys = [r[0] for r in two.select("patient_sk").collect()]
    assert len(set(keys)) == len(keys) and None not in keys
    again = dimensions.load_patients(two, second, "2024-02-01")
    stable = ["patient_sk", "member_id", "is_active", "effective_to"]
    assert rows(again, *stable) == rows(two, *stable)


def provider(i, city="A", network="IN_NETWORK"):
    return (i, "Dr", None, "Cardio", "H", city, "CA", network)


def test_scd1_overwrites_and_tracks_the_network(spark):
    first = spark.createDataFrame([provider("flip"), provider("move"), provider("closed")], PROVIDERS)
    dim = settle(dimensions.load_providers(empty(spark, DIM_PROVIDER), first, "2024-01-01"))
    dim = dim.withColumn("is_active", F.col("provider_id") != "closed")
    second = spark.createDataFrame(
        [
            provider("flip", network="OUT_OF_NETWORK"),
            provider("move", city="B"),
            provider("closed", city="C"),
            provider("new"),
        ],
        PROVIDERS,
    )
    result = dimensions.load_providers(dim, second, "2024-02-01")
    assert rows(result, "provider_id", "city", "network_status", "effective_from") == [
        ("closed", "A", "IN_NETWORK", DAY(2024, 1, 1)),
        ("flip", "A", "OUT_OF_NETWORK", DAY(2024, 2, 1)),
        ("move", "B", "IN_NETWORK", DAY(2024, 1, 1)),
        ("new", "A", "IN_NETWORK", DAY(2024, 2, 1)),
    ]


def test_surrogate_keys_are_unique_repeatable_and_above_the_old(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    above = F.lit(7).cast("bigint")
    one = rows(dimensions.assign_sk(ids, "k", "sk", above), "k", "sk")
    two = rows(dimensions.assign_sk(ids.repartition(7), "k", "sk", above), "k", "sk")
    assert one == two
    assert len({sk for _, sk in one}) == 5000 and min(sk for _, sk in one) > 7


def test_calendar(spark):
    days = dimensions.calendar(spark, fiscal_start_month=10, holidays=["2024-12-25"])
    assert days.count() == 9496
    row = days.filter("full_date = '2024-12-25'").first()
    assert (row.date_sk, row.month_name, row.day_name, row.day_of_week) == (20241225, "December", "Wednesday", 4)
    assert (row.is_weekend, row.is_holiday, row.fiscal_year, row.fiscal_quarter) == (False, True, 2024, 1)


# --- gold, warehouse and views -----------------------------------------------


@pytest.fixture(scope="module")
def star(spark):
    members = spark.createDataFrame([member("m1"), member("m2", plan="P2")], MEMBERS)
    doctors = spark.createDataFrame([provider("p1"), provider("p2")], PROVIDERS)
    plans = spark.createDataFrame(
        [("P1", "Plan One", "HMO", Decimal("1"), Decimal("2"), 1), ("P2", "Plan Two", "PPO", Decimal("1"), Decimal("2"), 0)],
        "plan_id string, plan_name string, plan_type string, deductible_amount decimal(10,2), oop_max decimal(10,2), is_active int",
    )
    patients = settle(dimensions.load_patients(empty(spark, DIM_PATIENT), members, "2024-01-01"))
    providers = settle(dimensions.load_providers(empty(spark, DIM_PROVIDER), doctors, "2024-01-01"))
    return patients, providers, settle(dimensions.load_plans(empty(spark, DIM_PLAN), plans))


CLAIMS = (
    "claim_id string, member_id string, provider_id string, claim_date date, "
    "admission_date date, discharge_date date, claim_amount decimal(18,2), "
    "diagnosis_code string, procedure_code string, claim_status string"
)


def claim(i, m="m1", p="p1", amount="100", status="APPROVED", day=DAY(2024, 3, 5)):
    return (i, m, p, day, DAY(2024, 3, 1), DAY(2024, 3, 4), Decimal(amount), "I10", "00810", status)


def test_fact_resolves_keys_and_keeps_claim_keys(spark, star):
    patients, providers, plans = star
    claims = [claim("a"), claim("b", m="nobody", p="nobody"), claim("c", m=None), claim("d", m="m2")]
    batch = warehouse.to_staging(
        gold.build_fact(settle(spark.createDataFrame(claims, CLAIMS)), patients, providers)
    )
    fact = settle(warehouse.load_fact(empty(spark, FACT_CLAIMS), batch, patients, providers, plans))
    unresolved = {r.claim_id: (r.patient_sk, r.provider_sk, r.plan_sk) for r in fact.collect()}
    assert all(sk > 0 for sk in unresolved["a"])
    assert unresolved["b"] == (-1, -1, -1)
    assert unresolved["c"][0] == -1 and unresolved["c"][1] > 0
    assert unresolved["d"][2] == -1, "an inactive plan does not resolve"
    first = fact.filter("claim_id = 'a'").first()
    assert (first.claim_date_sk, first.processing_days, first.procedure_code) == (20240305, 3, "00810")

    later = spark.createDataFrame([claim("a", amount="7"), claim("e"), claim("e")], CLAIMS)
    staged = warehouse.to_staging(gold.build_fact(later, patients, providers))
    twice = settle(warehouse.load_fact(fact, staged, patients, providers, plans))
    assert rows(twice, "claim_id") == [("a",), ("b",), ("c",), ("d",), ("e",)]
    replaced = twice.filter("claim_id = 'a'").first()
    assert (replaced.claim_sk, replaced.claim_amount) == (first.claim_sk, Decimal("7.00"))
    assert twice.select("claim_sk").distinct().count() == 5
    again = warehouse.load_fact(twice, staged, patients, providers, plans)
    assert rows(again, "claim_sk", "claim_id", "claim_amount") == rows(
        twice, "claim_sk", "claim_id", "claim_amount"
    )


def test_plans_keep_their_keys(spark):
    schema = "plan_id string, plan_name string, plan_type string, deductible_amount decimal(10,2), oop_max decimal(10,2), is_active int"
    first = spark.createDataFrame([(f"P{i}", "x", "HMO", None, None, 1) for i in range(40)], schema)
    dim = settle(dimensions.load_plans(empty(spark, DIM_PLAN), first))
    second = spark.createDataFrame([(f"P{i}", "y", "HMO", None, None, 1) for i in range(1, 45)], schema)
    later = {r.plan_id: r for r in dimensions.load_plans(dim, second).collect()}
    for row in dim.collect():
        assert later[row.plan_id].plan_sk == row.plan_sk
    assert len(later) == 45 and later["P0"].plan_name == "x" and later["P1"].plan_name == "y"
    assert len({r.plan_sk for r in later.values()}) == 45


def test_valid_exactly_where_no_reason_is_given(spark):
    from claimweave.functions.columns import reject_reason, valid_mask

    claims = [("a", Decimal(1), DAY(2024, 1, 1)), (None, None, None), ("a", None, DAY(2024, 1, 1)),
              ("a", Decimal(-1), None), ("a", Decimal(0), None), ("a", Decimal(0), DAY(2030, 1, 1))]
    df = spark.createDataFrame(claims, "claim_id string, claim_amount decimal(18,2), claim_date date")
    judged = df.select(reject_reason("2024-06-01").alias("why"), valid_mask("2024-06-01").alias("ok")).collect()
    assert [r.why for r in judged] == [
        None, "null_claim_id", "null_amount", "negative_amount", "null_claim_date", "future_claim_date",
    ]
    assert [r.ok for r in judged] == [True] + [False] * 5


def test_kpis_of_a_provider_without_claims_vanish(spark, star):
    patients, providers, _ = star
    fact = settle(gold.build_fact(spark.createDataFrame([claim("a"), claim("b", p="x")], CLAIMS), patients, providers))
    batch = settle(gold.build_fact(spark.createDataFrame([claim("b", p="p2")], CLAIMS), patients, providers))
    old = gold.kpi_of(fact, providers, gold.touched_providers(fact))
    touched = gold.touched_providers(batch, merge.matching(fact, batch, ["claim_id"]))
    merged = merge.upsert(fact, batch, ["claim_id"], null_safe=False)
    new = gold.kpi_replace(old, touched, gold.kpi_of(merged, providers, touched))
    assert rows(new, "provider_id", "total_claims") == [("p1", 1), ("p2", 1)]


def test_version_valid_on_the_claim_date(spark, star):
    patients, providers, plans = star
    moved = spark.createDataFrame([member("m1", plan="P9")], MEMBERS)
    history = settle(dimensions.load_patients(patients, moved, "2024-03-10"))
    claims = [claim("old", day=DAY(2024, 3, 5)), claim("new", day=DAY(2024, 3, 10)), claim("before", day=DAY(2023, 1, 1))]
    staged = warehouse.to_staging(
        gold.build_fact(settle(spark.createDataFrame(claims, CLAIMS)), history, providers)
    )
    fact = warehouse.load_fact(
        empty(spark, FACT_CLAIMS), staged, history, providers, plans, as_of_version=True
    )
    keys = {r.effective_from: r.patient_sk for r in history.filter("member_id = 'm1'").collect()}
    assert dict(tuple(r) for r in fact.select("claim_id", "patient_sk").collect()) == {
        "old": keys[DAY(2024, 1, 1)], "new": keys[DAY(2024, 3, 10)], "before": -1,
    }


def test_versions_by_interval_equal_brute_force(spark):
    """One member of very many versions among others, with gaps, claims on bounds and claims without member or date."""
    draw = random.Random(7)
    versions, key = [], 0
    for name, count in (("hot", 2000), ("a", 5), ("b", 1), ("c", 0)):
        day = DAY(2015, 1, 1)
        for i in range(count):
            start = day + dt.timedelta(draw.choice([0, 0, 3]))
            end = start + dt.timedelta(draw.choice([0, 1, 2, 40 if count < 10 else 2]))
            last = i == count - 1 and name != "b"
            key += 1
            versions.append((name, start, None if last else end, key))
            day = end
    days = [DAY(2014, 12, 1) + dt.timedelta(draw.randrange(3500)) for _ in range(1500)] + [v[1] for v in versions[::40]]
    claims = [(str(i), draw.choice(["hot", "hot", "a", "b", "c", None]), d) for i, d in enumerate(days)] + [("x", "hot", None), ("x", "hot", None)]
    patients = spark.createDataFrame(versions, "member_id string, effective_from date, effective_to date, patient_sk bigint")
    staged = spark.createDataFrame(claims, "claim_id string, member_id string, claim_date date")
    expected = []
    for claim_id, name, day in claims:
        met = [v[3] for v in versions if day and v[0] == name and v[1] <= day and (v[2] is None or day < v[2])]
        expected.append((claim_id, name, day, met[0] if met else -1))
        assert len(met) <= 1
    resolved = warehouse.resolve_patient_as_of(staged, patients)
    assert resolved.columns == ["claim_id", "member_id", "claim_date", "patient_sk"]
    assert rows(resolved, *resolved.columns) == sorted(expected, key=repr)
    assert sum(e[3] > 0 for e in expected) > 500
    nothing = warehouse.resolve_patient_as_of(staged, patients.limit(0))
    assert nothing.filter("patient_sk <> -1").isEmpty() and nothing.count() == len(claims)
    assert warehouse.resolve_patient_as_of(staged.limit(0), patients).isEmpty()
    assert not re.search(r"(Hash|Merge|Loop)Join", resolved._jdf.queryExecution().executedPlan().toString())


def test_an_as_of_load_passes_its_claims_once_and_seeks_no_current_member(spark, star):
    """Claims are read for their rows and for their days, members for their versions and for those carried on."""
    patients, providers, plans = star
    claims = settle(spark.createDataFrame([claim("a"), claim("b", day=DAY(2024, 1, 1))], CLAIMS))
    staged = settle(warehouse.to_staging(gold.build_fact(claims, patients, providers)))
    loaded = warehouse.fact_rows(staged, patients, providers, plans, as_of_version=True)
    plan = loaded._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[claim_id#", plan)) == 2, plan
    assert len(re.findall(r"Relation \[patient_sk#", plan)) == 2, plan
    assert sorted(r.claim_id for r in loaded.collect()) == ["a", "b"]


def test_provider_kpi_has_one_row_for_unknown_providers(spark, star):
    patients, providers, _ = star
    claims = [claim("a"), claim("b", status="REJECTED", amount="50"), claim("c", p="x"), claim("d", p="y")]
    enriched = gold.enrich_claims(spark.createDataFrame(claims, CLAIMS), patients, providers)
    kpi = gold.provider_kpi(enriched)
    assert rows(kpi, "provider_id", "total_claims", "total_billed", "avg_claim_amount",
                "avg_processing_days", "rejected_claims", "rejection_rate_pct") == [
        ("p1", 2, Decimal("150.00"), 75.0, 3.0, 1, 50.0),
        (None, 2, Decimal("200.00"), 100.0, 3.0, 0, 0.0),
    ]


def test_views(spark, star):
    patients, providers, plans = star
    claims = [claim("a"), claim("b", status="REJECTED"), claim("c", m="nobody"), claim("e", day=DAY(2024, 4, 1))]
    staged = warehouse.to_staging(
        gold.build_fact(settle(spark.createDataFrame(claims, CLAIMS)), patients, providers)
    )
    fact = settle(warehouse.load_fact(empty(spark, FACT_CLAIMS), staged, patients, providers, plans))
    monthly = views.monthly_claims_summary(fact, dimensions.calendar(spark))
    assert rows(monthly, "calendar_year", "month_name", "claim_status", "total_claims", "avg_turnaround") == [
        (2024, "April", "APPROVED", 1, 3.0), (2024, "March", "APPROVED", 2, 3.0), (2024, "March", "REJECTED", 1, 3.0),
    ]
    trend = views.month_over_month(monthly).filter("month_name = 'April'")
    assert rows(trend, "total_claims", "previous_claims") == [(1, 2)]
    assert rows(views.provider_performance(fact, providers), "provider_id", "rejections", "rejection_rate_pct") == [
        ("p1", 1, 25.0)
    ]
    assert rows(views.claims_by_state(fact, providers), "state", "total_claims") == [("CA", 4)]
    assert rows(views.patient_claims(fact, patients, plans), "claim_id") == [("a",), ("b",), ("e",)]
    moved = spark.createDataFrame([member("m1", state="TX", name="After")], MEMBERS)
    later = settle(dimensions.load_patients(patients, moved, "2024-05-01"))
    assert views.patient_claims(fact, later, plans).isEmpty()
    assert rows(views.patient_claims_all(fact, later, plans), "claim_id", "member_name") == [
        ("a", "After"), ("b", "After"), ("c", None), ("e", "After"),
    ]


# --- quality and operations --------------------------------------------------


def test_quality_checks(spark):
    fact = spark.createDataFrame([(1, -1, 1), (2, 3, -1), (3, -1, 1)], "patient_sk bigint, provider_sk bigint, plan_sk bigint")
    assert rows(quality.unresolved_keys(fact), "key_column", "row_count") == [("plan_sk", 1), ("provider_sk", 2)]
    dim = spark.createDataFrame([(1,)], "patient_sk bigint")
    assert quality.orphans(fact, dim, "patient_sk").first().orphan_rows == 2
    stages = quality.reconcile({"raw": fact, "silver": fact.limit(1)})
    assert rows(stages, "stage", "row_count", "delta") == [("raw", 3, None), ("silver", 1, -2)]
    spread = spark.createDataFrame([(i, 1.0) for i in range(50)] + [(50, 100.0)], "id int, v double")
    assert rows(quality.outliers(spread, "v"), "id") == [(50,)]
    partly = spark.createDataFrame([("a", None), ("b", "x"), ("c", "y")], "k string, v string")
    assert rows(quality.fill_rate(partly, ["k", "v"]), "field", "fill_pct") == [("k", 100.0), ("v", 66.67)]


def test_column_presence_flags_the_day_a_column_appears(spark):
    feed = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, "c", "x"), (3, "d", "y")], "day int, k string, extra string")
    drift = quality.column_presence(feed, "day").filter("drifted")
    assert rows(drift, "day", "column_name", "filled", "previous") == [(2, "extra", 1, 0)]


def test_expectation_gate(spark):
    df = spark.createDataFrame([(1, 5), (None, -5), (2, None)], "id int, v int")
    rules = {"id": F.col("id").isNotNull(), "positive": F.col("v") > 0}
    good, bad = quality.gate(df, rules)
    assert rows(good, "id") == [(1,)]
    assert rows(bad, "_broken_rules") == [(["id", "positive"],), (["positive"],)]
    assert rows(quality.expectation_counts(df, rules), "rule", "failures") == [("id", 1), ("positive", 2)]


def event(spark, run, status, minute, rejected=0, total=100, pipeline="p"):
    at = dt.datetime(2024, 1, 1, 1, minute)
    return audit.audit_event(spark, run, pipeline, "silver", status, total, total - rejected, rejected).withColumn(
        "event_timestamp", F.lit(at)
    )


def test_health_alerts_on_failure_or_breach(spark):
    at_limit = event(spark, "r1", "COMPLETED", 1, rejected=5)
    over = event(spark, "r2", "COMPLETED", 2, rejected=6)
    failed = event(spark, "r3", "FAILED", 3)
    skipped = event(spark, "r4", "SKIPPED", 4)
    none = event(spark, "r5", "COMPLETED", 5, total=0)

    def alert(*events):
        log = events[0]
        for e in events[1:]:
            log = log.unionByName(e)
        row = ops.health(log, "p").first()
        return row.threshold_breached, row.alert

    assert alert(at_limit) == (False, False)
    assert alert(at_limit, over) == (True, True)
    assert alert(at_limit, over, failed, skipped) == (False, True)
    assert alert(failed, none) == (False, False)


def test_run_durations_and_recent_runs(spark):
    log = event(spark, "r1", "STARTED", 1).unionByName(event(spark, "r1", "COMPLETED", 11))
    log = log.unionByName(event(spark, "r2", "STARTED", 20))
    assert rows(ops.run_durations(log), "job_run_id", "duration_sec") == [("r1", 600), ("r2", None)]
    assert [r.job_run_id for r in ops.recent_runs(log, 2).collect()] == ["r2", "r1"]


def test_audit_event_without_an_error_message(spark):
    row = audit.audit_event(spark, "r", "p", "silver", "COMPLETED").first()
    assert row.error_message is None and row.input_rows == 0 and row.event_timestamp is not None


def test_watermarks(spark):
    log = spark.createDataFrame(
        [("claims", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 5)),
         ("claims", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 6))],
        "source_name string, last_watermark timestamp, updated_at timestamp",
    )
    mark = lambda frame, s: spark.range(1).select(control.get_watermark(frame, s).alias("m")).first().m
    assert mark(log, "claims") == dt.datetime(2024, 1, 1), "a manual reset wins over an older bump"
    assert mark(log, "other") == dt.datetime(1970, 1, 1)
    moved = control.bump_watermark(log, "claims", F.lit("2024-02-01 00:00:00"))
    assert rows(moved, "last_watermark") == [(dt.datetime(2024, 2, 1),)]


def test_feed_delay(spark):
    feed = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 12, 45)), ("b", dt.datetime(2024, 1, 1, 11))], "source string, _ingestion_ts timestamp")
    expected = spark.createDataFrame([(s, dt.datetime(2024, 1, 1, 12)) for s in "abc"], "source string, expected_at timestamp")
    assert rows(ops.feed_delay(feed, expected, "source"), "source", "delay_minutes") == [("a", 45), ("b", 0), ("c", None)]


# --- profiles ----------------------------------------------------------------


def profiled_days(spark):
    """Days of very different sizes and values, one of them a third of all rows, and one NULL."""
    day = F.when(F.col("id") % 3 == 0, DAY(2024, 1, 1)).when(F.col("id") % 50 != 1, F.date_add(F.lit(DAY(2024, 1, 1)), (F.col("id") % 40).cast("int")))
    value = F.when(F.col("id") % 7 != 0, F.lit(1e9) + F.rand(3) * F.when(F.col("id") % 3 == 0, 1.0).otherwise(5.0))
    return settle(spark.range(5000).select("id", day.alias("day"), value.alias("v"), F.when(F.col("id") % 4 == 0, "x").alias("t")))


def test_profile_of_days_gives_the_full_scan_s_limit_and_rates(spark):
    df = profiled_days(spark)
    known = settle(profile.by_day(df, "day", ["v"], ["t", "id"]))
    assert known.filter("day IS NULL").count() == 3 and known.select("day").distinct().count() == 41
    # values near 1e9 that differ by units: squares of the values would lose the spread
    spread = df.agg(F.stddev_samp("v")).first()[0]
    whole = profile.combined(known.filter("column_name = 'v'"), "column_name").first()
    assert (whole.m2 / (whole.filled - 1)) ** 0.5 == pytest.approx(spread, rel=1e-6)
    assert rows(profile.outliers(df, known, "v", 1.2), "id") == rows(quality.outliers(df, "v", 1.2), "id") != []
    assert rows(profile.fill_rate(known), "field", "fill_pct") == rows(quality.fill_rate(df, ["v", "t", "id"]), "field", "fill_pct")
    assert rows(profile.presence(known, "day"), "day", "column_name", "filled", "previous", "drifted") == rows(
        quality.column_presence(df, "day"), "day", "column_name", "filled", "previous", "drifted"
    )


def test_renewed_profile_equals_a_new_one(spark):
    df = profiled_days(spark)
    old = settle(profile.by_day(df, "day", ["v"], ["t"]))
    # rows come to one day and to the unknown one, and another day loses all of its rows
    added = df.filter("id < 9").withColumn("day", F.when(F.col("id") < 5, DAY(2024, 1, 3)))
    now = settle(df.filter("day IS NULL OR day <> DATE '2024-01-05'").union(added))
    days = spark.createDataFrame([(DAY(2024, 1, 3),), (DAY(2024, 1, 5),), (None,)], "day date")
    fresh = profile.by_day(now.join(days.withColumnRenamed("day", "d"), F.col("day").eqNullSafe(F.col("d")), "left_semi"), "day", ["v"], ["t"])
    shown = ("day", "column_name", "row_count", "filled", F.round("mean", 3), F.round("m2", 3))
    assert rows(profile.renewed(old, fresh, "day", days), *shown) == rows(profile.by_day(now, "day", ["v"], ["t"]), *shown)


def test_profiles_of_nothing_of_one_value_and_of_nan(spark):
    schema = "day date, v double"
    none = profile.by_day(spark.createDataFrame([], schema), "day", ["v"])
    assert none.count() == 0 and profile.fill_rate(none).count() == 0
    one = spark.createDataFrame([(DAY(2024, 1, 1), 5.0), (DAY(2024, 1, 2), None)], schema)
    known = profile.by_day(one, "day", ["v"])
    assert rows(known, "day", "row_count", "filled", "mean", "m2") == [(DAY(2024, 1, 1), 1, 1, 5.0, 0.0), (DAY(2024, 1, 2), 1, 0, None, None)]
    assert profile.outliers(one, known, "v", 0).count() == 0, "one value has no spread"
    odd = spark.createDataFrame([(DAY(2024, 1, 1), 5.0), (DAY(2024, 1, 2), float("nan"))], schema)
    assert profile.outliers(odd, profile.by_day(odd, "day", ["v"]), "v").count() == quality.outliers(odd, "v").count() == 0


def test_expectations_come_after_the_rules_and_may_not_share_their_names(spark):
    from claimweave.functions.columns import reject_reason

    data = [("a", Decimal("1"), DAY(2024, 1, 1)), ("b", Decimal("-1"), DAY(2024, 1, 1)), ("c", Decimal("9"), DAY(2024, 1, 1))]
    df = spark.createDataFrame(data, "claim_id string, claim_amount decimal(18,2), claim_date date")
    why = reject_reason("2024-06-01", {"small": "claim_amount < 5", "never_null": "nullif(claim_id, 'a') <> 'b'"})
    assert rows(df, "claim_id", why.alias("why")) == [("a", "never_null"), ("b", "negative_amount"), ("c", "small")]
    with pytest.raises(ValueError, match="null_amount"):
        reject_reason("2024-06-01", {"null_amount": "true"})
