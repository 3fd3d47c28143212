"""SQL twins of the registered queries, for an independent engine.

Each statement starts from the given tables and states its result directly;
rounding is done in integers, so that both engines agree on ties.
"""

from __future__ import annotations


def _rounded(part: str, whole: str, scale: int) -> str:
    """part / whole rounded half away from zero, exactly."""
    n = f"(({part})::HUGEINT * {10**scale})"
    d = f"({whole})::HUGEINT"
    return (
        f"CASE WHEN ({whole}) = 0 THEN NULL ELSE "
        f"(CASE WHEN ({part}) < 0 THEN -1 ELSE 1 END)"
        f" * ((2 * abs({n}) + {d}) // (2 * {d})) / {10.0**scale} END"
    )


def _pct(part: str, whole: str) -> str:
    return _rounded(f"100 * ({part})", whole, 2)


def _sk(key: str, digits: int = 3, above: str = "0", scope: str = "") -> str:
    """Surrogate key: rows numbered inside MD5 buckets, buckets interleaved."""
    bucket = f"('0x' || substr(md5({key}), 1, {digits}))::BIGINT"
    place = f"row_number() OVER (PARTITION BY {bucket}{scope} ORDER BY {key})"
    return f"{above} + ({place} - 1) * {16**digits} + {bucket} + 1"


_CLAIM = (
    "claim_id, member_id, provider_id, claim_date, admission_date, discharge_date, "
    "claim_amount, diagnosis_code, procedure_code, claim_status, _ingestion_ts, _source_file"
)
_NEWEST = (
    "_ingestion_ts DESC, _source_file DESC, member_id DESC, provider_id DESC, "
    "claim_date DESC, admission_date DESC, discharge_date DESC, claim_amount DESC, "
    "diagnosis_code DESC, procedure_code DESC, claim_status DESC"
)


def _latest(rows: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY claim_id ORDER BY {_NEWEST}) AS rn FROM {rows}) WHERE rn = 1"
    )


def _newest(rows: str, first: str = "") -> str:
    """Of each claim's rows in a drop the one that lands last."""
    return (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY "
        f"{first}_ingestion_ts DESC, provider_id DESC, claim_amount::VARCHAR DESC) AS rn "
        f"FROM ({rows}) WHERE claim_id IS NOT NULL) WHERE rn = 1"
    )


_TIER = (
    "CASE WHEN claim_amount > 50000 THEN 'Critical' WHEN claim_amount > 10000 THEN 'High' "
    "WHEN claim_amount > 5000 THEN 'Medium' ELSE 'Low' END"
)


def _enriched(claims: str) -> str:
    return f"""
        SELECT c.*, m.patient_sk AS member_sk, m.insurance_plan_id, p.provider_sk,
               p.specialization, p.state,
               datediff('day', admission_date, discharge_date) AS processing_days,
               {_TIER} AS claim_risk_tier,
               year(claim_date)::INT AS claim_year, month(claim_date)::INT AS claim_month
        FROM {claims} c
        LEFT JOIN dim_patient m ON m.member_id = c.member_id AND m.is_active
        LEFT JOIN dim_provider p ON p.provider_id = c.provider_id AND p.is_active"""


def _date_sk(column: str) -> str:
    return f"strftime({column}, '%Y%m%d')::INT"


def _resolved(enriched: str, patients: str = "dim_patient") -> str:
    return f"""
        SELECT e.claim_id, e.claim_date, e.member_id,
               coalesce(m.patient_sk, -1) AS patient_sk,
               coalesce(e.provider_sk, -1) AS provider_sk, coalesce(l.plan_sk, -1) AS plan_sk,
               {_date_sk('e.claim_date')} AS claim_date_sk,
               {_date_sk('e.admission_date')} AS admission_date_sk,
               {_date_sk('e.discharge_date')} AS discharge_date_sk,
               e.diagnosis_code, e.procedure_code, e.claim_amount,
               NULL::DECIMAL(18,2) AS approved_amount, NULL::DECIMAL(18,2) AS patient_liability,
               e.claim_status, e.claim_risk_tier, e.processing_days
        FROM {enriched} e
        LEFT JOIN {patients} m ON m.member_id = e.member_id AND m.is_active
        LEFT JOIN dim_plan l ON l.plan_id = e.insurance_plan_id AND l.is_active"""


def _kpi(enriched: str) -> str:
    rejected = "count(*) FILTER (claim_status = 'REJECTED')"
    return f"""
        SELECT coalesce(provider_sk, -1) AS provider_sk,
               CASE WHEN provider_sk IS NOT NULL THEN provider_id END AS provider_id,
               state, specialization, count(claim_id) AS total_claims,
               sum(claim_amount)::DECIMAL(18,2) AS total_billed,
               {_rounded('sum((claim_amount * 100)::BIGINT)', 'count(*) * 100', 2)}
                   AS avg_claim_amount,
               {_rounded('sum(processing_days)', 'count(processing_days)', 1)}
                   AS avg_processing_days,
               {rejected} AS rejected_claims,
               {_pct(rejected, 'count(claim_id)')} AS rejection_rate_pct
        FROM {enriched} GROUP BY 1, 2, 3, 4"""


def _members(second: bool) -> str:
    plan, policy_end, subset = "c_mktsegment", "NULL::DATE", "WHERE c_acctbal >= 0"
    if second:
        plan = "CASE WHEN c_custkey % 10 = 0 THEN 'BUILDING' ELSE c_mktsegment END"
        policy_end = "CASE WHEN c_custkey % 10 = 1 THEN DATE '2002-12-31' END"
        subset = ""
    return f"""
        SELECT c_custkey::VARCHAR AS member_id, c_name AS member_name,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_custkey % 13 <> 0
                    THEN make_date((1930 + c_custkey % 80)::INT, 1, 1) END AS date_of_birth,
               {plan} AS insurance_plan_id, DATE '1995-01-01' AS policy_start_date,
               {policy_end} AS policy_end_date, n_name AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        {subset}"""


def _providers(second: bool) -> str:
    network, city, subset = "s_suppkey % 2", "'City ' || s_suppkey % 10", "WHERE s_acctbal >= 0"
    if second:
        network = "CASE WHEN s_suppkey % 5 = 0 THEN 1 - s_suppkey % 2 ELSE s_suppkey % 2 END"
        city = "CASE WHEN s_suppkey % 3 = 0 THEN 'Moved' ELSE 'City ' || s_suppkey % 10 END"
        subset = ""
    return f"""
        SELECT s_suppkey::VARCHAR AS provider_id, s_name AS provider_name,
               CASE WHEN s_suppkey % 4 <> 0
                    THEN CASE WHEN length(s_suppkey::VARCHAR) < 10
                              THEN lpad(s_suppkey::VARCHAR, 10, '1')
                              ELSE left(s_suppkey::VARCHAR, 10) END END AS npi_number,
               'Specialty ' || s_suppkey % 6 AS specialization,
               'Hospital ' || s_suppkey % 9 AS hospital_name, {city} AS city, n_name AS state,
               CASE WHEN {network} = 0 THEN 'IN_NETWORK' ELSE 'OUT_OF_NETWORK' END
                   AS network_status
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        {subset}"""


def _plans(segment: str, subset: str) -> str:
    return f"""
        SELECT plan_id, 'Plan ' || upper(plan_id[1]) || lower(plan_id[2:]) AS plan_name,
               CASE WHEN length(plan_id) % 2 = 0 THEN 'HMO' ELSE 'PPO' END AS plan_type,
               count(*)::DECIMAL(10,2) AS deductible_amount,
               (count(*) * 2)::DECIMAL(10,2) AS oop_max, plan_id <> 'MACHINERY' AS is_active
        FROM (SELECT {segment} AS plan_id FROM customer WHERE {subset}) GROUP BY plan_id"""


def _band(as_of: str) -> str:
    age = f"year(DATE '{as_of}') - year(date_of_birth)"
    return (
        f"CASE WHEN date_of_birth IS NULL THEN NULL WHEN {age} < 18 THEN 'Under 18' "
        f"WHEN {age} < 36 THEN '18-35' WHEN {age} < 56 THEN '36-55' ELSE '55+' END"
    )


_VERSION = (
    "member_id, member_name, gender, date_of_birth, age_band, state, insurance_plan_id, "
    "policy_start_date, policy_end_date"
)
_DOCTOR = (
    "provider_name, npi_number, specialization, hospital_name, city, state, network_status"
)
_AMOUNT = "l_extendedprice::DECIMAL(18,2)"


def _reason(as_of: str) -> str:
    return (
        "CASE WHEN claim_id IS NULL THEN 'null_claim_id' "
        "WHEN claim_amount IS NULL THEN 'null_amount' "
        "WHEN claim_amount < 0 THEN 'negative_amount' "
        "WHEN claim_date IS NULL THEN 'null_claim_date' "
        f"WHEN claim_date > DATE '{as_of}' THEN 'future_claim_date' END"
    )


# Named steps, in dependency order; a statement may use any of them.
_STEPS = {
    "typed": f"""
        SELECT CASE WHEN l_quantity <> 1 THEN l_orderkey || '-' || l_linenumber END AS claim_id,
               CASE WHEN l_quantity = 50 THEN 'X' || o_custkey ELSE o_custkey::VARCHAR END AS member_id,
               CASE WHEN l_quantity = 49 THEN 'X' || l_suppkey ELSE l_suppkey::VARCHAR END
                   AS provider_id,
               o_orderdate::DATE AS claim_date, o_orderdate::DATE AS admission_date,
               l_shipdate::DATE AS discharge_date,
               CASE WHEN l_discount = 0.1 THEN NULL WHEN l_tax = 0.08 THEN -{_AMOUNT}
                    ELSE {_AMOUNT} END AS claim_amount,
               upper(p_brand) AS diagnosis_code, upper(p_type) AS procedure_code,
               CASE l_returnflag WHEN 'R' THEN 'REJECTED' WHEN 'A' THEN 'APPROVED'
                    ELSE 'PENDING' END AS claim_status,
               l_shipdate AS _ingestion_ts,
               'claims_' || lower(l_linestatus) || '.csv' AS _source_file
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "judged": f"SELECT *, {_reason('2001-01-01')} AS _reject_reason FROM typed",
    "good": "SELECT * EXCLUDE (_reject_reason) FROM judged WHERE _reject_reason IS NULL",
    "bad": "SELECT * FROM judged WHERE _reject_reason IS NOT NULL",
    "good_1": "SELECT * FROM good WHERE _ingestion_ts < TIMESTAMP '1999-01-01'",
    "good_2": "SELECT * FROM good WHERE _ingestion_ts >= TIMESTAMP '1999-01-01'",
    "silver": _latest("good"),
    "silver_1": _latest("good_1"),
    "silver_2": _latest("good_2"),
    "silver_12": """
        SELECT * FROM silver_2 UNION ALL
        SELECT * FROM silver_1 WHERE claim_id NOT IN (SELECT claim_id FROM silver_2)""",
    "sent_1": "SELECT * FROM judged WHERE _ingestion_ts < TIMESTAMP '1999-01-01'",
    "sent_2": "SELECT * FROM judged WHERE _ingestion_ts >= TIMESTAMP '1999-01-01'",
    "newest_1": _newest("SELECT * FROM sent_1"),
    "night_2": """
        SELECT * FROM sent_2 UNION ALL
        SELECT * REPLACE ('1' AS provider_id) FROM newest_1
        WHERE diagnosis_code = 'BRAND#11'
          AND claim_id NOT IN (SELECT claim_id FROM sent_2 WHERE claim_id IS NOT NULL)""",
    "valid_1": _newest("SELECT * FROM sent_1 WHERE _reject_reason IS NULL"),
    "valid_2": _newest("SELECT * FROM night_2 WHERE _reject_reason IS NULL"),
    "silver_n": """
        SELECT * FROM valid_2 UNION ALL SELECT * FROM valid_1
        WHERE claim_id NOT IN (SELECT claim_id FROM valid_2)""",
    "silver_q": _newest("SELECT * FROM good", "claim_date <= DATE '1997-01-01' DESC, "),
    "members_1": _members(False),
    "members_2": _members(True),
    "patient_1": f"""
        SELECT {_sk('member_id')} AS patient_sk, *, {_band('2000-01-01')} AS age_band
        FROM members_1""",
    "moved": """
        SELECT o.member_id FROM patient_1 o JOIN members_2 n ON o.member_id = n.member_id
        WHERE o.insurance_plan_id IS DISTINCT FROM n.insurance_plan_id
           OR o.state IS DISTINCT FROM n.state
           OR o.policy_end_date IS DISTINCT FROM n.policy_end_date""",
    "dim_patient": f"""
        SELECT patient_sk, {_VERSION},
               member_id NOT IN (SELECT member_id FROM moved) AS is_active,
               DATE '2000-01-01' AS effective_from,
               CASE WHEN member_id IN (SELECT member_id FROM moved)
                    THEN DATE '2001-01-01' END AS effective_to
        FROM patient_1
        UNION ALL
        SELECT {_sk('member_id', above='(SELECT max(patient_sk) FROM patient_1)')}, {_VERSION},
               true, DATE '2001-01-01', NULL
        FROM (SELECT *, {_band('2001-01-01')} AS age_band FROM members_2
              WHERE member_id IN (SELECT member_id FROM moved)
                 OR member_id NOT IN (SELECT member_id FROM patient_1))""",
    "dim_patient_1": f"""
        SELECT patient_sk, {_VERSION}, true AS is_active FROM patient_1""",
    "providers_1": _providers(False),
    "providers_2": _providers(True),
    "provider_1": f"SELECT {_sk('provider_id')} AS provider_sk, * FROM providers_1",
    "dim_provider": f"""
        SELECT o.provider_sk, n.*, true AS is_active,
               CASE WHEN o.network_status IS DISTINCT FROM n.network_status
                    THEN DATE '2001-01-01' ELSE DATE '2000-01-01' END AS effective_from,
               NULL::DATE AS effective_to
        FROM provider_1 o JOIN providers_2 n ON o.provider_id = n.provider_id
        UNION ALL
        SELECT {_sk('provider_id', above='(SELECT max(provider_sk) FROM provider_1)')}, *,
               true, DATE '2001-01-01', NULL
        FROM providers_2 WHERE provider_id NOT IN (SELECT provider_id FROM provider_1)""",
    "plans_1": _plans("CASE c_mktsegment WHEN 'BUILDING' THEN 'LEGACY' ELSE c_mktsegment END", "c_acctbal >= 0"),
    "plans_2": _plans("c_mktsegment", "true"),
    "plan_1": f"SELECT {_sk('plan_id')} AS plan_sk, * FROM plans_1",
    "dim_plan": f"""
        SELECT o.plan_sk, n.* FROM plan_1 o JOIN plans_2 n ON o.plan_id = n.plan_id
        UNION ALL SELECT * FROM plan_1 WHERE plan_id NOT IN (SELECT plan_id FROM plans_2)
        UNION ALL
        SELECT {_sk('plan_id', above='(SELECT max(plan_sk) FROM plan_1)')}, * FROM plans_2
        WHERE plan_id NOT IN (SELECT plan_id FROM plan_1)""",
    "enriched": _enriched("silver"),
    "enriched_1": _enriched("silver_1"),
    "enriched_2": _enriched("silver_2"),
    "enriched_12": _enriched("silver_12"),
    "enriched_n": _enriched("silver_n"),
    "enriched_q": _enriched("silver_q"),
    "resolved": _resolved("enriched"),
    "resolved_12": _resolved("enriched_12"),
    "fact": f"SELECT {_sk('claim_id', 5)} AS claim_sk, * EXCLUDE (claim_date, member_id) FROM resolved",
    "history_fact": f"""
        SELECT claim_id, patient_sk, plan_sk, claim_date_sk, claim_amount, claim_status,
               claim_risk_tier
        FROM ({_resolved('enriched', 'dim_patient_1')})""",
    "audit": """
        SELECT user_id || '-' || ts::DATE AS job_run_id, 'job_' || user_id % 5 AS pipeline_name,
               CASE user_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS layer,
               CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'view' THEN 'COMPLETED'
                    WHEN 'click' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED'
                    ELSE 'SKIPPED' END AS status,
               100 + event_id % 900 AS input_rows,
               100 + event_id % 900 - event_id % 60 AS output_rows,
               event_id % 60 AS quarantine_rows,
               CASE WHEN event_type = 'error' THEN props END AS error_message,
               ts AS event_timestamp
        FROM events""",
}

_GOLD = (
    "claim_id, member_id, provider_id, member_sk, provider_sk, claim_date, claim_year, "
    "claim_month, admission_date, discharge_date, processing_days, claim_amount, "
    "diagnosis_code, procedure_code, claim_status, claim_risk_tier, insurance_plan_id"
)
_FACT = (
    "claim_sk, claim_id, patient_sk, provider_sk, plan_sk, claim_date_sk, admission_date_sk, "
    "discharge_date_sk, diagnosis_code, procedure_code, claim_amount, approved_amount, "
    "patient_liability, claim_status, claim_risk_tier, processing_days"
)
_HISTORY = (
    "member_id, member_name, age_band, plan_name, claim_id, claim_date_sk, claim_amount, "
    "claim_status, claim_risk_tier"
)
_BREACH = "coalesce(quarantine_rows * 100 > 5 * nullif(input_rows, 0), false)"
_MONTHLY = """
    SELECT claim_date_sk // 10000 AS calendar_year, claim_date_sk // 100 % 100 AS calendar_month,
           monthname(make_date(claim_date_sk // 10000, claim_date_sk // 100 % 100, 1))
               AS month_name,
           claim_status, count(claim_id) AS total_claims,
           sum(claim_amount)::DECIMAL(18,2) AS billed_amt, avg(processing_days) AS avg_turnaround
    FROM fact GROUP BY ALL"""


def _performance(by: str) -> str:
    rejected = "count(*) FILTER (claim_status = 'REJECTED')"
    return f"""
        SELECT {by}, count(claim_id) AS total_claims,
               sum(claim_amount)::DECIMAL(18,2) AS total_billed, {rejected} AS rejections,
               {_pct(rejected, 'count(claim_id)')} AS rejection_rate_pct
        FROM fact f JOIN dim_provider p ON p.provider_sk = f.provider_sk AND p.is_active
        GROUP BY {by}"""


def _filled(column: str, rows: str = "typed") -> str:
    return (
        f"SELECT '{column}' AS field, {_pct(f'count({column})', 'count(*)')} AS fill_pct "
        f"FROM {rows}"
    )


def _broken(rule: str, condition: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, count(*) FILTER (NOT coalesce({condition}, false)) AS failures "
        "FROM typed"
    )


def _unresolved(column: str) -> str:
    return (
        f"SELECT '{column}' AS key_column, count(*) AS row_count FROM fact "
        f"WHERE {column} = -1 HAVING count(*) > 0"
    )


def _presence() -> str:
    columns = ["claim_id", "claim_amount", "claim_status", "referral_code"]
    feed = (
        "(SELECT *, CASE WHEN _ingestion_ts >= TIMESTAMP '1999-01-01' THEN provider_id END "
        "AS referral_code FROM typed)"
    )
    counted = " UNION ALL ".join(
        f"SELECT discharge_date AS _ingest_date, '{c}' AS column_name, count({c}) AS filled "
        f"FROM {feed} GROUP BY 1"
        for c in columns
    )
    before = "lag(filled) OVER (PARTITION BY column_name ORDER BY _ingest_date)"
    return f"""
        SELECT *, coalesce((previous = 0) <> (filled = 0), false) AS drifted
        FROM (SELECT *, {before} AS previous FROM ({counted}))"""


_RECONCILE = """
    SELECT *, row_count - lag(row_count) OVER (ORDER BY stage_no) AS delta FROM (
        SELECT 1 AS stage_no, 'raw' AS stage, count(*) AS row_count FROM lineitem UNION ALL
        SELECT 2, 'bronze', count(*) FROM typed UNION ALL
        SELECT 3, 'silver', count(*) FROM silver UNION ALL
        SELECT 4, 'gold', count(*) FROM enriched)"""

_ORPHANS = (
    "SELECT count(*) AS orphan_rows FROM silver WHERE NOT EXISTS (SELECT 1 FROM dim_patient d "
    "WHERE d.is_active AND d.member_id = silver.member_id)"
)

_STATEMENTS = {
    "claims_coerce_normalize": f"SELECT {_CLAIM} FROM typed",
    "claims_valid": f"SELECT {_CLAIM} FROM good",
    "claims_quarantine": f"SELECT {_CLAIM}, _reject_reason, 'seed' AS _bronze_run_id FROM bad",
    "quarantine_reasons": "SELECT _reject_reason, count(*) AS row_count FROM bad GROUP BY 1",
    "quarantine_report": "SELECT claim_id, _reject_reason FROM bad",
    "claims_latest": f"SELECT {_CLAIM} FROM silver",
    "silver_upsert": f"SELECT {_CLAIM} FROM silver_12",
    "silver_merged": f"SELECT {_CLAIM} FROM silver_12",
    "silver_clustered": f"SELECT {_CLAIM} FROM silver",
    "incremental_since_watermark": """
        SELECT claim_id, member_id, _ingestion_ts FROM typed
        WHERE _ingestion_ts > TIMESTAMP '1999-01-01'""",
    "append_evolving": """
        SELECT claim_id, member_id,
               CASE WHEN _ingestion_ts >= TIMESTAMP '1999-01-01' THEN provider_id END
                   AS referral_code,
               discharge_date AS _ingest_date
        FROM typed""",
    "column_presence": _presence(),
    # Claims dated between the two as-of days pass on replay; per claim the newest
    # ingested row wins, Silver's on a tie.
    "quarantine_replay": f"""
        SELECT {_CLAIM} FROM (
            SELECT *, row_number() OVER (PARTITION BY claim_id
                       ORDER BY _ingestion_ts DESC, held DESC, {_NEWEST}) AS place
            FROM (SELECT *, 0 AS held FROM typed
                  WHERE claim_id IS NOT NULL AND claim_amount >= 0
                    AND claim_date > DATE '2001-01-01' AND claim_date <= DATE '2001-06-01'
                  UNION ALL SELECT *, 1 FROM silver))
        WHERE place = 1""",
    # Dropping a day and rerunning it restores Silver.
    "reprocess_day": f"SELECT {_CLAIM} FROM silver",
    "bronze_stream_count": """
        SELECT ts::DATE AS day, event_type,
               CASE WHEN event_id % 3 = 2 THEN 'r2' ELSE 'r1' END AS _job_run_id,
               event_id % 3 = 0 AS compressed, count(*) AS row_count
        FROM events GROUP BY 1, 2, 3, 4""",
    "reference_codes": """
        SELECT lpad(p_size::VARCHAR, 5, '0') AS cpt_code, max(p_name) AS description,
               max(p_type) AS category, max(p_retailprice)::DECIMAL(10,2) AS avg_reimbursement,
               (SELECT count(*) FROM lineitem JOIN part q ON l_partkey = q.p_partkey
                WHERE q.p_size = part.p_size) AS line_count
        FROM part GROUP BY p_size HAVING line_count > 0""",
    "gold_fact": f"SELECT {_GOLD} FROM enriched",
    "gold_refresh": f"SELECT {_GOLD} FROM enriched_12",
    "risk_tier_counts": f"""
        SELECT {_TIER} AS claim_risk_tier, count(*) AS row_count,
               sum(claim_amount)::DECIMAL(18,2) AS billed
        FROM good GROUP BY 1""",
    "provider_kpi": _kpi("enriched"),
    "kpi_upsert": f"""
        SELECT * FROM ({_kpi('enriched_12')})""",
    "nightly_two_runs": _kpi("enriched_n"),
    "quiet_night": f"""
        SELECT claim_id, patient_sk, provider_sk, plan_sk, claim_date_sk, claim_amount, claim_status
        FROM ({_resolved('enriched_q')})""",
    "malformed_rows": """
        SELECT claim_id, member_id,
               CASE WHEN kind IS NOT NULL THEN 'malformed' ELSE coalesce(_reject_reason, 'valid') END AS outcome,
               CASE WHEN kind IS NULL THEN
                    procedure_code || CASE WHEN claim_id LIKE '%-5' THEN chr(10) || 'SECOND LINE' ELSE '' END
               END AS procedure_code,
               kind AS fields
        FROM (SELECT *, CASE WHEN claim_id LIKE '%-3' AND provider_id LIKE '%7' THEN 11
                             WHEN claim_id LIKE '%-4' AND provider_id LIKE '%1' THEN 6 END AS kind FROM judged)""",
    "scd2_patient": "SELECT * FROM dim_patient",
    "scd1_provider": "SELECT * FROM dim_provider",
    "plan_dim": "SELECT * FROM dim_plan",
    "calendar_dim": """
        SELECT strftime(d, '%Y%m%d')::INT AS date_sk, d::DATE AS full_date,
               year(d)::INT AS calendar_year, month(d)::INT AS calendar_month,
               monthname(d) AS month_name, quarter(d)::INT AS calendar_quarter,
               day(d)::INT AS day_of_month, (dayofweek(d) + 1)::INT AS day_of_week,
               dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
               d = DATE '1998-12-25' AS is_holiday,
               year(d - INTERVAL 9 MONTH)::INT AS fiscal_year,
               quarter(d - INTERVAL 9 MONTH)::INT AS fiscal_quarter
        FROM (SELECT unnest(generate_series(
                  (SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
                  INTERVAL 1 DAY)) AS d)""",
    "age_band_counts": f"""
        SELECT {_band('2001-01-01')} AS age_band, count(*) AS members FROM members_2 GROUP BY 1""",
    "surrogate_keys": f"SELECT member_id, {_sk('member_id')} AS patient_sk FROM members_2",
    "new_members": """
        SELECT member_id, member_name, state FROM members_2
        WHERE member_id NOT IN (SELECT member_id FROM members_1)""",
    "masked_members": """
        SELECT member_id, sha256('salt:' || member_name) AS member_name, state FROM members_2""",
    "encrypted_members": """
        SELECT member_id, member_name, state, true AS hidden FROM members_2""",
    "gated_claims": """
        SELECT claim_id, member_id, broken FROM (
            SELECT claim_id, member_id, concat_ws(',',
                CASE WHEN claim_id IS NULL THEN 'has_id' END,
                CASE WHEN NOT coalesce(claim_amount >= 0, false) THEN 'amount_not_negative' END,
                CASE WHEN NOT coalesce(discharge_date >= admission_date, false)
                     THEN 'discharged_after_admission' END) AS broken
            FROM typed) WHERE broken <> ''""",
    "expected_claims": f"""
        WITH told AS (
            SELECT *, coalesce(_reject_reason,
                CASE WHEN NOT coalesce(discharge_date <= claim_date + INTERVAL 100 DAY, false)
                     THEN 'discharged_in_time'
                     WHEN NOT coalesce(member_id NOT LIKE 'X%', false) THEN 'known_member' END) AS why
            FROM judged)
        SELECT claim_id, member_id, _ingestion_ts, 'silver' AS outcome FROM (
            {_latest("told WHERE why IS NULL")})
        UNION ALL SELECT claim_id, member_id, _ingestion_ts, why FROM told WHERE why IS NOT NULL""",
    "diagnosis_codes": """
        SELECT lpad(p_size::VARCHAR, 5, '0') AS icd10_code, max(p_name) AS description,
               max(p_type) AS category, max(p_size % 2)::INT AS chronic_flag FROM part GROUP BY p_size""",
    "staging_claims": """
        SELECT claim_id, member_id, provider_id, claim_date, admission_date, discharge_date,
               processing_days, claim_amount, diagnosis_code, procedure_code, claim_status,
               claim_risk_tier, insurance_plan_id
        FROM enriched""",
    "fact_load": f"SELECT {_FACT} FROM fact",
    "fact_delete_insert": f"""
        WITH fact_1 AS (
            SELECT {_sk('claim_id', 5)} AS claim_sk, * FROM ({_resolved('enriched_1')})),
        batch AS (
            SELECT coalesce(f.claim_sk,
                       {_sk('b.claim_id', 5, '(SELECT max(claim_sk) FROM fact_1)',
                            ', f.claim_sk IS NULL')}) AS claim_sk, b.*
            FROM ({_resolved('enriched_2')}) b LEFT JOIN fact_1 f ON f.claim_id = b.claim_id)
        SELECT {_FACT} FROM batch UNION ALL
        SELECT {_FACT} FROM fact_1 WHERE claim_id NOT IN (SELECT claim_id FROM batch)""",
    "fact_as_of_version": """
        SELECT claim_id,
               coalesce((SELECT max(d.patient_sk) FROM dim_patient d
                         WHERE d.member_id = r.member_id AND d.effective_from <= r.claim_date
                           AND (d.effective_to IS NULL OR r.claim_date < d.effective_to)), -1)
                   AS patient_sk,
               claim_date_sk
        FROM resolved r""",
    "watermarks": """
        SELECT event_type AS source_name, max(ts) AS last_watermark FROM events GROUP BY 1""",
    "monthly_summary": _MONTHLY,
    "monthly_from_sums": _MONTHLY.replace("FROM fact", "FROM resolved_12"),
    "provider_from_changes": _performance(
        "p.provider_id, p.provider_name, p.specialization, p.state"
    ).replace("FROM fact f", "FROM resolved_12 f"),
    "month_over_month": f"""
        WITH m AS ({_MONTHLY})
        SELECT m.* EXCLUDE (avg_turnaround), p.total_claims AS previous_claims,
               p.billed_amt AS previous_billed
        FROM m LEFT JOIN m p ON p.claim_status = m.claim_status
         AND p.calendar_year * 12 + p.calendar_month
             = m.calendar_year * 12 + m.calendar_month - 1""",
    "provider_performance": _performance(
        "p.provider_id, p.provider_name, p.specialization, p.state"
    ),
    "claims_by_state": _performance("p.state"),
    "patient_claims": f"""
        SELECT {_HISTORY} FROM history_fact f
        JOIN dim_patient d ON d.patient_sk = f.patient_sk AND d.is_active
        JOIN dim_plan l ON l.plan_sk = f.plan_sk""",
    "patient_claims_all": f"""
        SELECT d.member_id, c.member_name, c.age_band, l.plan_name, f.claim_id, f.claim_date_sk,
               f.claim_amount, f.claim_status, f.claim_risk_tier
        FROM history_fact f
        LEFT JOIN dim_patient d ON d.patient_sk = f.patient_sk
        LEFT JOIN dim_patient c ON c.member_id = d.member_id AND c.is_active
        LEFT JOIN dim_plan l ON l.plan_sk = f.plan_sk""",
    "reconcile_layers": _RECONCILE,
    "reconcile_stored": _RECONCILE,
    "unresolved_keys": " UNION ALL ".join(
        _unresolved(c) for c in ("patient_sk", "provider_sk", "plan_sk")
    ),
    "orphans": _ORPHANS,
    "outliers": """
        SELECT event_id, value FROM events
        WHERE value > (SELECT avg(value) + 3 * stddev_samp(value) FROM events)""",
    "fill_rate": " UNION ALL ".join(
        _filled(c)
        for c in ("member_id", "provider_id", "procedure_code", "claim_id", "claim_amount")
    ),
    "outliers_from_profile": """
        SELECT claim_id, member_id, claim_amount FROM typed WHERE claim_amount::DOUBLE > (
            SELECT avg(claim_amount::DOUBLE) + stddev_samp(claim_amount::DOUBLE) FROM typed)""",
    "fill_rate_from_profile": " UNION ALL ".join(
        _filled(c)
        for c in ("member_id", "provider_id", "procedure_code", "claim_id", "claim_amount")
    ),
    "presence_from_profile": _presence(),
    "expectations": " UNION ALL ".join(
        (
            _broken("has_id", "claim_id IS NOT NULL"),
            _broken("amount_not_negative", "claim_amount >= 0"),
            _broken("dated_by_today", "claim_date <= DATE '2001-01-01'"),
            _broken("discharged_after_admission", "discharge_date >= admission_date"),
        )
    ),
    "threshold_breach": f"""
        SELECT job_run_id, event_timestamp, input_rows, quarantine_rows,
               {_pct('quarantine_rows', 'input_rows')} AS quarantine_pct,
               {_BREACH} AS threshold_breached
        FROM audit""",
    "recent_runs": "SELECT * FROM audit ORDER BY event_timestamp DESC, job_run_id DESC LIMIT 10",
    "health_probe": f"""
        SELECT pipeline_name, status, input_rows, output_rows, quarantine_rows, event_timestamp,
               {_BREACH} AS threshold_breached, status = 'FAILED' OR {_BREACH} AS alert
        FROM audit WHERE pipeline_name = 'job_3' AND status IN ('COMPLETED', 'FAILED')
        ORDER BY event_timestamp DESC, job_run_id DESC LIMIT 1""",
    "run_durations": """
        SELECT *, date_sub('second', started_at, finished_at) AS duration_sec FROM (
            SELECT job_run_id, layer,
                   min(event_timestamp) FILTER (status = 'STARTED') AS started_at,
                   max(event_timestamp) FILTER (status = 'COMPLETED') AS finished_at
            FROM audit GROUP BY 1, 2)""",
    "ingestion_velocity": """
        SELECT ts::DATE AS _ingest_date, count(*) AS row_count FROM events
        WHERE ts::DATE > DATE '2024-01-25' - 20 AND ts::DATE <= DATE '2024-01-25' GROUP BY 1""",
    "stream_runs": """
        SELECT CASE WHEN event_id % 3 = 0 THEN 'r1' ELSE 'r2' END AS job_run_id,
               count(*) AS landed_rows, count(*) AS stored_rows, true AS timed
        FROM events GROUP BY 1""",
    "ops_metrics": f"""
        SELECT (SELECT count(*) FROM typed WHERE discharge_date > DATE '2001-01-01' - 30
                AND discharge_date <= DATE '2001-01-01') AS throughput_30d,
               {_pct('(SELECT count(*) FROM silver)', '(SELECT count(*) FROM typed)')}
                   AS accuracy_pct,
               (SELECT count(*) FROM bad b WHERE NOT EXISTS (SELECT 1 FROM silver s
                WHERE s.claim_id = b.claim_id AND s._ingestion_ts >= b._ingestion_ts)) AS quarantine_backlog,
               (({_ORPHANS})
                + (SELECT count(*) FROM fact WHERE patient_sk = -1)
                + (SELECT count(*) FROM fact WHERE provider_sk = -1)
                + (SELECT count(*) FROM fact WHERE plan_sk = -1))::BIGINT AS recon_anomalies,
               (SELECT max(_ingestion_ts) FROM typed) AS last_sync""",
    "feed_delay": """
        SELECT event_type AS source, date_trunc('day', max(ts)) + INTERVAL 12 HOUR AS expected_at,
               max(ts) AS last_arrival,
               greatest(0, date_sub('minute', date_trunc('day', max(ts)) + INTERVAL 12 HOUR,
                                    max(ts))) AS delay_minutes
        FROM events GROUP BY 1""",
}


def _used(text: str) -> list[str]:
    """Names of the steps a text refers to."""
    words = set(
        "".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split()
    )
    return [name for name in _STEPS if name in words]


def _with_steps(statement: str) -> str:
    needed, queue = set(), _used(statement)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += _used(_STEPS[name])
    steps = ", ".join(f"{n} AS ({body})" for n, body in _STEPS.items() if n in needed)
    return f"WITH {steps} SELECT * FROM ({statement})" if steps else statement


def oracle_sql() -> dict[str, str]:
    return {name: _with_steps(sql) for name, sql in _STATEMENTS.items()}
