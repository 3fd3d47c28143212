"""Fixed schemas of the claims lakehouse.

Surrogate keys are bigint, so that dimensions of any size fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "decimal(10,2)": DecimalType(10, 2),
    "decimal(18,2)": DecimalType(18, 2),
}


def _schema(columns: str) -> StructType:
    """Schema from "name type, ..."; unlike `StructType.fromDDL` it needs no session."""
    pairs = (column.split(" ") for column in columns.split(", "))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_CLAIM_COLUMNS = [
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
]

MALFORMED = "_malformed"  # a record's text where it doesn't fit its file's header

LINEAGE_COLUMNS = ["_ingestion_ts", "_source_file", "_job_run_id", "_ingest_date"]

BRONZE_CLAIMS = _schema(
    ", ".join(f"{c} string" for c in RAW_CLAIM_COLUMNS)
    + ", _ingestion_ts timestamp, _source_file string, _job_run_id string, _ingest_date date, _malformed string"
)

QUARANTINE = _schema(
    "claim_id string, member_id string, provider_id string, claim_date date, admission_date date, "
    "discharge_date date, claim_amount decimal(18,2), diagnosis_code string, procedure_code string, "
    "claim_status string, _ingestion_ts timestamp, _source_file string, _job_run_id string, _reject_reason string, "
    "_bronze_run_id string, _quarantine_ts timestamp, _row_digest string, _malformed string, _ingest_date date"
)

MEMBERS = _schema(
    "member_id string, member_name string, gender string, date_of_birth date, "
    "insurance_plan_id string, policy_start_date date, policy_end_date date, state string"
)

PROVIDERS = _schema(
    "provider_id string, provider_name string, npi_number string, specialization string, "
    "hospital_name string, city string, state string, network_status string"
)

STAGED_CLAIMS = _schema(
    "claim_id string, member_id string, provider_id string, claim_date date, "
    "admission_date date, discharge_date date, processing_days int, "
    "claim_amount decimal(18,2), diagnosis_code string, procedure_code string, "
    "claim_status string, claim_risk_tier string, insurance_plan_id string, "
    "_gold_updated_at timestamp"
)

DIM_PATIENT = _schema(
    "patient_sk bigint, member_id string, member_name string, gender string, "
    "date_of_birth date, age_band string, state string, insurance_plan_id string, "
    "policy_start_date date, policy_end_date date, is_active boolean, "
    "effective_from date, effective_to date, _dw_inserted_at timestamp"
)

DIM_PROVIDER = _schema(
    "provider_sk bigint, provider_id string, provider_name string, npi_number string, "
    "specialization string, hospital_name string, city string, state string, "
    "network_status string, is_active boolean, effective_from date, effective_to date, "
    "_dw_inserted_at timestamp"
)

DIM_PLAN = _schema(
    "plan_sk bigint, plan_id string, plan_name string, plan_type string, "
    "deductible_amount decimal(10,2), oop_max decimal(10,2), is_active boolean, "
    "_dw_inserted_at timestamp"
)

FACT_CLAIMS = _schema(
    "claim_sk bigint, claim_id string, patient_sk bigint, provider_sk bigint, "
    "plan_sk bigint, claim_date_sk int, admission_date_sk int, discharge_date_sk int, "
    "diagnosis_code string, procedure_code string, claim_amount decimal(18,2), "
    "approved_amount decimal(18,2), patient_liability decimal(18,2), claim_status string, "
    "claim_risk_tier string, processing_days int, _dw_inserted_at timestamp, "
    "_source_updated_at timestamp"
)

AUDIT_LOG = _schema(
    "job_run_id string, pipeline_name string, layer string, status string, "
    "input_rows bigint, output_rows bigint, quarantine_rows bigint, "
    "error_message string, event_timestamp timestamp"
)

BATCHES = _schema(
    "job_run_id string, files bigint, input_bytes bigint, landed_rows bigint, started_at timestamp, finished_at timestamp"
)

CONTROL = _schema("source_name string, last_watermark timestamp, updated_at timestamp")

# Code lists are read as text so that codes keep their leading zeros.
ICD10 = _schema("icd10_code string, description string, category string, chronic_flag int")
CPT = _schema(
    "cpt_code string, description string, category string, avg_reimbursement decimal(10,2)"
)
PLANS = _schema(
    "plan_id string, plan_name string, plan_type string, deductible_amount decimal(10,2), "
    "oop_max decimal(10,2), is_active int"
)


def conform(df: DataFrame, schema: StructType, stamps: dict[str, Column] | None = None):
    """Select the schema's columns in order, cast; absent ones become `stamps` or NULL."""
    stamps = stamps or {}

    def column(field):
        if field.name in stamps:
            value = stamps[field.name]
        elif field.name in df.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*(column(f) for f in schema.fields))


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A frame with no rows that the optimizer knows to be empty."""
    return conform(spark.range(1).filter(F.lit(False)), schema)
