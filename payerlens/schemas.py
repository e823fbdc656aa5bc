"""Column lists, table schemas and the fixed domain values of the claims model."""

from __future__ import annotations

from pyspark.sql import types as T

# Money is carried as an exact decimal: sums do not depend on the order in which
# partitions arrive. Query results leave as double.
MONEY = T.DecimalType(18, 2)

# --- fixed values: the claims model -----------------------------------------
PROVIDER_TYPES = ["hospital", "physician_office", "pharmacy", "lab", "urgent_care", "specialist"]
PLAN_TYPES = ["HMO", "PPO", "EPO", "Medicare Advantage", "Medicaid MCO"]
AGE_BANDS = ["0-17", "18-34", "35-49", "50-64", "65-79", "80+"]
STATES = ["CA", "TX", "NY", "FL", "PA", "OH", "GA", "NC", "MI", "AZ"]
DIAGNOSIS_CATEGORIES = [
    "diabetes", "hypertension", "cardiovascular_disease", "respiratory_illness",
    "musculoskeletal", "mental_health", "oncology", "maternity", "injury_trauma",
    "preventive_care", "infectious_disease", "chronic_kidney_disease",
]
PROCEDURE_CATEGORIES = [
    "office_visit", "diagnostic_imaging", "lab_panel", "surgical_procedure",
    "physical_therapy", "emergency_treatment", "inpatient_stay", "prescription_fill",
    "specialist_consult", "preventive_screening",
]
DENIAL_REASONS = [
    "prior_authorization_missing", "not_medically_necessary", "out_of_network",
    "duplicate_claim", "coverage_terminated", "incomplete_documentation",
    "non_covered_service",
]
CLAIM_STATUSES = ["paid", "partially_paid", "denied"]
# The 18 columns of a claim with their types, in the order of the feed.
CLAIM_COLUMNS = [
    ("claim_id", "string"), ("member_id", "string"), ("provider_id", "string"),
    ("provider_type", "string"), ("plan_type", "string"), ("member_age_band", "string"),
    ("member_state", "string"), ("claim_type", "string"), ("diagnosis_category", "string"),
    ("procedure_category", "string"), ("service_date", "date"), ("submission_date", "date"),
    ("billed_amount", "money"), ("allowed_amount", "money"), ("paid_amount", "money"),
    ("claim_status", "string"), ("denial_reason", "string"),
    ("is_readmission_within_30d", "boolean"),
]
# The six aggregate tables, in column order.
AGGREGATE_DDL = {
    "agg_monthly_spend":
        "service_month string, plan_type string, total_paid double, total_billed double, "
        "claim_count bigint, distinct_members bigint",
    "agg_diagnosis_cost":
        "diagnosis_category string, total_paid double, avg_paid_per_claim double, "
        "claim_count bigint",
    "agg_denial_by_provider_type":
        "provider_type string, total_claims bigint, denied_claims bigint, denial_rate double",
    "agg_denial_by_reason":
        "denial_reason string, denied_claims bigint, billed_amount_denied double",
    "agg_provider_outliers":
        "provider_id string, provider_type string, avg_billed double, claim_count bigint, "
        "total_billed double, cohort_mean_avg_billed double, outlier_threshold double, "
        "is_cost_outlier boolean",
    "agg_readmissions":
        "diagnosis_category string, inpatient_claims bigint, readmissions_30d bigint, "
        "readmission_rate double",
}
# ----------------------------------------------------------------------------

DENIED = "denied"
INPATIENT = "inpatient"
READMISSION_WINDOW_DAYS = 30
MONTH = "service_month"
FLAG = "is_readmission_within_30d"

RAW_COLUMNS = [name for name, _ in CLAIM_COLUMNS]
DATE_COLUMNS = [name for name, kind in CLAIM_COLUMNS if kind == "date"]
MONEY_COLUMNS = [name for name, kind in CLAIM_COLUMNS if kind == "money"]
FACT_COLUMNS = RAW_COLUMNS + [MONTH]
_TYPES = {"string": T.StringType(), "date": T.DateType(), "boolean": T.BooleanType()}


def _fact_schema(money: T.DataType) -> T.StructType:
    types = [(name, money if kind == "money" else _TYPES[kind]) for name, kind in CLAIM_COLUMNS]
    return T.StructType([T.StructField(*c) for c in [*types, (MONTH, T.StringType())]])


# The curated fact keeps exact money; the warehouse copy has floating money.
FACT_SCHEMA = _fact_schema(MONEY)
WAREHOUSE_SCHEMA = _fact_schema(T.DoubleType())

def columns_ddl(schema: T.StructType) -> str:
    """``name TYPE, ...`` text of a schema, for CREATE TABLE."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
