"""The analyst questions as plain SQL, for users of the catalog tables.

``run_sql`` binds ``{claims}`` and ``{outliers}`` to DataFrames; the same text
runs on catalog tables after replacing the braces by table names. These texts are
also the second, independently written side of the reconciliation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ANALYST_SQL = {
    "monthly_spend": """
        SELECT service_month, plan_type,
               CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
               CAST(sum(billed_amount) AS DOUBLE) AS total_billed,
               count(*) AS claim_count,
               count(DISTINCT member_id) AS distinct_members
        FROM {claims}
        GROUP BY ALL
    """,
    "pmpm": """
        SELECT service_month, plan_type,
               CAST(round(sum(paid_amount) / count(DISTINCT member_id), 2) AS DOUBLE) AS pmpm
        FROM {claims}
        GROUP BY ALL
    """,
    "mom_trend": """
        WITH monthly AS (
            SELECT service_month, CAST(sum(paid_amount) AS DECIMAL(20, 2)) AS paid
            FROM {claims}
            GROUP BY ALL
        ), paired AS (
            SELECT service_month, paid, lag(paid) OVER (ORDER BY service_month) AS before
            FROM monthly
        )
        SELECT service_month,
               CAST(paid AS DOUBLE) AS total_paid,
               CAST(paid - before AS DOUBLE) AS mom_change,
               CAST(round((paid - before) * 100 / nullif(before, 0), 2) AS DOUBLE)
                   AS mom_pct_change
        FROM paired
    """,
    "submission_lag": """
        SELECT provider_type,
               CAST(round(CAST(sum(datediff(submission_date, service_date)) AS DECIMAL(20, 0))
                          / count(datediff(submission_date, service_date)), 1) AS DOUBLE)
                   AS avg_days_to_submit,
               count(*) AS claim_count
        FROM {claims}
        GROUP BY ALL
    """,
    "high_utilizers": """
        SELECT member_id,
               count(*) AS inpatient_claim_count,
               CAST(sum(paid_amount) AS DOUBLE) AS total_paid
        FROM {claims}
        WHERE claim_type = 'inpatient'
        GROUP BY ALL
        HAVING inpatient_claim_count >= 3
        ORDER BY total_paid DESC, member_id
        LIMIT 25
    """,
    "denial_trend": """
        SELECT service_month,
               count(*) AS total_claims,
               count_if(claim_status = 'denied') AS denied_claims,
               round(count_if(claim_status = 'denied') / count(*), 4) AS denial_rate
        FROM {claims}
        GROUP BY ALL
    """,
    "top_providers": """
        WITH top AS (
            SELECT provider_id, provider_type,
                   CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
                   count(*) AS claim_count
            FROM {claims}
            GROUP BY ALL
            ORDER BY total_paid DESC, provider_id, provider_type
            LIMIT 10
        )
        SELECT top.*, o.is_cost_outlier
        FROM top
        LEFT JOIN {outliers} o
          ON top.provider_id = o.provider_id AND top.provider_type <=> o.provider_type
    """,
    "age_diagnosis_cost": """
        SELECT member_age_band, diagnosis_category,
               CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
               count(*) AS claim_count
        FROM {claims}
        GROUP BY ALL
    """,
}


def run_sql(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    return spark.sql(ANALYST_SQL[name], **tables)
