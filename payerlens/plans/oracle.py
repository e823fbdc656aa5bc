"""The registered queries in DuckDB SQL, written independently of the Spark code.

Rates and averages use integer arithmetic on cents, because rounding a binary
quotient differs between engines on ties.
"""

from __future__ import annotations

from payerlens.schemas import (
    AGE_BANDS,
    DENIAL_REASONS,
    DIAGNOSIS_CATEGORIES,
    PLAN_TYPES,
    PROCEDURE_CATEGORIES,
    PROVIDER_TYPES,
    STATES,
)


def _enum(index: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {arms} END"


def _cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


def _ratio(numerator: str, denominator: str, digits: int) -> str:
    """Half-up quotient of two integers; the sign is handled apart."""
    scale = 10**digits
    return (
        f"CAST(sign({numerator}) * ((2 * {scale} * abs({numerator}) + abs({denominator})) "
        f"// (2 * abs({denominator}))) AS DOUBLE) / {scale}"
    )


_FEED = f"""
lines AS (
    SELECT *, (l_orderkey + l_partkey) % 100 AS h, CAST(l_shipdate AS DATE) AS sd,
           CAST(l_quantity AS INTEGER) AS qty,
           CASE WHEN l_linenumber = 1 AND l_partkey % 10 = 0 THEN 2 ELSE 1 END AS copies
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
), priced AS (
    SELECT *, CAST((CASE WHEN h = 98 THEN -1 ELSE 1 END)
                   * (CASE WHEN l_suppkey % 33 = 7 THEN 3 ELSE 1 END)
                   * CAST(l_extendedprice AS DECIMAL(15, 2)) AS DECIMAL(18, 2)) AS billed
    FROM lines
), allowed AS (
    SELECT *, CASE WHEN h < 8 THEN CAST(0 AS DECIMAL(18, 2)) ELSE CAST(
        billed * (CAST(0.55 AS DECIMAL(4, 2)) + CAST(l_discount AS DECIMAL(4, 2))
                  * CAST(3.5 AS DECIMAL(2, 1))) AS DECIMAL(18, 2)) END AS allowed
    FROM priced
), typed AS (
    SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                         strftime(sd, '%Y-%m-%d'), qty)) AS claim_id,
           CASE WHEN h <> 97 THEN 'MBR-' || lpad(CAST(o_custkey AS VARCHAR),
               CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') END
               AS member_id,
           'PRV-' || lpad(CAST(l_suppkey AS VARCHAR),
               CAST(greatest(5, length(CAST(l_suppkey AS VARCHAR))) AS INTEGER), '0')
               AS provider_id,
           {_enum("l_suppkey", PROVIDER_TYPES)} AS provider_type,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'HMO' WHEN 'BUILDING' THEN 'PPO'
               WHEN 'FURNITURE' THEN 'EPO' WHEN 'HOUSEHOLD' THEN 'Medicare Advantage'
               ELSE 'Medicaid MCO' END AS plan_type,
           {_enum("o_custkey", AGE_BANDS)} AS member_age_band,
           {_enum("c_nationkey", STATES)} AS member_state,
           CASE l_linenumber WHEN 1 THEN 'inpatient' WHEN 2 THEN 'outpatient'
               WHEN 3 THEN 'outpatient' WHEN 4 THEN 'pharmacy' WHEN 7 THEN 'emergency'
               ELSE 'professional' END AS claim_type,
           {_enum("p_size", DIAGNOSIS_CATEGORIES)} AS diagnosis_category,
           {_enum("l_partkey", PROCEDURE_CATEGORIES)} AS procedure_category,
           sd AS service_date,
           sd + qty % 15 AS submission_date,
           billed AS billed_amount,
           allowed AS allowed_amount,
           CASE WHEN h >= 8 AND h < 12 THEN CAST(
               allowed * (CAST(0.4 AS DECIMAL(3, 1)) + CAST(l_tax AS DECIMAL(4, 2))
                          * CAST(5.625 AS DECIMAL(4, 3))) AS DECIMAL(18, 2))
               ELSE allowed END AS paid_amount,
           CASE WHEN h < 8 THEN 'denied' WHEN h < 12 THEN 'partially_paid'
               WHEN h = 96 THEN 'Denied' WHEN h = 99 THEN 'pending' ELSE 'paid' END
               AS claim_status,
           CASE WHEN h < 8 THEN {_enum("l_partkey", DENIAL_REASONS)} END AS denial_reason,
           copies
    FROM allowed
), feed AS (
    SELECT t.* EXCLUDE (copies) FROM typed t, generate_series(1, t.copies)
)"""

_CLAIMS = f"""{_FEED}, one AS (
    SELECT * FROM feed
    WHERE claim_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY claim_status) = 1
), claims AS (
    SELECT *, strftime(service_date, '%Y-%m') AS service_month FROM one
    WHERE member_id IS NOT NULL AND service_date IS NOT NULL
      AND claim_status IN ('paid', 'partially_paid', 'denied') AND billed_amount >= 0
)"""

# An earlier inpatient claim of the same member, looked up pair by pair.
_STAYS = """stays AS (
    SELECT DISTINCT member_id AS stay_member, service_date AS stay_date
    FROM feed WHERE claim_type = 'inpatient' AND member_id IS NOT NULL
), readmitted AS (
    SELECT DISTINCT a.stay_member, a.stay_date
    FROM stays a
    WHERE EXISTS (
        SELECT 1 FROM stays b
        WHERE b.stay_member = a.stay_member
          AND a.stay_date - b.stay_date BETWEEN 1 AND 30
    )
)"""

_FLAGGED = f"""{_CLAIMS}, {_STAYS}, flagged AS (
    SELECT c.*, c.claim_type = 'inpatient' AND r.stay_member IS NOT NULL
               AS is_readmission_within_30d
    FROM claims c
    LEFT JOIN readmitted r ON c.member_id = r.stay_member AND c.service_date = r.stay_date
)"""

_FAILED = """failed AS (
    SELECT row_number() OVER (PARTITION BY claim_id ORDER BY claim_status) = 1 AS first,
           list_filter([CASE WHEN claim_id IS NULL THEN 'claim_id_missing' END,
                        CASE WHEN member_id IS NULL THEN 'member_id_missing' END,
                        CASE WHEN service_date IS NULL THEN 'service_date_unreadable' END,
                        CASE WHEN claim_status NOT IN ('paid', 'partially_paid', 'denied') THEN 'claim_status_unknown' END,
                        CASE WHEN billed_amount < 0 THEN 'billed_amount_negative' END],
                       lambda x: x IS NOT NULL) AS failures
    FROM feed
)"""

_MONTHLY = """monthly AS (
    SELECT service_month, plan_type,
           CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
           CAST(sum(billed_amount) AS DOUBLE) AS total_billed,
           count(*) AS claim_count,
           count(DISTINCT member_id) AS distinct_members
    FROM claims GROUP BY ALL
)"""

_DIAGNOSIS = f"""diagnosis AS (
    SELECT diagnosis_category,
           CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
           {_ratio(_cents("sum(paid_amount)"), "count(*) * 100", 2)} AS avg_paid_per_claim,
           count(*) AS claim_count,
           sum(paid_amount) AS exact_paid
    FROM claims GROUP BY ALL
)"""


def _denials(key: str) -> str:
    denied = "count(*) FILTER (WHERE claim_status = 'denied')"
    return f"""denials AS (
    SELECT {key}, count(*) AS total_claims, {denied} AS denied_claims,
           {_ratio(denied, "count(*)", 4)} AS denial_rate
    FROM claims GROUP BY ALL
)"""


_OUTLIERS = f"""profile AS (
    SELECT provider_id, provider_type,
           {_ratio(_cents("sum(billed_amount)"), "count(*) * 100", 2)} AS avg_billed,
           count(*) AS claim_count,
           CAST(sum(billed_amount) AS DOUBLE) AS total_billed,
           CAST(sum(paid_amount) AS DOUBLE) AS total_paid
    FROM claims GROUP BY ALL
), cohort AS (
    SELECT coalesce(avg(avg_billed), 0.0) AS m,
           coalesce(avg(avg_billed), 0.0) + 2.0 * coalesce(stddev_samp(avg_billed), 0.0) AS t
    FROM profile
), outliers AS (
    SELECT profile.*, round(m, 2) AS cohort_mean_avg_billed, round(t, 2) AS outlier_threshold,
           avg_billed > t AS is_cost_outlier
    FROM profile, cohort
)"""

_READMISSIONS = f"""rates AS (
    SELECT diagnosis_category, count(*) AS inpatient_claims,
           CAST(sum(CAST(is_readmission_within_30d AS INTEGER)) AS BIGINT) AS readmissions_30d,
           {_ratio("sum(CAST(is_readmission_within_30d AS INTEGER))", "count(*)", 4)}
               AS readmission_rate
    FROM flagged WHERE claim_type = 'inpatient' GROUP BY ALL
)"""


def _percent(rate: str) -> str:
    return f"CAST(CAST(round(CAST({rate} * 10000 AS DECIMAL(20, 0)) / 100.0, 1) " \
           "AS DECIMAL(20, 1)) AS VARCHAR) || '%'"


_LAG_DAYS = "date_diff('day', service_date, submission_date)"
_DELTA = f"({_cents('paid')} - {_cents('before')})"
_PIVOT = ", ".join(
    f"CAST(sum(paid_amount) FILTER (WHERE plan_type = '{p}') AS DOUBLE) AS \"{p}\""
    for p in PLAN_TYPES
)


def oracle_queries() -> dict[str, str]:
    bodies = {
        "clean_claims": (_FLAGGED, """
            SELECT * REPLACE (
                CAST(billed_amount AS DOUBLE) AS billed_amount,
                CAST(allowed_amount AS DOUBLE) AS allowed_amount,
                CAST(paid_amount AS DOUBLE) AS paid_amount)
            FROM flagged"""),
        "row_audit": (_CLAIMS, """
            SELECT (SELECT count(*) FROM feed) AS raw_rows,
                   (SELECT count(*) FROM claims) AS clean_rows"""),
        "readmission_flag": (f"{_CLAIMS}, {_STAYS}", """
            SELECT claim_id, member_id, service_date,
                   stay_member IS NOT NULL AS is_readmission_within_30d
            FROM one
            LEFT JOIN readmitted ON member_id = stay_member AND service_date = stay_date
            WHERE claim_type = 'inpatient' AND member_id IS NOT NULL"""),
        "load_path_partition": (_FLAGGED, """
            SELECT service_month, count(*) AS claim_count,
                   CAST(sum(billed_amount) AS DOUBLE) AS total_billed,
                   CAST(sum(allowed_amount) AS DOUBLE) AS total_allowed,
                   CAST(sum(paid_amount) AS DOUBLE) AS total_paid,
                   count(*) FILTER (WHERE is_readmission_within_30d) AS readmissions,
                   min(service_date) AS first_service_date,
                   max(submission_date) AS last_submission_date
            FROM flagged GROUP BY ALL"""),
        "reconcile_monthly": (f"{_CLAIMS}, {_MONTHLY}", """
            SELECT 'agg_monthly_spend' AS table_name, count(*) AS left_rows,
                   count(*) AS right_rows, count(*) AS matched_rows,
                   CAST(0 AS BIGINT) AS left_only_rows, CAST(0 AS BIGINT) AS right_only_rows
            FROM monthly"""),
        "audit_by_rule": (f"{_CLAIMS}, {_FAILED}", """
            SELECT rule, (SELECT count(*) FROM failed WHERE list_contains(failures, rule)) AS raw_rows,
                   (SELECT count(*) FROM failed WHERE first AND list_contains(failures, rule)) AS claims,
                   (SELECT count(*) FROM failed WHERE first AND failures = [rule]) AS only_rule
            FROM (SELECT unnest(['claim_id_missing', 'member_id_missing', 'service_date_unreadable',
                                 'claim_status_unknown', 'billed_amount_negative',
                                 'billed_amount_unreadable']) AS rule)
            UNION ALL
            SELECT 'none', count(*) FILTER (len(failures) = 0),
                   count(*) FILTER (first AND len(failures) = 0), CAST(0 AS BIGINT) FROM failed"""),
        "clean_claims_two_phase": (_FLAGGED, """
            SELECT * REPLACE (
                CAST(billed_amount AS DOUBLE) AS billed_amount,
                CAST(allowed_amount AS DOUBLE) AS allowed_amount,
                CAST(paid_amount AS DOUBLE) AS paid_amount)
            FROM flagged"""),
        "monthly_spend_from_sets": (f"{_CLAIMS}, {_MONTHLY}", "SELECT * FROM monthly"),
        "pmpm_from_sets": (_CLAIMS, f"""
            SELECT service_month, plan_type,
                   {_ratio(_cents("sum(paid_amount)"), "count(DISTINCT member_id) * 100", 2)}
                       AS pmpm
            FROM claims GROUP BY ALL"""),
        "rolling_quarter_members": (f"""{_CLAIMS}, groups AS (
            SELECT DISTINCT service_month, plan_type FROM claims
        )""", """
            SELECT g.service_month, g.plan_type, count(DISTINCT c.member_id) AS distinct_members
            FROM groups g JOIN claims c ON c.plan_type = g.plan_type AND c.service_month <= g.service_month
             AND c.service_month >= strftime(CAST(g.service_month || '-01' AS DATE) - INTERVAL 2 MONTH, '%Y-%m')
            GROUP BY ALL"""),
        "reconcile_three_sides": (_CLAIMS, """
            SELECT side, CASE WHEN side = 'feed' THEN f.n ELSE c.n END AS total_rows, c.n AS agreeing_rows,
                   CASE WHEN side = 'feed' THEN f.n - c.n ELSE 0 END AS differing_rows
            FROM (SELECT unnest(['feed', 'fact', 'warehouse']) AS side),
                 (SELECT count(*) AS n FROM one) f, (SELECT count(*) AS n FROM claims) c"""),
        "load_mixed_files": (_CLAIMS, """
            SELECT service_month, count(*) AS claim_count,
                   CAST(sum(billed_amount) AS DOUBLE) AS total_billed,
                   CAST(sum(allowed_amount) AS DOUBLE) AS total_allowed,
                   CAST(sum(paid_amount) AS DOUBLE) AS total_paid
            FROM claims GROUP BY ALL"""),
        "monthly_spend": (f"{_CLAIMS}, {_MONTHLY}", "SELECT * FROM monthly"),
        "diagnosis_cost": (
            f"{_CLAIMS}, {_DIAGNOSIS}", "SELECT * EXCLUDE (exact_paid) FROM diagnosis"
        ),
        "denial_by_provider_type": (
            f"{_CLAIMS}, {_denials('provider_type')}", "SELECT * FROM denials"
        ),
        "denial_by_reason": (_CLAIMS, """
            SELECT denial_reason, count(*) AS denied_claims,
                   CAST(sum(billed_amount) AS DOUBLE) AS billed_amount_denied
            FROM claims WHERE claim_status = 'denied' GROUP BY ALL"""),
        "provider_outliers": (
            f"{_CLAIMS}, {_OUTLIERS}", "SELECT * EXCLUDE (total_paid) FROM outliers"
        ),
        "readmissions": (f"{_FLAGGED}, {_READMISSIONS}", "SELECT * FROM rates"),
        "pmpm": (_CLAIMS, f"""
            SELECT service_month, plan_type,
                   {_ratio(_cents("sum(paid_amount)"), "count(DISTINCT member_id) * 100", 2)}
                       AS pmpm
            FROM claims GROUP BY ALL"""),
        "mom_trend": (f"""{_CLAIMS}, totals AS (
            SELECT service_month, sum(paid_amount) AS paid FROM claims GROUP BY ALL
        ), paired AS (
            SELECT *, lag(paid) OVER (ORDER BY service_month) AS before FROM totals
        )""", f"""
            SELECT service_month, CAST(paid AS DOUBLE) AS total_paid,
                   CAST(paid - before AS DOUBLE) AS mom_change,
                   CASE WHEN before <> 0 THEN
                       {_ratio(f"(100 * {_DELTA})", _cents("before"), 2)} END AS mom_pct_change
            FROM paired"""),
        "submission_lag": (_CLAIMS, f"""
            SELECT provider_type,
                   {_ratio(f"sum({_LAG_DAYS})", f"count({_LAG_DAYS})", 1)} AS avg_days_to_submit,
                   count(*) AS claim_count
            FROM claims GROUP BY ALL"""),
        "high_utilizers": (_CLAIMS, """
            SELECT member_id, count(*) AS inpatient_claim_count,
                   CAST(sum(paid_amount) AS DOUBLE) AS total_paid
            FROM claims WHERE claim_type = 'inpatient'
            GROUP BY ALL HAVING count(*) >= 3
            ORDER BY sum(paid_amount) DESC, member_id LIMIT 25"""),
        "denial_trend": (f"{_CLAIMS}, {_denials('service_month')}", "SELECT * FROM denials"),
        "top_providers": (f"""{_CLAIMS}, {_OUTLIERS}""", """
            SELECT c.provider_id, c.provider_type,
                   CAST(sum(c.paid_amount) AS DOUBLE) AS total_paid,
                   count(*) AS claim_count, o.is_cost_outlier
            FROM claims c
            LEFT JOIN outliers o
              ON c.provider_id = o.provider_id AND c.provider_type = o.provider_type
            GROUP BY ALL
            ORDER BY sum(c.paid_amount) DESC, c.provider_id, c.provider_type LIMIT 10"""),
        "age_diagnosis_cost": (_CLAIMS, """
            SELECT member_age_band, diagnosis_category,
                   CAST(sum(paid_amount) AS DOUBLE) AS total_paid, count(*) AS claim_count
            FROM claims GROUP BY ALL"""),
        "monthly_spend_pivot": (
            _CLAIMS, f"SELECT service_month, {_PIVOT} FROM claims GROUP BY ALL"
        ),
        "outlier_scatter": (f"{_CLAIMS}, {_OUTLIERS}", """
            SELECT provider_id, claim_count, avg_billed,
                   CASE WHEN is_cost_outlier THEN 'outlier' ELSE 'normal' END AS outlier_class,
                   outlier_threshold
            FROM outliers"""),
        "diagnosis_bars": (f"{_CLAIMS}, {_DIAGNOSIS}", """
            SELECT diagnosis_category, total_paid,
                   '$' || CAST(CAST((2 * CAST(exact_paid * 100 AS HUGEINT) + 10000000)
                       // 20000000 AS DECIMAL(20, 0)) / 10 AS DECIMAL(20, 1)) || 'M' AS label
            FROM diagnosis"""),
        "denial_rate_bars": (f"{_CLAIMS}, {_denials('provider_type')}", f"""
            SELECT provider_type, denial_rate, {_percent("denial_rate")} AS label FROM denials"""),
        "readmission_bars": (f"{_FLAGGED}, {_READMISSIONS}", f"""
            SELECT diagnosis_category, readmission_rate,
                   {_percent("readmission_rate")} AS label
            FROM rates"""),
    }
    return {name: f"WITH {ctes}\n{body.strip()}" for name, (ctes, body) in bodies.items()}
