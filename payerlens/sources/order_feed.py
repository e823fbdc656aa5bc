"""A raw claims feed derived from order tables.

Maps every line of an order to one claim, with the dirt a real feed has: repeated
claims, missing members, wrong or unknown statuses and negative amounts. All the
work is joins and column expressions, so it grows with the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payerlens.operators.members import with_readmission_flag
from payerlens.schemas import (
    AGE_BANDS,
    DENIAL_REASONS,
    DIAGNOSIS_CATEGORIES,
    FLAG,
    PROCEDURE_CATEGORIES,
    PROVIDER_TYPES,
    RAW_COLUMNS,
    STATES,
)

# --- fixed values: how order data maps to claims ----------------------------
PLAN_OF_SEGMENT = {
    "AUTOMOBILE": "HMO",
    "BUILDING": "PPO",
    "FURNITURE": "EPO",
    "HOUSEHOLD": "Medicare Advantage",
}
OTHER_PLAN = "Medicaid MCO"
CLAIM_TYPE_OF_LINE = [
    "inpatient", "outpatient", "outpatient", "pharmacy",
    "professional", "professional", "emergency",
]
# ----------------------------------------------------------------------------


def order_lines(spark: SparkSession, tables: str) -> DataFrame:
    """The lines with what a claim takes from their order, customer and part; no claim yet."""

    def table(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{tables}/{name}.parquet").select(*columns)

    lines = table(
        "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    # The two narrow tables meet first, so the wide lines are shuffled once for
    # both. No side is forced to be broadcast: Spark does so where the estimated
    # or measured size allows it, and splits skewed keys otherwise.
    members = table("orders", "o_orderkey", "o_custkey").join(
        table("customer", "c_custkey", "c_nationkey", "c_mktsegment"),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    parts = table("part", "p_partkey", "p_size")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        members, F.col("l_orderkey") == F.col("o_orderkey")
    ).drop("p_partkey", "c_custkey", "o_orderkey")


def claims_feed(
    spark: SparkSession, tables: str, with_flag: bool = False, lines: DataFrame | None = None
) -> DataFrame:
    """The 18 raw columns. Without ``with_flag`` the readmission flag is NULL,
    which spares metrics that ignore it a join. ``lines`` is a stored copy of
    ``order_lines``, for those who read the feed several times."""
    joined = order_lines(spark, tables) if lines is None else lines
    claims = _with_amounts(joined).selectExpr(*[f"{e} AS {c}" for c, e in _CLAIM.items()])
    if with_flag:
        claims = with_readmission_flag(claims)
    else:
        claims = claims.selectExpr("*", f"CAST(NULL AS BOOLEAN) AS {FLAG}")
    return claims.select(*RAW_COLUMNS, F.explode("copies")).drop("col")


def _pick(index: str, values: Sequence[str]) -> str:
    names = ", ".join(f"'{v}'" for v in values)
    return f"get(array({names}), CAST({index} % {len(values)} AS INT))"


def _padded(prefix: str, key: str, width: int) -> str:
    """``prefix`` and a zero-padded key; longer keys stay whole."""
    digits = f"CAST({key} AS STRING)"
    return f"concat('{prefix}', lpad({digits}, greatest(length({digits}), {width}), '0'))"


def _plan() -> str:
    arms = " ".join(f"WHEN '{s}' THEN '{p}'" for s, p in PLAN_OF_SEGMENT.items())
    return f"CASE c_mktsegment {arms} ELSE '{OTHER_PLAN}' END"


def _with_amounts(lines: DataFrame) -> DataFrame:
    """Bucket, dates and the three amounts.

    Each amount builds on the one before; adding them in steps lets Spark
    evaluate every decimal product once. Seeded outliers bill three times as much.
    """
    return (
        lines.selectExpr(
            "*",
            "(l_orderkey + l_partkey) % 100 AS bucket",
            "CAST(l_shipdate AS DATE) AS service_date",
            "CAST(l_quantity AS INT) AS quantity",
        )
        .selectExpr(
            "*",
            """CAST(IF(bucket = 98, -1, 1) * IF(l_suppkey % 33 = 7, 3, 1)
                    * CAST(l_extendedprice AS DECIMAL(15, 2)) AS DECIMAL(18, 2))
               AS billed_amount""",
        )
        .selectExpr(
            "*",
            """IF(bucket < 8, CAST(0 AS DECIMAL(18, 2)), CAST(
                   billed_amount * (0.55BD + CAST(l_discount AS DECIMAL(4, 2)) * 3.5BD)
                   AS DECIMAL(18, 2))) AS allowed_amount""",
        )
        .selectExpr(
            "*",
            """IF(bucket BETWEEN 8 AND 11, CAST(
                   allowed_amount * (0.4BD + CAST(l_tax AS DECIMAL(4, 2)) * 5.625BD)
                   AS DECIMAL(18, 2)), allowed_amount) AS paid_amount""",
        )
    )


# The claim of one line, apart from its readmission flag.
_CLAIM = {
    "claim_id": """md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                                 CAST(service_date AS STRING), quantity))""",
    "member_id": f"IF(bucket <> 97, {_padded('MBR-', 'o_custkey', 6)}, NULL)",
    "provider_id": _padded("PRV-", "l_suppkey", 5),
    "provider_type": _pick("l_suppkey", PROVIDER_TYPES),
    "plan_type": _plan(),
    "member_age_band": _pick("o_custkey", AGE_BANDS),
    "member_state": _pick("c_nationkey", STATES),
    "claim_type": _pick("(l_linenumber - 1)", CLAIM_TYPE_OF_LINE),
    "diagnosis_category": _pick("p_size", DIAGNOSIS_CATEGORIES),
    "procedure_category": _pick("l_partkey", PROCEDURE_CATEGORIES),
    "service_date": "service_date",
    "submission_date": "date_add(service_date, quantity % 15)",
    "billed_amount": "billed_amount",
    "allowed_amount": "allowed_amount",
    "paid_amount": "paid_amount",
    "claim_status": """CASE WHEN bucket < 8 THEN 'denied'
                            WHEN bucket < 12 THEN 'partially_paid'
                            WHEN bucket = 96 THEN 'Denied'
                            WHEN bucket = 99 THEN 'pending'
                            ELSE 'paid' END""",
    "denial_reason": f"IF(bucket < 8, {_pick('l_partkey', DENIAL_REASONS)}, NULL)",
    # Some inpatient claims arrive twice.
    "copies": "IF(l_linenumber = 1 AND l_partkey % 10 = 0, array(1, 2), array(1))",
}
