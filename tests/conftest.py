from __future__ import annotations

import sys
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from payerlens.schemas import FACT_SCHEMA, MONTH  # noqa: E402
from payerlens.session import build_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "payerlens-tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.checkpoint.dir": str(work / "shared"),
        },
        "local[4]",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def claims(spark):
    """Builds a clean fact from partial rows."""

    def build(*rows: dict):
        complete = []
        for number, row in enumerate(rows):
            day = row.get("service_date", date(2026, 1, 15))
            full = {
                "claim_id": f"c{number}",
                "member_id": "m1",
                "provider_id": "p1",
                "provider_type": "lab",
                "plan_type": "HMO",
                "member_age_band": "18-34",
                "member_state": "CA",
                "claim_type": "outpatient",
                "diagnosis_category": "diabetes",
                "procedure_category": "lab_panel",
                "service_date": day,
                "submission_date": day + timedelta(days=2) if day else None,
                "billed_amount": "100.00",
                "allowed_amount": "80.00",
                "paid_amount": "80.00",
                "claim_status": "paid",
                "denial_reason": None,
                "is_readmission_within_30d": False,
                MONTH: f"{day:%Y-%m}" if day else None,
            } | row
            for amount in ("billed_amount", "allowed_amount", "paid_amount"):
                if full[amount] is not None:
                    full[amount] = Decimal(str(full[amount]))
            complete.append(full)
        return spark.createDataFrame(complete, FACT_SCHEMA)

    return build


RAW_DEFAULT = {
    "claim_id": "c1",
    "member_id": "m1",
    "provider_id": "p1",
    "provider_type": "lab",
    "plan_type": "HMO",
    "member_age_band": "18-34",
    "member_state": "CA",
    "claim_type": "outpatient",
    "diagnosis_category": "diabetes",
    "procedure_category": "lab_panel",
    "service_date": "2026-01-15",
    "submission_date": "2026-01-17",
    "billed_amount": "100.00",
    "allowed_amount": "80.00",
    "paid_amount": "80.00",
    "claim_status": "paid",
    "denial_reason": None,
    "is_readmission_within_30d": "False",
}


@pytest.fixture(scope="session")
def feed(spark):
    """Builds a raw text feed from partial rows."""

    def build(*rows: dict):
        schema = ", ".join(f"{c} string" for c in RAW_DEFAULT)
        return spark.createDataFrame(
            [tuple((RAW_DEFAULT | r)[c] for c in RAW_DEFAULT) for r in rows], schema
        )

    return build


def rows(frame) -> list[dict]:
    return [r.asDict() for r in frame.collect()]


def by(frame, key: str) -> dict:
    return {r[key]: r.asDict() for r in frame.collect()}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
