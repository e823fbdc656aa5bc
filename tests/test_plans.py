"""Properties that every registered query's plan must keep."""

import re

import pytest
from conftest import TABLES, plan_of

from payerlens.operators.cleaning import clean
from payerlens.operators.feeds import monthly_spend_pivot
from payerlens.operators.spend import monthly_spend
from payerlens.plans.queries import QUERIES
from payerlens.sources.order_feed import claims_feed


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_python_or_global_window(spark, name):
    plan = plan_of(QUERIES[name](spark, TABLES))
    for operator in ("Cartesian", "NestedLoop", "EvalPython", "InPandas", "InArrow",
                     "CollectLimit"):
        assert operator not in plan
    windows = re.findall(r"Window \[[^\n]*\], \[([^\]]*)\]", plan)
    keyed = re.findall(r"Window \[[^\n]*\], \[[^\]]+\], \[", plan)
    assert len(windows) - len(keyed) == (1 if name == "mom_trend" else 0)


def test_unused_columns_leave_before_the_shuffle(spark):
    plan = plan_of(clean(claims_feed(spark, TABLES)).groupBy("diagnosis_category").count())
    shuffled = plan[plan.index("row_number(), 1, Partial"):]
    projected = re.search(r"Project \[([^\n]*?), xxhash64", shuffled).group(1)
    assert {c.split("#")[0] for c in projected.split(", ")} == {
        "claim_id", "diagnosis_category", "_valid"}


def test_flag_is_not_computed_where_it_is_not_read(spark):
    assert "Window [lag" not in plan_of(QUERIES["pmpm"](spark, TABLES))
    assert "Window [lag" in plan_of(QUERIES["readmissions"](spark, TABLES))


def test_readmission_filter_reaches_the_lines(spark):
    """The claim type is tested where lines are scanned, not after the order join."""
    from payerlens.sources.order_feed import claims_feed

    plan = plan_of(claims_feed(spark, TABLES, with_flag=True))
    joins = [line for line in plan.splitlines() if "Join" in line]
    filters = [line for line in plan.splitlines() if "Filter" in line and "l_linenumber" in line]
    assert any("= inpatient" in line and "o_custkey" not in line for line in filters)
    assert not any("l_linenumber" in line and "NOT" not in line for line in joins)


def test_pivot_drops_the_distinct_count(claims):
    assert "distinct" not in plan_of(monthly_spend_pivot(monthly_spend(claims({}))))
