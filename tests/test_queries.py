import pytest
from conftest import TABLES

from __spark_entry__ import entry
from payerlens.plans.oracle import oracle_queries as oracle_sql
from payerlens.plans.queries import QUERIES
from check_queries import compare, open_oracle
from payerlens.plans.workspace import shared_folder


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(oracle_sql())
    assert len(QUERIES) == 30


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["service_month", "plan_type", "pmpm"]
    assert frame.count() == 414


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    expected = open_oracle(TABLES).sql(oracle_sql()[name])
    assert compare(QUERIES[name](spark, TABLES), expected) is None


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(f"{named}/payerlens/x-")
