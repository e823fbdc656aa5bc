import pytest
from conftest import rows

from payerlens.operators.reconcile import reconcile, row_differences


def test_agreement_with_nulls_and_copies(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 1.0), (None, None)], "k string, v double")
    right = left.select("v", "k")
    assert rows(reconcile(left, right, "t")) == [{
        "table_name": "t", "left_rows": 3, "right_rows": 3, "matched_rows": 3,
        "left_only_rows": 0, "right_only_rows": 0}]
    assert row_differences(left, right).count() == 0


def test_differences_are_counted_as_multisets(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    got = rows(reconcile(left, right, "t"))[0]
    assert (got["matched_rows"], got["left_only_rows"], got["right_only_rows"]) == (1, 2, 1)
    assert row_differences(left, right).count() == 3


def test_empty_sides(spark):
    empty = spark.createDataFrame([], "k string")
    assert rows(reconcile(empty, empty, "t"))[0]["matched_rows"] == 0


def test_columns_must_agree(spark):
    with pytest.raises(ValueError, match="columns differ"):
        reconcile(spark.range(1), spark.range(1).toDF("x"), "t")
