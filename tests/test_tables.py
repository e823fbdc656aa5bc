from datetime import date
from pathlib import Path

import pytest
from conftest import plan_of, rows

from payerlens.operators.reconcile import row_differences
from payerlens.operators.spend import diagnosis_cost, monthly_spend
from payerlens.schemas import AGGREGATE_DDL, FACT_COLUMNS, MONEY_COLUMNS, MONTH
from payerlens.sources.tables import (
    csv_path,
    read_aggregate,
    read_aggregate_csv,
    read_fact,
    read_fact_by_path,
    table_path,
    write_aggregate,
    write_fact,
    write_fact_csv,
)

MONTHS = [date(2026, m, 1) for m in (1, 2, 3)]


@pytest.fixture(scope="module")
def fact(claims):
    return claims(*[{"claim_id": f"c{n}", "service_date": MONTHS[n % 3]} for n in range(30)])


@pytest.fixture(scope="module")
def base(fact, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated"))
    write_fact(fact, path)
    return path


def doubles(frame):
    return frame.withColumns({c: frame[c].cast("double") for c in MONEY_COLUMNS})


def test_fact_round_trip(spark, fact, base):
    stored = read_fact(spark, base)
    assert stored.columns == FACT_COLUMNS
    assert row_differences(fact, stored).count() == 0


def test_one_file_per_small_month(base):
    files = list(Path(table_path(base, "claims")).glob("service_month=*/*.parquet"))
    assert len(files) == 3


def test_large_month_is_split(spark, fact, tmp_path):
    """Rebalancing splits a month that exceeds the advisory size; repartitioning could not."""
    wide = fact.selectExpr("*", "explode(sequence(1, 4000)) AS n").selectExpr(
        "concat(claim_id, '-', n, '-', md5(CAST(n AS STRING))) AS claim_id",
        *[c for c in FACT_COLUMNS if c not in ("claim_id", MONTH)], "'2026-01' AS service_month",
    ).repartition(8)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "200k")
    try:
        write_fact(wide, str(tmp_path))
    finally:
        spark.conf.unset(setting)
    files = list(Path(table_path(str(tmp_path), "claims")).glob("service_month=2026-01/*.parquet"))
    assert len(files) > 1
    assert read_fact(spark, str(tmp_path)).count() == 120000


def test_month_range_prunes_partitions_and_columns(spark, base):
    part = read_fact(spark, base, "2026-02", "2026-02")
    assert part.count() == 10
    plan = plan_of(diagnosis_cost(part))
    assert "PartitionFilters: [isnotnull(service_month" in plan
    assert "ReadSchema: struct<diagnosis_category:string,paid_amount:decimal(18,2)>" in plan


def test_month_comes_from_the_path(spark, fact, base):
    loaded = read_fact_by_path(spark, table_path(base, "claims"))
    assert loaded.columns == FACT_COLUMNS
    assert row_differences(doubles(fact), loaded).count() == 0


def test_file_outside_a_month_has_a_null_month(spark, fact, tmp_path):
    fact.drop(MONTH).write.parquet(str(tmp_path / "loose"))
    months = {r[MONTH] for r in rows(read_fact_by_path(spark, str(tmp_path)).select(MONTH))}
    assert months == {None}


def test_equal_file_names_in_two_months_do_not_collide(spark, fact, tmp_path):
    for month in ("2026-01", "2026-02"):
        target = tmp_path / f"service_month={month}"
        fact.where(fact[MONTH] == month).drop(MONTH).coalesce(1).write.parquet(str(target))
        file = next(target.glob("*.parquet"))
        file.rename(target / "part-0.parquet")
        next(target.glob(f".{file.name}.crc")).unlink()
    loaded = read_fact_by_path(spark, str(tmp_path))
    assert loaded.groupBy(MONTH).count().count() == 2 and loaded.count() == 20


def test_fact_csv_copy_keeps_all_columns(spark, fact, base):
    write_fact_csv(spark, base)
    copy = spark.read.option("header", True).csv(csv_path(base, "claims"))
    assert copy.columns == FACT_COLUMNS and copy.count() == 30


def test_aggregate_and_csv_copy_agree(spark, fact, base):
    name = "agg_monthly_spend"
    write_aggregate(monthly_spend(fact), base, name)
    stored, copy = read_aggregate(spark, base, name), read_aggregate_csv(spark, base, name)
    assert row_differences(stored, copy).count() == 0
    assert stored.count() == 3
    assert copy.schema[MONTH].dataType.simpleString() == "string"
    assert len(list(Path(csv_path(base, name)).glob("*.csv"))) == 1


@pytest.mark.parametrize("layout", ["service_month=", ""])
def test_bulk_load_of_foreign_files(spark, fact, tmp_path, layout):
    """Months with money as decimal, double and text, a text date, absent and extra columns."""
    for month, money in (("2026-01", "decimal(10,2)"), ("2026-02", "double"), ("2026-03", "string")):
        part = fact.where(fact[MONTH] == month).drop(MONTH)
        for column in ("billed_amount", "allowed_amount", "paid_amount"):
            part = part.withColumn(column, part[column].cast(money))
        if month == "2026-02":
            part = part.withColumn("service_date", part["service_date"].cast("string"))
            part = part.drop("denial_reason").withColumn("extra", part["claim_id"])
        part.write.parquet(str(tmp_path / f"{layout}{month}"))
    loaded = read_fact_by_path(spark, str(tmp_path))
    assert loaded.columns == FACT_COLUMNS
    assert row_differences(doubles(fact), loaded).count() == 0


def test_bulk_load_gives_null_for_what_cannot_be_cast(spark, fact, tmp_path):
    fact.selectExpr("claim_id", "'abc' AS paid_amount").limit(1).write.parquet(str(tmp_path / "2026-01"))
    (loaded,) = rows(read_fact_by_path(spark, str(tmp_path)))
    assert loaded["paid_amount"] is None and loaded[MONTH] == "2026-01"


def test_missing_csv_copy_is_an_error(spark, base):
    name = "agg_readmissions"
    with pytest.raises(FileNotFoundError):
        read_aggregate_csv(spark, base, name)
    Path(csv_path(base, name)).mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        read_aggregate_csv(spark, base, name)


def test_six_aggregates():
    assert len(AGGREGATE_DDL) == 6
