from datetime import date

import pytest
from conftest import TABLES, rows
from pyspark.sql import functions as F

from payerlens.operators.cleaning import clean
from payerlens.operators.providers import provider_outliers, provider_profile
from payerlens.operators.reconcile import reconcile, row_differences
from payerlens.operators.summary import claim_summary
from payerlens.plans.analyst_sql import ANALYST_SQL, run_sql
from payerlens.plans.analytics import ANALYST_REPORTS, analyst_reports, chart_feeds
from payerlens.plans.analytics import main as analytics_main
from payerlens.plans import pipeline
from payerlens.plans.pipeline import main, publish, run_pipeline
from payerlens.plans.reports import AGGREGATES, FEEDS, FROM_SUMMARY, REPORTS
from payerlens.sources.catalog import list_tables, load_warehouse, register_curated
from payerlens.sources.order_feed import claims_feed
from payerlens.sources.tables import (
    read_aggregate,
    read_aggregate_csv,
    read_fact,
    table_path,
    write_aggregate,
    write_fact,
)

DATABASE = "claims_test"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "claims")
    claims_feed(spark, TABLES, with_flag=True).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("out") / "curated")
    audit = run_pipeline(spark, raw, base)
    register_curated(spark, base, DATABASE)
    return base, audit


def test_audit(built):
    assert tuple(built[1]) == (6087, 5727)


def test_csv_feed_gives_the_same_fact_as_the_tables(spark, built):
    direct = clean(claims_feed(spark, TABLES, with_flag=True))
    assert row_differences(direct, read_fact(spark, built[0])).count() == 0


def test_catalog(spark, built):
    assert list_tables(spark, DATABASE) == sorted(["claims", *AGGREGATES])
    fact = spark.table(f"{DATABASE}.claims")
    assert fact.count() == 5727
    assert fact.select("service_month").distinct().count() == 83
    register_curated(spark, built[0], DATABASE)
    assert spark.table(f"{DATABASE}.claims").count() == 5727


def test_invariants(spark, built):
    tables = {n: read_aggregate(spark, built[0], n) for n in AGGREGATES}
    fact = read_fact(spark, built[0])

    def total(frame, column):
        return frame.agg(F.sum(F.col(column).cast("decimal(18,2)"))).first()[0]

    paid = total(fact, "paid_amount")
    assert paid == total(tables["agg_monthly_spend"], "total_paid")
    assert paid == total(tables["agg_diagnosis_cost"], "total_paid")
    assert paid == total(REPORTS["age_diagnosis_cost"].run(fact), "total_paid")
    denied = fact.where("claim_status = 'denied'").count()
    for frame in (tables["agg_denial_by_provider_type"], tables["agg_denial_by_reason"],
                  REPORTS["denial_trend"].run(fact)):
        assert frame.agg(F.sum("denied_claims")).first()[0] == denied
    assert tables["agg_provider_outliers"].count() == 10


def test_summary_gives_what_the_fact_gives(spark, built, claims):
    odd = claims(
        {"diagnosis_category": None, "provider_type": None, "paid_amount": None},
        {"claim_type": "inpatient", "is_readmission_within_30d": None},
        {"claim_type": "inpatient", "is_readmission_within_30d": True, "claim_status": "denied"},
        {"claim_status": "denied", "denial_reason": "out_of_network", "billed_amount": None},
    )
    for fact in (read_fact(spark, built[0]), odd, claims({}).limit(0)):
        summary = claim_summary(fact)
        for name, build in FROM_SUMMARY.items():
            direct = REPORTS[name].build(fact)
            assert build(summary).dtypes == direct.dtypes
            assert row_differences(build(summary), direct).count() == 0


def test_failed_run_leaves_the_published_tables(spark, raw, tmp_path, monkeypatch):
    base, name = str(tmp_path / "runs"), "claims_published"
    first, audit = publish(spark, raw, base, name, fact_csv=False)
    assert tuple(audit) == (6087, 5727)
    small = spark.read.option("header", True).csv(raw).limit(50)
    small.write.option("header", True).csv(str(tmp_path / "small"))
    wrote = []

    def failing(aggregate, base, table):
        wrote.append(table)
        if len(wrote) == 3:
            raise RuntimeError("third aggregate")
        write_aggregate(aggregate, base, table)

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "write_aggregate", failing)
        with pytest.raises(RuntimeError):
            publish(spark, str(tmp_path / "small"), base, name, fact_csv=False)
    assert spark.table(f"{name}.claims").count() == 5727
    for table in AGGREGATES:
        stored = read_aggregate(spark, first, table)
        assert row_differences(spark.table(f"{name}.{table}"), stored).count() == 0
    second, audit = publish(spark, str(tmp_path / "small"), base, name, fact_csv=False)
    assert second != first
    assert spark.table(f"{name}.claims").count() == audit.clean_rows < 51
    assert read_fact(spark, first).count() == 5727


def test_second_run_gives_identical_tables(spark, raw, built, tmp_path):
    other = str(tmp_path / "again")
    run_pipeline(spark, raw, other, fact_csv=False)
    for name in AGGREGATES:
        first, second = (read_aggregate(spark, b, name) for b in (built[0], other))
        got = rows(reconcile(first, second, name))[0]
        assert got["left_only_rows"] == got["right_only_rows"] == 0
        copy = read_aggregate_csv(spark, other, name)
        assert row_differences(second, copy).count() == 0


def test_rerun_overwrites_in_place(spark, raw, tmp_path):
    base = str(tmp_path / "same")
    for _ in range(2):
        audit = run_pipeline(spark, raw, base, fact_csv=False)
    assert tuple(audit) == (6087, 5727)


def test_command_line(spark, raw, tmp_path, capsys):
    main(["--input", raw, "--output-base", str(tmp_path / "c"), "--z-threshold", "1.5",
          "--no-fact-csv", "--register", "--database", "claims_cli"])
    printed = capsys.readouterr().out
    assert "Raw rows: 6087, clean rows: 5727" in printed
    assert "agg_readmissions" in printed
    flagged = spark.table("claims_cli.agg_provider_outliers").where("is_cost_outlier")
    fact = read_fact(spark, str(tmp_path / "c"))
    expected = provider_outliers(provider_profile(fact), 1.5).where("is_cost_outlier")
    assert row_differences(flagged, expected).count() == 0


def test_analyst_reports_equal_their_sql(spark, built):
    fact = read_fact(spark, built[0])
    outliers = read_aggregate(spark, built[0], "agg_provider_outliers")
    reports = analyst_reports(fact, outliers)
    assert list(reports) == ANALYST_REPORTS
    for name, ours in reports.items():
        tables = {"claims": fact} | ({"outliers": outliers} if name == "top_providers" else {})
        assert row_differences(ours, run_sql(spark, name, **tables)).count() == 0
    top = [r["total_paid"] for r in reports["top_providers"].collect()]
    assert len(top) == 10 and top == sorted(top, reverse=True)


def test_chart_feeds_from_stored_copies(spark, built):
    feeds = chart_feeds(spark, built[0])
    assert set(feeds) == set(FEEDS)
    for name, (source, feed) in FEEDS.items():
        table = next(t for t, report in AGGREGATES.items() if report == source)
        stored = feed.build(read_aggregate(spark, built[0], table))
        assert row_differences(stored, feeds[name].select(*stored.columns)).count() == 0
    bars = [r["denial_rate"] for r in feeds["denial_rate_bars"].collect()]
    assert bars == sorted(bars) and len(bars) == 6


def test_analytics_command_line(spark, built, tmp_path, capsys):
    analytics_main(["--curated-base", built[0], "--out", str(tmp_path), "--last-month", "1997-12"])
    written = sorted(p.name for p in tmp_path.iterdir())
    assert written == sorted([*ANALYST_REPORTS, *FEEDS])
    trend = spark.read.option("header", True).csv(str(tmp_path / "denial_trend"))
    assert {r["service_month"] for r in trend.collect()} and all(
        r["service_month"] <= "1997-12" for r in trend.collect())
    analytics_main(["--curated-base", built[0], "--preview", "3"])
    assert "avg_days_to_submit" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        analytics_main(["--curated-base", built[0]])
    pmpm = spark.read.option("header", True).csv(str(tmp_path / "pmpm"))
    assert pmpm.count() > 100


def test_first_month_keeps_its_change(spark, built):
    fact = read_fact(spark, built[0])
    outliers = read_aggregate(spark, built[0], "agg_provider_outliers")
    whole = analyst_reports(fact, outliers)["mom_trend"].collect()
    tail = analyst_reports(fact, outliers, "1997-01")["mom_trend"].collect()
    assert tail == [r for r in whole if r["service_month"] >= "1997-01"]
    assert tail[0]["mom_change"] is not None


def test_all_tables_follow_reloads_and_bases(spark, tmp_path):
    """Register, reload, register, read in one session; then another base, then new columns."""
    name, bases = "claims_moves", [str(tmp_path / "a"), str(tmp_path / "b")]
    for base, rows_ in ((bases[0], 3), (bases[0], 5), (bases[1], 7)):
        claims_table = read_fact(spark, _built(spark, base, rows_))
        register_curated(spark, base, name)
        assert spark.table(f"{name}.claims").count() == claims_table.count() == rows_
        for table in AGGREGATES:
            stored = read_aggregate(spark, base, table)
            assert row_differences(spark.table(f"{name}.{table}"), stored).count() == 0
    spark.sql(f"DROP TABLE {name}.agg_readmissions")
    spark.sql(f"CREATE TABLE {name}.agg_readmissions (x int) USING PARQUET LOCATION '{tmp_path}/c'")
    register_curated(spark, bases[1], name)
    assert "readmission_rate" in spark.table(f"{name}.agg_readmissions").columns
    spark.sql(f"DROP TABLE {name}.agg_readmissions")
    spark.sql(f"CREATE TABLE {name}.agg_readmissions (x int) USING PARQUET")
    with pytest.raises(ValueError):
        register_curated(spark, bases[1], name)


def _built(spark, base, n):
    from conftest import RAW_DEFAULT

    raw = spark.createDataFrame(
        [tuple((RAW_DEFAULT | {"claim_id": f"c{i}"}).values()) for i in range(n)],
        ", ".join(f"{c} string" for c in RAW_DEFAULT),
    )
    raw.write.mode("overwrite").option("header", True).csv(f"{base}_raw")
    run_pipeline(spark, f"{base}_raw", base, fact_csv=False)
    return base


def test_commands(spark, built, tmp_path, capsys):
    from payerlens.plans.commands import analyst_sql, warehouse

    warehouse(["--staged", table_path(built[0], "claims"), "--table", "wh_cli.claims"])
    assert "wh_cli.claims: 5727 rows" in capsys.readouterr().out
    register_curated(spark, built[0], "claims_sql_cli")
    analyst_sql(["--database", "claims_sql_cli", "--out", str(tmp_path)])
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(ANALYST_SQL)
    written = spark.read.option("header", True).csv(str(tmp_path / "pmpm"))
    assert written.count() == REPORTS["pmpm"].run(read_fact(spark, built[0])).count()


def test_registration_follows_a_reload(spark, claims, tmp_path):
    base, name = str(tmp_path), "claims_reload"
    for month in (1, 2):
        write_fact(claims({"service_date": date(2026, month, 1)}), base)
        register_curated(spark, base, name)
        months = [r[0] for r in spark.sql(
            f"SELECT service_month FROM {name}.claims").collect()]
        assert months == [f"2026-{month:02}"]
        assert spark.sql(f"SHOW PARTITIONS {name}.claims").count() == 1


@pytest.mark.parametrize("name", sorted(ANALYST_SQL))
def test_sql_on_catalog_tables_equals_the_operator(spark, built, name):
    fact = spark.table(f"{DATABASE}.claims")
    tables = {"claims": fact}
    source = fact
    if name == "top_providers":
        tables["outliers"] = spark.table(f"{DATABASE}.agg_provider_outliers")
        source = provider_profile(fact)
    ours = REPORTS[name].run(source)
    assert row_differences(ours, run_sql(spark, name, **tables)).count() == 0


def test_warehouse_reload_is_repeatable(spark, built):
    for _ in range(2):
        loaded = load_warehouse(spark, table_path(built[0], "claims"), "wh_test.claims")
        assert loaded.count() == 5727
    assert dict(loaded.dtypes)["paid_amount"] == "double"
    fact = read_fact(spark, built[0])
    for column in ("billed_amount", "allowed_amount", "paid_amount"):
        fact = fact.withColumn(column, F.col(column).cast("double"))
    assert row_differences(fact, loaded).count() == 0
