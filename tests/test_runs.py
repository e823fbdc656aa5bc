"""Runs are visible together or not at all; the catalog's views never miss; expiry; the warehouse reload."""

import shutil
import threading
from datetime import UTC, datetime, timedelta

import pytest
from conftest import RAW_DEFAULT, rows

from payerlens.operators.reconcile import row_differences
from payerlens.plans import pipeline
from payerlens.plans.pipeline import main, publish, run_pipeline
from payerlens.plans.reports import AGGREGATES
from payerlens.sources import catalog, tables
from payerlens.sources.catalog import forget_runs, list_tables, load_warehouse, publish_views, register_curated
from payerlens.sources.runs import committed_runs, current_run, expire_runs, expired_runs, run_folder
from payerlens.sources.tables import read_aggregate, read_aggregate_csv, read_fact, read_fact_by_path, table_path, write_fact


def raw_feed(spark, path, n, **changes):
    rows_ = [tuple((RAW_DEFAULT | {"claim_id": f"c{i}"} | changes).values()) for i in range(n)]
    frame = spark.createDataFrame(rows_, ", ".join(f"{c} string" for c in RAW_DEFAULT))
    frame.write.mode("overwrite").option("header", True).csv(path)
    return path


class Killed(BaseException):
    """Ends a run as a kill does: nothing after it is executed."""


# Every call of the pipeline that writes something, in the pipeline's own order.
WRITES = ["write_audited_fact", "write_fact_csv", "store", "store", *["write_aggregate"] * 6, "commit_run"]


@pytest.fixture(scope="module")
def before(spark, tmp_path_factory):
    """A base with one run, and the feed of the next one."""
    folder = tmp_path_factory.mktemp("before")
    run_pipeline(spark, raw_feed(spark, str(folder / "old"), 3), str(folder / "base"))
    raw_feed(spark, str(folder / "new"), 5)
    return folder


# Ended before each of the writes, and after the last one.
@pytest.mark.parametrize("step, after", [*[(i, False) for i in range(len(WRITES))], (len(WRITES) - 1, True)])
def test_killed_run_leaves_readers_on_the_run_before(spark, before, tmp_path, monkeypatch, step, after):
    base = str(shutil.copytree(before / "base", tmp_path / "base"))
    first, done = current_run(spark, base), []

    def counted(name):
        original = getattr(pipeline, name)

        def write(*args, **options):
            mine = len(done) == step
            done.append(name)
            if mine and not after:
                raise Killed
            result = original(*args, **options)
            if mine:
                raise Killed
            return result

        return write

    with monkeypatch.context() as patch:
        for name in set(WRITES):
            patch.setattr(pipeline, name, counted(name))
        with pytest.raises(Killed):
            run_pipeline(spark, str(before / "new"), base)
    assert done == WRITES[: step + 1]
    committed = step == len(WRITES) - 1 and after
    expected = 5 if committed else 3
    assert (current_run(spark, base) == first) is not committed
    assert read_fact(spark, base).count() == expected
    for name in ("agg_monthly_spend", "agg_denial_by_provider_type", "agg_provider_outliers"):
        column = "total_claims" if name == "agg_denial_by_provider_type" else "claim_count"
        for table in (read_aggregate(spark, base, name), read_aggregate_csv(spark, base, name)):
            assert sum(r[column] for r in table.collect()) == expected


def test_manifest_holds_the_audit(spark, tmp_path):
    base = str(tmp_path / "base")
    path = raw_feed(spark, str(tmp_path / "raw"), 4)
    rows_ = [RAW_DEFAULT | {"claim_id": "c0"}, RAW_DEFAULT | {"claim_id": None},
             RAW_DEFAULT | {"claim_id": "x", "member_id": None, "claim_status": "open"},
             RAW_DEFAULT | {"claim_id": "y", "billed_amount": "-1"}, RAW_DEFAULT | {"claim_id": "y", "billed_amount": "-1"},
             RAW_DEFAULT | {"claim_id": "z", "service_date": "soon", "billed_amount": "much"}]
    more = spark.createDataFrame([tuple(r.values()) for r in rows_], ", ".join(f"{c} string" for c in RAW_DEFAULT))
    more.write.mode("append").option("header", True).csv(path)
    assert tuple(run_pipeline(spark, path, base)) == (10, 4)
    run = current_run(spark, base)
    assert (run.raw_rows, run.clean_rows) == (10, 4)
    assert run.rejected == {
        "claim_id_missing": 1, "member_id_missing": 1, "service_date_unreadable": 1, "claim_status_unknown": 1,
        "billed_amount_negative": 2, "billed_amount_unreadable": 1,
    }


def test_raw_feed_is_read_once(spark, tmp_path, monkeypatch):
    base, path = str(tmp_path / "base"), raw_feed(spark, str(tmp_path / "raw"), 3)
    load, calls = pipeline.load_raw, []
    monkeypatch.setattr(pipeline, "load_raw", lambda *a: calls.append(load(*a)) or calls[-1])
    # The files go once the fact is written: a second scan of the feed would fail.
    write = pipeline.write_audited_fact

    def then_gone(*args):
        counts = write(*args)
        for file in (tmp_path / "raw").iterdir():
            file.unlink()
        return counts

    monkeypatch.setattr(pipeline, "write_audited_fact", then_gone)
    assert tuple(run_pipeline(spark, path, base)) == (3, 3) and len(calls) == 1


def test_reader_never_misses_a_view(spark, tmp_path):
    base, name = str(tmp_path / "base"), "claims_switched"
    small, large = (raw_feed(spark, str(tmp_path / f"raw{n}"), n) for n in (3, 5))
    publish(spark, small, base, name, fact_csv=False)
    folders = {n: publish(spark, f, base, name, fact_csv=False)[0] for n, f in ((5, large), (3, small))}
    assert set(folders) == {3, 5}
    seen, failures, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(f"{name}.claims").count())
                spark.table(f"{name}.agg_monthly_spend").schema
            except Exception as e:  # noqa: BLE001
                failures.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for path in (large, small) * 2:
        publish(spark, path, base, name, fact_csv=False)
    stop.set()
    reader.join()
    assert not failures and seen <= {3, 5} and seen
    assert list_tables(spark, name) == sorted(["claims", *AGGREGATES])


def test_views_replace_external_tables_and_refuse_managed_ones(spark, tmp_path):
    base, name = str(tmp_path / "base"), "claims_views"
    with pytest.raises(ValueError, match="no run"):
        publish_views(spark, base, name)
    run_pipeline(spark, raw_feed(spark, str(tmp_path / "raw"), 3), base, fact_csv=False)
    register_curated(spark, base, name)
    publish_views(spark, base, name)
    assert spark.catalog.getTable(f"{name}.claims").tableType == "VIEW"
    assert spark.table(f"{name}.claims").count() == 3
    spark.sql(f"DROP VIEW {name}.agg_readmissions")
    spark.sql(f"CREATE TABLE {name}.agg_readmissions (x int) USING PARQUET")
    with pytest.raises(ValueError, match="managed"):
        publish_views(spark, base, name)


def test_expiry(spark, tmp_path):
    base, name = str(tmp_path / "base"), "claims_expiry"
    path = raw_feed(spark, str(tmp_path / "raw"), 2)
    for _ in range(4):
        publish(spark, path, base, name, fact_csv=False)
    (tmp_path / "base/runs/20000101t000000000000_dead").mkdir()  # a run that was killed
    ids = [r.run_id for r in committed_runs(spark, base)]
    later = datetime.now(UTC) + timedelta(days=2)
    assert expired_runs(spark, base) == []
    assert expired_runs(spark, base, now=later) == sorted([*ids[2:], "20000101t000000000000_dead"])
    assert expired_runs(spark, base, keep=3, now=later) == sorted([ids[3], "20000101t000000000000_dead"])
    gone = expire_runs(spark, base, now=later)
    forget_runs(spark, gone, name)
    assert sorted(p.name for p in (tmp_path / "base/runs").iterdir()) == sorted(ids[:2])
    assert expired_runs(spark, base, now=later) == []
    assert spark.table(f"{name}.claims").count() == 2
    assert not [t for t in spark.catalog.listTables(f"{name}_runs") if t.name.endswith(ids[3])]
    with pytest.raises(ValueError):
        expired_runs(spark, base, keep=0)


def test_paths_of_tables_follow_the_current_run(spark, claims, tmp_path):
    base = str(tmp_path / "base")
    assert run_folder(spark, base) == base
    write_fact(claims({}), base)  # a folder without commits is read as it is
    assert read_fact(spark, base).count() == read_fact_by_path(spark, table_path(base, "claims")).count() == 1
    run_pipeline(spark, raw_feed(spark, str(tmp_path / "raw"), 3), base, fact_csv=False)
    assert read_fact(spark, base).count() == read_fact_by_path(spark, table_path(base, "claims")).count() == 3


def test_failing_load_leaves_the_warehouse_table(spark, claims, tmp_path, monkeypatch):
    table, staged = "wh_safe.claims", str(tmp_path / "staged")
    claims({"claim_id": "a"}, {"claim_id": "b"}).write.parquet(f"{staged}/2026-01")
    old = rows(load_warehouse(spark, staged, table))
    claims({"claim_id": "c"}).write.mode("overwrite").parquet(f"{staged}/2026-01")
    (tmp_path / "staged/2026-01/broken.parquet").write_bytes(b"PAR1 this is no footer PAR1")
    with pytest.raises(Exception):  # noqa: B017
        load_warehouse(spark, staged, table)
    (tmp_path / "staged/2026-01/broken.parquet").unlink()
    with monkeypatch.context() as patch:  # a load that loses rows
        whole = catalog.read_fact_by_path(spark, staged)

        class Losing:
            write, count = whole.limit(0).write, whole.count

        patch.setattr(catalog, "read_fact_by_path", lambda *a: Losing)
        with pytest.raises(RuntimeError, match="1 rows, 0 of them"):
            load_warehouse(spark, staged, table)
    assert rows(spark.table(table)) == old
    assert list_tables(spark, "wh_safe") == ["claims"]
    assert [r["claim_id"] for r in rows(load_warehouse(spark, staged, table))] == ["c"]
    assert list_tables(spark, "wh_safe") == ["claims"]


def test_command_line_expires(spark, tmp_path, capsys):
    base, path = str(tmp_path / "base"), raw_feed(spark, str(tmp_path / "raw"), 2)
    main(["--input", path, "--output-base", base, "--no-fact-csv", "--publish", "--database", "claims_cli2", "--expire", "1"])
    printed = capsys.readouterr().out
    assert "Expired runs: 0" in printed and "member_id_missing: 0" in printed
    stored = read_aggregate(spark, base, "agg_monthly_spend")
    assert row_differences(spark.table("claims_cli2.agg_monthly_spend"), stored).count() == 0


def test_files_of_one_directory_may_differ(spark, claims, tmp_path):
    """Double, text and decimal money, a text date, other columns: all in one month's directory."""
    target, frames = str(tmp_path / "staged/service_month=2026-01"), []
    for i, money in enumerate(("double", "string", "decimal(9,4)")):
        frame = claims({"claim_id": f"c{i}", "paid_amount": f"{i}.25"}).drop("service_month")
        frame = frame.withColumns({c: frame[c].cast(money) for c in ("billed_amount", "allowed_amount", "paid_amount")})
        frames.append(frame if i else frame.withColumn("service_date", frame["service_date"].cast("string")).drop("denial_reason"))
    for frame in frames:
        frame.write.mode("append").parquet(target)
    kinds = tables.file_schemas(spark, str(tmp_path / "staged"))
    assert kinds.count() >= 3 and kinds.select("file_schema").distinct().count() == 3
    loaded = {r["claim_id"]: r for r in rows(read_fact_by_path(spark, str(tmp_path / "staged")))}
    assert {k: r["paid_amount"] for k, r in loaded.items()} == {"c0": 0.25, "c1": 1.25, "c2": 2.25}
    assert {r["service_month"] for r in loaded.values()} == {"2026-01"}
    assert len({r["service_date"] for r in loaded.values()}) == 1


def test_footers_of_a_store_that_only_spark_reads(spark, claims, tmp_path, monkeypatch):
    claims({"claim_id": "a"}).write.parquet(str(tmp_path / "2026-01"))
    direct = {r["path"]: r["file_schema"] for r in rows(tables.file_schemas(spark, str(tmp_path)))}

    def unknown(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.nulls(batch.num_rows, pa.string())], ["path", "file_schema"])

    monkeypatch.setattr(tables, "_footers", unknown)
    assert {r["path"]: r["file_schema"] for r in rows(tables.file_schemas(spark, str(tmp_path)))} == direct
