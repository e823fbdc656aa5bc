"""The end-to-end job: raw feed in, curated fact and six aggregates out."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession

from payerlens.operators.cleaning import rules, survivors_with_reasons
from payerlens.operators.providers import provider_outliers, provider_profile
from payerlens.operators.summary import claim_summary
from payerlens.plans.reports import AGGREGATES, FROM_SUMMARY, REPORTS
from payerlens.plans.workspace import store
from payerlens.session import build_session
from payerlens.sources.catalog import DATABASE, forget_runs, list_tables, publish_views
from payerlens.sources.raw_csv import load_raw
from payerlens.sources.runs import commit_run, current_run, expire_runs, new_run
from payerlens.sources.tables import (
    FACT,
    read_fact,
    table_path,
    write_aggregate,
    write_audited_fact,
    write_fact_csv,
)


class Audit(NamedTuple):
    raw_rows: int
    clean_rows: int


def run_pipeline(
    spark: SparkSession,
    input_path: str,
    output_base: str,
    z_threshold: float = 2.0,
    fact_csv: bool = True,
) -> Audit:
    """Cleans once and writes the fact; everything else reads the written fact.

    All tables go into a new run folder below ``output_base``; the run is committed when the
    last one is complete, and only then do readers of the base see it (``sources.runs``).
    A run that fails or is killed leaves them on the run before.

    The feed is read once. It is parsed and de-duplicated a single time, the audit is counted while
    the fact is written, and all outputs agree. The fact is scanned for its CSV copy, the
    provider profile, the monthly spend and a summary from which the other four aggregates
    follow, each time with the columns in question. A lost executor costs the current job's
    tasks, not the work already written.
    """
    return _run(spark, input_path, output_base, z_threshold, fact_csv)[1]


def _run(
    spark: SparkSession, input_path: str, output_base: str, z_threshold: float, fact_csv: bool
) -> tuple[str, Audit]:
    run_id, run_base = new_run(output_base)
    counts = write_audited_fact(survivors_with_reasons(load_raw(spark, input_path)), run_base)
    fact = read_fact(spark, run_base)
    if fact_csv:
        write_fact_csv(spark, run_base)
    profile = store(provider_profile(fact), table_path(run_base, "_work/provider_profile"))
    summary = store(claim_summary(fact), table_path(run_base, "_work/claim_summary"))
    for table, report in AGGREGATES.items():
        if report == "provider_outliers":
            aggregate = provider_outliers(profile, z_threshold)
        elif report in FROM_SUMMARY:
            aggregate = FROM_SUMMARY[report](summary)
        else:
            aggregate = REPORTS[report].build(fact)
        write_aggregate(aggregate, run_base, table)
    audit = Audit(counts["raw_rows"], counts["clean_rows"])
    rejected = {rule: counts[rule] for rule in rules()}
    commit_run(spark, output_base, run_id, [FACT, *AGGREGATES], *audit, rejected)
    return run_base, audit


def publish(
    spark: SparkSession,
    input_path: str,
    output_base: str,
    database: str = DATABASE,
    z_threshold: float = 2.0,
    fact_csv: bool = True,
) -> tuple[str, Audit]:
    """Runs the pipeline and switches the catalog's views to the new run.

    A run that fails leaves the catalog as it was, over the tables of the run before.
    Returns the run's folder and the audit.
    """
    run_base, audit = _run(spark, input_path, output_base, z_threshold, fact_csv)
    publish_views(spark, output_base, database)
    return run_base, audit


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the curated claims tables.")
    parser.add_argument("--input", required=True, help="raw claims CSV, file or directory")
    parser.add_argument("--output-base", required=True, help="directory of the curated tables")
    parser.add_argument("--z-threshold", type=float, default=2.0)
    parser.add_argument("--no-fact-csv", action="store_true", help="skip the fact's CSV copy")
    parser.add_argument(
        "--register", "--publish", dest="register", action="store_true",
        help="switch the catalog's views to the new run",
    )
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument(
        "--expire", type=int, metavar="N",
        help="afterwards delete runs that at least N newer ones replaced, the newest a day ago or earlier",
    )
    args = parser.parse_args(argv)

    spark = build_session("payerlens-pipeline")
    base, audit = _run(spark, args.input, args.output_base, args.z_threshold, not args.no_fact_csv)
    print(f"Run folder: {base}")
    if args.register:
        publish_views(spark, args.output_base, args.database)
        print("Tables: " + ", ".join(list_tables(spark, args.database)))
    print(f"Raw rows: {audit.raw_rows}, clean rows: {audit.clean_rows}")
    for rule, claims in current_run(spark, args.output_base).rejected.items():
        print(f"{rule}: {claims}")
    if args.expire:
        gone = expire_runs(spark, args.output_base, keep=args.expire)
        forget_runs(spark, gone, args.database)
        print(f"Expired runs: {len(gone)}")


if __name__ == "__main__":
    main(sys.argv[1:])
