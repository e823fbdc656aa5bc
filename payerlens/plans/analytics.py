"""Analyst reports and chart feeds over curated tables that a pipeline run has stored."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payerlens.operators.providers import provider_profile, top_providers
from payerlens.plans.reports import AGGREGATES, FEEDS, REPORTS
from payerlens.schemas import MONTH
from payerlens.session import build_session
from payerlens.sources.runs import run_folder
from payerlens.sources.tables import read_aggregate, read_aggregate_csv, read_fact, table_path

ANALYST_REPORTS = [
    "pmpm", "mom_trend", "submission_lag", "high_utilizers", "denial_trend", "top_providers",
    "age_diagnosis_cost",
]


def analyst_reports(
    fact: DataFrame, outliers: DataFrame, first_month: str | None = None
) -> dict[str, DataFrame]:
    """The seven analyst questions; flags of top providers come from the stored table.

    ``first_month`` limits them. The trend compares each month with the one before it, so it
    is computed first and cut afterwards: its first month keeps its change.
    """
    recent = fact if first_month is None else fact.where(F.col(MONTH) >= first_month)
    reports = {
        n: REPORTS[n].run(recent) for n in ANALYST_REPORTS if n not in ("top_providers", "mom_trend")
    }
    trend = REPORTS["mom_trend"].run(fact)
    reports["mom_trend"] = (
        trend if first_month is None else trend.where(F.col(MONTH) >= first_month)
    )
    reports["top_providers"] = top_providers(provider_profile(recent), outliers).orderBy(
        *REPORTS["top_providers"].sort_columns()
    )
    return {name: reports[name] for name in ANALYST_REPORTS}


def chart_feeds(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The five chart tables, from the CSV copies of the stored aggregates."""
    table_of = {report: table for table, report in AGGREGATES.items()}
    aggregates = {
        source: read_aggregate_csv(spark, base, table_of[source]) for source, _ in FEEDS.values()
    }
    return {name: feed.run(aggregates[source]) for name, (source, feed) in FEEDS.items()}


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the analyst reports and chart feeds.")
    parser.add_argument("--curated-base", required=True)
    parser.add_argument("--first-month", help="yyyy-MM; limits the analyst reports")
    parser.add_argument("--last-month", help="yyyy-MM; limits the analyst reports")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="write each result whole as a CSV table below this path")
    target.add_argument("--preview", type=int, metavar="N", help="only print N rows of each result")
    args = parser.parse_args(argv)

    spark = build_session("payerlens-analytics")
    base = run_folder(spark, args.curated_base)  # once, so that all results are of one run
    fact = read_fact(spark, base, last_month=args.last_month)
    outliers = read_aggregate(spark, base, "agg_provider_outliers")
    reports = analyst_reports(fact, outliers, args.first_month)
    results = reports | chart_feeds(spark, base)
    for name, result in results.items():
        if args.out:
            result.write.mode("overwrite").option("header", True).csv(table_path(args.out, name))
        else:
            print(name)
            result.show(args.preview, truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
