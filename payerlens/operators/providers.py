"""Provider roll-ups, cost outliers and submission lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payerlens.functions import dollars, exact_ratio

_KEYS = ["provider_id", "provider_type"]


def provider_profile(claims: DataFrame) -> DataFrame:
    """One row per (provider, type): volume, billed and paid totals, average billed."""
    billed = F.sum("billed_amount")
    return claims.groupBy(*_KEYS).agg(
        exact_ratio(billed, F.count("billed_amount"), 2).alias("avg_billed"),
        F.count("*").alias("claim_count"),
        dollars(billed).alias("total_billed"),
        dollars(F.sum("paid_amount")).alias("total_paid"),
    )


def _moments() -> list[Column]:
    cents = (F.col("avg_billed").cast("decimal(18,2)") * 100).cast("decimal(19,0)")
    square = F.try_multiply(cents, cents).cast("decimal(38,0)")
    overflow = F.max(cents.isNotNull() & square.isNull())
    return [
        F.count(cents).alias("n"),
        F.coalesce(F.sum(cents.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("total"),
        F.when(~F.coalesce(overflow, F.lit(False)), F.coalesce(F.try_sum(square), F.lit(0)))
        .cast("decimal(38,0)").alias("squares"),
    ]


def cohort_moments(profile: DataFrame) -> DataFrame:
    """(n, total, squares) of the averages in cents: exact integers, so moments of parts add up.

    ``squares`` is NULL where 38 digits do not hold it.
    """
    return profile.agg(*_moments())


def add_moments(moments: DataFrame) -> DataFrame:
    """The moments of all parts together."""
    return moments.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(38,0)").alias("total"),
        F.when(F.count("squares") == F.count("*"), F.coalesce(F.try_sum("squares"), F.lit(0)))
        .cast("decimal(38,0)").alias("squares"),
    )


def mean_of_moments() -> Column:
    """Mean in dollars; 0 without values."""
    return F.coalesce(
        F.try_divide(F.col("total").cast("double"), F.col("n").cast("double")) / 100, F.lit(0.0)
    )


def deviation_of_moments() -> Column:
    """Sample deviation in dollars; 0 for fewer than two values.

    n * squares - total * total is exact where 38 digits hold it. Beyond that doubles take
    over, still as a function of the exact moments. NULL without the sum of squares.
    """
    n = F.col("n").cast("decimal(19,0)")
    exact = F.try_subtract(
        F.try_multiply(n, F.col("squares")).cast("decimal(38,0)"),
        F.try_multiply(F.col("total"), F.col("total")).cast("decimal(38,0)"),
    ).cast("double")
    total, squares = F.col("total").cast("double"), F.col("squares").cast("double")
    rough = F.greatest(F.col("n") * squares - total * total, F.lit(0.0))
    pairs = F.col("n").cast("double") * (F.col("n") - 1)
    return F.when(F.col("n") > 1, F.sqrt(F.coalesce(exact, rough) / pairs) / 100).otherwise(0.0)


def provider_outliers(profile: DataFrame, z_threshold: float = 2.0) -> DataFrame:
    """Every provider of a profile with its z-score flag.

    The profile is read twice, for the cohort and for the rows: pass a stored
    one where it comes from an expensive plan. Mean and sample deviation are
    taken over the rounded averages, from exact moments: threshold and flag are the same
    to the last bit however the rows are partitioned. They reach the rows as a scalar subquery:
    no driver round trip, no join. The flag compares with the unrounded
    threshold. One provider has no deviation, so its threshold is the mean.
    """
    deviation = F.coalesce(deviation_of_moments(), "rough", F.lit(0.0))
    cohort = profile.agg(*_moments(), F.stddev_samp("avg_billed").alias("rough")).select(
        F.struct(mean_of_moments().alias("mean"), deviation.alias("deviation")).alias("cohort")
    ).scalar()
    threshold = cohort["mean"] + F.lit(float(z_threshold)) * cohort["deviation"]
    return profile.select(
        *_KEYS,
        "avg_billed",
        "claim_count",
        "total_billed",
        F.round(cohort["mean"], 2).alias("cohort_mean_avg_billed"),
        F.round(threshold, 2).alias("outlier_threshold"),
        (F.col("avg_billed") > threshold).alias("is_cost_outlier"),
    )


def top_providers(rollup: DataFrame, outliers: DataFrame, n: int = 10) -> DataFrame:
    """The n providers with the highest paid total, each with its outlier flag.

    ``rollup`` is aggregated already and reduced to n rows before the left join,
    so the fact never meets the outlier table. The join uses both keys of that
    table: on provider_id alone, a provider with two types would have every
    claim counted twice. Providers without a flag keep their place.
    """
    # The keys break ties: they decide who is in the list.
    top = (
        rollup.select(*_KEYS, "total_paid", "claim_count")
        .orderBy(F.desc("total_paid"), *_KEYS)
        .limit(n)
        .alias("t")
    )
    flags = outliers.select(*_KEYS, "is_cost_outlier").alias("o")
    same = (F.col("t.provider_id") == F.col("o.provider_id")) & F.col(
        "t.provider_type"
    ).eqNullSafe(F.col("o.provider_type"))
    return top.join(flags, same, "left").select("t.*", "o.is_cost_outlier")


def submission_lag(claims: DataFrame) -> DataFrame:
    """Average days from service to submission. Missing dates do not count in the
    average but do count as claims."""
    lag = F.date_diff("submission_date", "service_date")
    return claims.groupBy("provider_type").agg(
        exact_ratio(F.sum(lag), F.count(lag), 1).alias("avg_days_to_submit"),
        F.count("*").alias("claim_count"),
    )
