from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def dollars(amount: Column) -> Column:
    """An exact money amount as the double that leaves a query."""
    return amount.cast("double")


def exact_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``round(numerator / denominator, digits)``, half up, on decimals.

    Dividing doubles first would round ties such as 41745.505 by their binary
    neighbour. decimal(22,2) over decimal(20,0) leaves Spark at least 14
    fractional digits before the final rounding. A zero denominator gives NULL.
    """
    quotient = F.try_divide(numerator.cast("decimal(22,2)"), denominator.cast("decimal(20,0)"))
    return F.round(quotient, digits).cast("double")


def null_aware_hash(columns: Iterable[str]) -> Column:
    """64-bit hash of a row.

    ``xxhash64`` skips NULLs, so (1, NULL) and (NULL, 1) would tie; the null
    marker of every column goes into the hash as well.
    """
    return F.expr("xxhash64(" + ", ".join(f"`{c}`, `{c}` IS NULL" for c in columns) + ")")


def millions_label(amount: Column) -> Column:
    """Axis label in millions, such as ``$43.2M``."""
    millions = F.round(amount.cast("decimal(22,2)") / F.lit(1_000_000), 1).cast("decimal(20,1)")
    return F.concat(F.lit("$"), millions.cast("string"), F.lit("M"))


def percent_label(rate: Column) -> Column:
    """Axis label for a share between 0 and 1, such as ``8.1%``."""
    percent = F.round(rate.cast("decimal(20,4)") * F.lit(100), 1).cast("decimal(20,1)")
    return F.concat(percent.cast("string"), F.lit("%"))
