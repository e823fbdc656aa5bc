"""Column-expression helpers; all of them compile to built-in Catalyst expressions."""

from payerlens.functions.expressions import (
    dollars,
    exact_ratio,
    millions_label,
    null_aware_hash,
    percent_label,
)

__all__ = ["dollars", "exact_ratio", "millions_label", "null_aware_hash", "percent_label"]
