"""Word counts as token counts, in Spark built-ins.

A word is a run of characters other than blank and the control characters 9 to 13,
as in the near-duplicate operator. The operators take any column as a token count; this
is the one that the registered queries use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
