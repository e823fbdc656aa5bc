"""Rows brought together by a column, with few bytes of each in the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEPARATOR, _NULL = "\x1f", "\x00"


def rebalanced(df: DataFrame, by: str, key: str = "claim_id") -> DataFrame:
    """``df.hint("rebalance", by)``, for which the text of a row travels as one value.

    A shuffled row has eight bytes and padding for each of its text columns, which compression
    does not take away. Lower-case hexadecimal text in ``key`` travels as its bytes. Rows whose text
    holds one of the two marks, or is no valid UTF-8, travel as they are: nothing changes.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name != by]
    if len(texts) < 2:
        return df.hint("rebalance", by)
    whole, content = F.struct(*texts), F.concat_ws("", *texts)
    odd = content.contains(_SEPARATOR) | content.contains(_NULL) | ~F.is_valid_utf8(content)
    digits = F.when(F.lower(F.hex(F.unhex(key))) == F.col(key), F.unhex(key)) if key in texts else F.lit(None).cast("binary")
    marked = df.withColumns({"_odd": odd, "_digits": digits})
    values = [
        F.when(F.col("_digits").isNotNull(), "").otherwise(F.coalesce(c, F.lit(_NULL))) if c == key else F.coalesce(c, F.lit(_NULL))
        for c in texts
    ]
    sent = marked.select(
        *[c for c in df.columns if c not in texts],
        F.when(~F.col("_odd"), F.col("_digits")).alias("_digits"),
        F.when(~F.col("_odd"), F.concat_ws(_SEPARATOR, *values)).alias("_text"),
        F.when(F.col("_odd"), whole).alias("_whole"),
    ).hint("rebalance", by).withColumn("_values", F.split("_text", _SEPARATOR, -1))

    def back(column: str):
        if column not in texts:
            return F.col(column)
        value = F.nullif(F.get("_values", F.lit(texts.index(column))), F.lit(_NULL))
        value = F.coalesce(F.lower(F.hex("_digits")), value) if column == key else value
        return F.when(F.col("_text").isNull(), F.col(f"_whole.{column}")).otherwise(value).alias(column)

    return sent.select(*[back(c) for c in df.columns])
