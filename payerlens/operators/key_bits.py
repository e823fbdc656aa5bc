"""Membership of 64-bit key hashes in a set, as bit maps of a bounded size.

A hash has one of 2^28 places; the bits of the places that occur are at most 32 MB, so every
task can have them. A hash whose bit is not set is not in the set. A set bit may belong to
another hash as well: whoever acts on set bits does exact work on those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES, _CHUNK = 1 << 28, 1 << 15  # 32,768 places a row, as Spark's bit maps have


def key_bits(hashes: DataFrame, column: str) -> DataFrame:
    """(chunk, bits) of the places that ``column`` takes: 8,192 rows of 4 KB at most."""
    place = F.pmod(F.col(column), F.lit(PLACES))
    return (
        hashes.select(
            F.shiftright(place, 15).alias("chunk"), place.bitwiseAND(_CHUNK - 1).alias("_at"),
        )
        .repartition("chunk").groupBy("chunk").agg(F.bitmap_construct_agg("_at").alias("bits"))
    )


def with_bit(df: DataFrame, column: str, bits: DataFrame, name: str) -> DataFrame:
    """``df`` and the boolean ``name``: is the bit of the hash in ``column`` set?"""
    place = F.pmod(F.col(column), F.lit(PLACES))
    at = place.bitwiseAND(_CHUNK - 1)
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10)
    one = F.call_function("shiftright", byte.cast("int"), at.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1
    return (
        df.withColumn("_chunk", F.shiftright(place, 15))
        .join(F.broadcast(bits.withColumnRenamed("chunk", "_chunk")), "_chunk", "left")
        .withColumn(name, F.coalesce(one, F.lit(False)))
        .drop("_chunk", "bits")
    )
