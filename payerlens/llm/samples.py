"""Byte n-gram features and bounded samples for the two text models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payerlens.llm.tables import hash_share
from payerlens.llm.textbytes import IS_SPACE, LOWER

_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def ngram_buckets(raw: np.ndarray, width: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each byte; the last ``width - 1`` are missing.

    ``buckets`` is a power of two.
    """
    n = max(0, len(raw) - width + 1)
    code = np.full(n, np.uint32(width))
    for i in range(width):
        code *= np.uint32(_FACTORS[i % len(_FACTORS)])
        code += raw[i : i + n]
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    code ^= code >> np.uint32(16)
    return code & np.uint32(buckets - 1)


# Letters, other ASCII and white space: for language models all but letters are one blank.
LETTERS = np.where(np.arange(256) >= 0x80, np.arange(256), 0x20).astype(np.uint8)
for _c in (*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)):
    LETTERS[_c] = LOWER[_c]
SQUEEZED = IS_SPACE | (LETTERS == 0x20)


def rows_in_blocks(offsets: np.ndarray, most_bytes: int):
    """Ranges of rows of at most ``most_bytes`` together; a longer row is alone."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most_bytes, "right")) - 1)
        yield row, min(end, n)
        row = min(end, n)


def bounded_sample(rows: DataFrame, keys: list[str], size: int, total: int) -> DataFrame:
    """About ``size`` of ``total`` rows, chosen by the hash of ``keys``; rows that repeat a key count once.

    So the sample is the same however the rows are partitioned, and no key overfills it.
    """
    rate = min(1.0, size / max(total, 1))
    return rows.where(hash_share(F.struct(*keys), rate)).dropDuplicates(keys)


MOST_COUNTED = 8192  # n-gram buckets of one sampled text, the most frequent: bounds what the driver gets


def packed_counts(grams: np.ndarray, buckets: int, most: int = MOST_COUNTED) -> tuple[bytes, bytes]:
    """Buckets (uint16) and shares (float32) of one text's n-grams; ``buckets`` itself is left out."""
    ids, n = np.unique(grams[grams < buckets], return_counts=True)
    share = n / max(n.sum(), 1)
    if len(ids) > most:
        kept = np.sort(np.argsort(-n, kind="stable")[:most])
        ids, share = ids[kept], share[kept]
    return ids.astype(np.uint16).tobytes(), share.astype(np.float32).tobytes()


def unpacked_counts(ids: bytes, share: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.uint16).astype(np.int64), np.frombuffer(share, np.float32).astype(np.float64)
