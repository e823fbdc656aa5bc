"""Numpy helpers on Arrow string columns: texts are read as bytes, never as Python strings.

They run inside Spark tasks, on one Arrow batch at a time. A batch is walked in
segments, so what they allocate follows the segment and the words, not the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEGMENT_BYTES = 1 << 17  # what is allocated for one fits a core's cache

# White space that separates words: blank and the control characters 9 to 13.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# ASCII capitals to small letters; all other bytes, UTF-8 parts included, stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (a SplitMix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
# Codes inside words: white space counts nothing, and capitals count as small letters or not.
_EXACT = np.where(IS_SPACE, np.uint64(0), BYTE_CODES)
_LOWERED = _EXACT[LOWER]
_FACTOR = 0xD6E8FEB86659FD93  # odd: its powers never vanish and it has an inverse
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_FACTOR, SEGMENT_BYTES), _powers(_INVERSE, SEGMENT_BYTES)


def _is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 0x20) | (raw - np.uint8(0x09) <= 0x04)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[first[0] : first[-1]], first - first[0]


def small_batches(batches, column: str = "text", most_bytes: int = 4 << 20):
    """The same rows in batches of about ``most_bytes`` of text; a longer text is alone."""
    for batch in batches:
        at = column_bytes(batch.column(column))[1]
        row, n = 0, batch.num_rows
        if not n:
            yield batch
        while row < n:
            end = max(row + 1, int(np.searchsorted(at, at[row] + most_bytes, "right")) - 1)
            yield batch.slice(row, end - row)
            row = end


def _segments(raw: np.ndarray, offsets: np.ndarray):
    """Ranges that cover ``raw`` and end at white space or between rows."""
    start, n = 0, len(raw)
    while start < n:
        end = min(start + SEGMENT_BYTES, n)
        if end < n:
            spaces = np.flatnonzero(_is_space(raw[start:end]))
            rows = offsets[np.searchsorted(offsets, end, "right") - 1]
            cut = max(start + (spaces[-1] + 1 if len(spaces) else 0), rows)
            if cut <= start:  # one word longer than a segment: go on to its end
                cut = int(offsets[np.searchsorted(offsets, start, "right")])
                after = end
                while after < cut:
                    more = np.flatnonzero(_is_space(raw[after : min(after + SEGMENT_BYTES, cut)]))
                    if len(more):
                        cut = after + int(more[0]) + 1
                        break
                    after += SEGMENT_BYTES
            end = int(cut)
        yield start, end
        start = end


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """64-bit hashes of all words, their lengths in bytes, and the word offsets of the rows.

    A word is a run of bytes other than white space; it never spans two rows.
    """
    hashes, starts_at, lengths = [], [], []
    table = _LOWERED if lower else _EXACT
    row_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    for start, end in _segments(raw, offsets):
        part = raw[start:end]
        n = len(part)
        inside = ~_is_space(part)
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        own = row_starts[np.searchsorted(row_starts, start) : np.searchsorted(row_starts, end)] - start
        begins[own] = inside[own]
        own = own[own > 0]
        stops[own - 1] = inside[own - 1]
        at, to = np.flatnonzero(begins), np.flatnonzero(stops)
        if not len(at):
            continue
        up, down = (_UP[:n], _DOWN) if n <= len(_UP) else (_powers(_FACTOR, n), _powers(_INVERSE, n))
        codes = table[part] * up
        total = np.cumsum(codes)
        # The place of a word in its segment cancels out.
        hashes.append((total[to] - total[at] + codes[at]) * down[at])
        lengths.append(to - at + 1)
        starts_at.append(at + start)
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, np.zeros(len(offsets), np.int64)
    position = np.concatenate(starts_at)
    size = np.concatenate(lengths)
    return mix64(np.concatenate(hashes) + size.astype(np.uint64)), size, np.searchsorted(position, offsets)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each row's range; 0 for an empty range.

    Each row is summed by itself, so its sum does not depend on the rows beside it.
    """
    out = np.zeros(len(offsets) - 1, np.float64)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        used = np.asarray(values[: offsets[-1]], np.float64)
        out[full] = np.add.reduceat(used, offsets[full])
    return out


def class_counts(raw: np.ndarray, offsets: np.ndarray, classes: list[np.ndarray]) -> np.ndarray:
    """How many bytes of each row are in each class: (rows x classes), three classes at most.

    The counts of a segment share one 64-bit sum, 21 bits each.
    """
    table = np.zeros(256, np.int64)
    for i, members in enumerate(classes):
        table += members.astype(np.int64) << (21 * i)
    out = np.zeros((len(offsets) - 1, len(classes)), np.int64)
    for start in range(0, len(raw), SEGMENT_BYTES):
        end = min(start + SEGMENT_BYTES, len(raw))
        first = np.searchsorted(offsets, start, "right") - 1
        last = np.searchsorted(offsets, end, "left")
        total = np.zeros(end - start + 1, np.int64)
        np.cumsum(table[raw[start:end]], out=total[1:])
        at = total[np.clip(offsets[first : last + 1], start, end) - start]
        packed = at[1:] - at[:-1]
        for i in range(len(classes)):
            out[first:last, i] += packed >> (21 * i) & 0x1FFFFF
    return out
