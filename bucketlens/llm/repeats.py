"""Two Bloom filters over hashes: seen at least once, seen at least twice.

Both are bit arrays, sized from the number of distinct hashes to come. A task sets the
bits of its hashes, once or twice, and reports them by slices, each as positions or as
a bitmap, whichever is shorter. A position set by two tasks, or twice in one, is set in
the second filter. Every hash seen twice or more has all its positions there, so the
second filter misses no repeat; other hashes pass by chance, more of them the fuller
the filter is, and cost an exact comparison later, never a wrong result.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Bits of the filter per distinct hash, rounded up to a power of two: of hashes seen once
# at most one in 20 passes. 2 ** 30 bits, 128 MB, hold 134 million hashes like that; more
# of them fill the filter further.
BITS_PER_HASH = 8
LEAST_BITS, MOST_BITS = 16, 30
# A slice is 8 KB as a bitmap; positions in it take two bytes.
SLICE_BITS = 16
PER_HASH = 2
_SLICE_BYTES = 1 << (SLICE_BITS - 3)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def filter_bits(distinct: int) -> int:
    """The filter's size as a power of two, for about so many distinct hashes."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, distinct) * BITS_PER_HASH))))


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each hash, one row per function."""
    shift = np.uint64(64 - bits)
    return np.stack([hashes >> shift, (hashes * _ODD) >> shift]).astype(np.uint32)


def _is_set(packed_bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed_bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _set(packed_bits: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(packed_bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))


def maybe_repeated(filter_bytes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return _is_set(filter_bytes, positions(hashes, len(filter_bytes).bit_length() + 2)).all(axis=0)


def add_hashes(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray) -> None:
    """Set the bits of ``hashes`` in both filters."""
    at, times = np.unique(positions(hashes, len(once).bit_length() + 2), return_counts=True)
    _set(twice, at[(times > 1) | _is_set(once, at)])
    _set(once, at)


def _shortest(bitmap: np.ndarray) -> bytes:
    """A slice as positions, or as its bitmap where that is no longer."""
    if 2 * int(np.bitwise_count(bitmap).sum()) >= len(bitmap):
        return bitmap.tobytes()
    return np.flatnonzero(np.unpackbits(bitmap, bitorder="little")).astype("<u2").tobytes()


def _bitmap(given: bytes) -> np.ndarray:
    if len(given) == _SLICE_BYTES:
        return np.frombuffer(given, dtype=np.uint8)
    bits = np.zeros(1 << SLICE_BITS, dtype=np.uint8)
    bits[np.frombuffer(given, dtype="<u2")] = 1
    return np.packbits(bits, bitorder="little")


def repeat_filter(df: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """The second filter as bytes, 2 ** ``bits`` bits. ``hashes_of`` gives the uint64 hashes of a batch.

    A task holds two arrays of that size, whatever it reads; all tasks that merge hold two together.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = (np.zeros(1 << (bits - 3), dtype=np.uint8) for _ in range(2))
        for batch in batches:
            add_hashes(once, twice, hashes_of(batch))
        once, twice = once.reshape(-1, _SLICE_BYTES), twice.reshape(-1, _SLICE_BYTES)
        touched = np.flatnonzero(once.any(axis=1))
        schema = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
        for start in range(0, len(touched), 256):
            part = touched[start : start + 256]
            rows = {"slice": part, "once": [_shortest(once[n]) for n in part], "twice": [_shortest(twice[n]) for n in part]}
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for number, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if number not in seen:
                    seen[number] = (np.zeros(_SLICE_BYTES, dtype=np.uint8), np.zeros(_SLICE_BYTES, dtype=np.uint8))
                first, second = seen[number]
                added = _bitmap(once)
                second |= (first & added) | _bitmap(twice)
                first |= added
        schema = pa.schema([("slice", pa.int32()), ("bits", pa.binary())])
        yield pa.RecordBatch.from_pydict({"slice": list(seen), "bits": [_shortest(second) for _, second in seen.values()]}, schema=schema)

    reported = df.mapInArrow(report, "slice INT, once BINARY, twice BINARY")
    merged = reported.repartition("slice").mapInArrow(merge, "slice INT, bits BINARY")
    result = np.zeros((1 << (bits - SLICE_BITS), _SLICE_BYTES), dtype=np.uint8)
    for row in merged.toLocalIterator():
        result[row.slice] = _bitmap(row.bits)
    return result.reshape(-1)
