"""Text columns in Arrow batches: bounded slices, words and their hashes in numpy.

A slice holds whole documents: as many as fit a byte limit, at least one. All work on
words is array work over the slice's UTF-8 bytes, so no Python object exists per word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom import session

SLICE_BYTES = 2 << 20
BATCH_ROWS = 1_000

# Fixed: the six ASCII blanks that end a word.
BLANKS = b"\x09\x0a\x0b\x0c\x0d\x20"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
U64 = np.uint64


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


NOT_BLANK = ~byte_table(BLANKS)

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """For jobs run meanwhile: Arrow batches of whole texts that take a few megabytes."""
    return session.setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def plainly_named(documents: DataFrame, kept: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """Documents under names that nothing else uses, but for the ``kept`` columns, and the
    columns to select in the end: whatever the caller's are called, they come back as they were."""
    names = [c if c in kept else f"column{i}" for i, c in enumerate(documents.columns)]
    return documents.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, documents.columns, strict=True)]


class Texts:
    """The texts of some rows as one byte array with row bounds; null counts as empty."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
        offsets = offsets[column.offset : column.offset + len(column) + 1]
        self.column = column
        self.bounds = offsets - (offsets[0] if len(offsets) else 0)
        data = column.buffers()[2]
        whole = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]] if len(offsets) else whole[:0]

    def __len__(self) -> int:
        return len(self.column)

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows_of(self, positions: np.ndarray) -> np.ndarray:
        """The row that holds each byte position."""
        return np.searchsorted(self.bounds, positions, side="right") - 1


def slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def runs(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of bytes for which ``inside`` holds, row by row."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.zeros(n + 1, dtype=bool)
    breaks[texts.bounds] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    starts = np.flatnonzero(inside & (~before | breaks[:-1]))
    ends = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    return starts, ends


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_POWER_STEP = 1 << 18
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers_of(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse; the longest run asked for is kept."""
    if len(_powers[0]) < size:
        length = -(-size // _POWER_STEP) * _POWER_STEP
        with np.errstate(over="ignore"):
            for k, factor in enumerate((_BASE, _INVERSE)):
                power = np.full(length, factor, dtype=np.uint64)
                power[0] = 1
                _powers[k] = np.cumprod(power, out=power)
    return _powers


class Hasher:
    """64-bit hashes of any spans of a byte array, each from two running sums."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers_of(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            sums[1:] = data
            sums[1:] += U64(1)
            sums[1:] *= up[: len(data)]
            np.cumsum(sums, out=sums)
        self._sums = sums

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = (self._sums[ends] - self._sums[starts]) * self._down[starts]
            return mix(value + (ends - starts).astype(np.uint64))


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` neighbours in an array of word hashes."""
    count = max(0, len(words) - size + 1)
    value = np.zeros(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            value = mix(value * U64(3) + words[k : k + count] + U64(k + 1))
    return value
