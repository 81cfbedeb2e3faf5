"""Quality rules by compression bands.

Base rules count words, symbols, repeated lines and repeated 5-word windows. A document
that passes them is compressed with zstandard, as a whole and in fixed chunks. Text that
shrinks more than prose of its length does is repetitive, text that hardly shrinks is
noise; both limits rise with the length, since a longer text offers more to refer back to.
Chunks of several sizes catch documents that are prose in some part only: at most a share of
them may lie outside the band of their size. All limits are those of texts labelled good,
with a margin.

Defined results: a null or empty text has no words and fails the base rules; a null
``doc_id`` is kept as such; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from starloom.llm import resident
from starloom.llm.texts import NOT_BLANK, Hasher, Texts, byte_table, runs, slices, windows

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20


# Least bytes, lowest and highest ratio of the texts labelled good outside the held-out fold
# (check_s, every second label, and sf0.1) that pass the base rules.
GOOD_TEXTS = (
    (64, 0.827, 1.129),
    (91, 0.913, 1.276),
    (128, 1.051, 1.448),
    (182, 1.213, 1.571),
    (256, 1.311, 1.700),
    (363, 1.381, 1.747),
    (512, 1.449, 1.868),
    (725, 1.531, 1.994),
    (1_024, 1.658, 2.060),
    (1_449, 1.770, 2.166),
    (2_048, 1.816, 2.199),
    (2_897, 1.944, 2.233),
    (4_096, 1.954, 2.278),
    (5_793, 2.099, 2.346),
    (8_192, 2.165, 2.388),
    (11_586, 2.230, 2.413),
    (16_384, 2.304, 2.446),
    (23_171, 2.311, 2.487),
    (32_768, 2.342, 2.523),
    (46_341, 2.408, 2.539),
)
# Chunk size, and the same of their chunks.
GOOD_CHUNKS = ((512, 1.235, 1.884), (1_024, 1.452, 2.050), (2_048, 1.749, 2.207))
# No text is labelled good from here on; wide limits.
LONG_TEXTS = ((65_536, 1.6, 2.85), (100_000, 1.6, 3.2))
# Shares by which a limit lies beyond the good texts.
BELOW, ABOVE = 0.05, 0.01


def _beyond(good: tuple[tuple[int, float, float], ...]) -> tuple[tuple[int, float, float], ...]:
    return tuple((size, low * (1 - BELOW), high * (1 + ABOVE)) for size, low, high in good)


@dataclass(frozen=True)
class Bands:
    """Limits on size before by size after compression.

    ``whole`` holds (least bytes, lowest ratio, highest ratio), ascending; the last row that
    a length reaches applies. ``chunks`` holds (bytes, lowest ratio, highest ratio) for each
    size of chunk; a last chunk of less than half the size counts to the one before, and a
    text of a single chunk is judged as a whole only. ``outside`` is the share of the chunks
    of a size beyond which a document goes.
    """

    level: int = 3
    whole: tuple[tuple[int, float, float], ...] = ((0, 0.0, GOOD_TEXTS[0][2] * (1 + ABOVE)), *_beyond(GOOD_TEXTS), *LONG_TEXTS)
    chunks: tuple[tuple[int, float, float], ...] = _beyond(GOOD_CHUNKS)
    outside: float = 0.05


@dataclass(frozen=True)
class Measures:
    """The base counts of a slice's texts, one number a row each."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _by_row_and_value(rows: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by row and value, and whether each item equals the one before in it."""
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    same = np.zeros(len(rows), dtype=bool)
    same[1:] = (rows[order][1:] == rows[order][:-1]) & (value[order][1:] == value[order][:-1])
    return order, same


def measure(texts: Texts) -> Measures:
    data, bounds, count = texts.data, texts.bounds, len(texts)
    solid = NOT_BLANK[data]
    starts, ends = runs(texts, solid)
    rows = texts.rows_of(starts)
    hasher = Hasher(data)

    lines, line_ends = runs(texts, data != 10)
    filled = np.concatenate(([0], np.cumsum(solid)))
    with_word = filled[line_ends] > filled[lines]
    lines, line_ends = lines[with_word], line_ends[with_word]
    line_rows = texts.rows_of(lines)
    order, same = _by_row_and_value(line_rows, hasher.spans(lines, line_ends))
    dup_lines = np.bincount(line_rows[order][same], minlength=count)

    found = windows(hasher.spans(starts, ends), WINDOW)
    inside = rows[: len(found)] == rows[WINDOW - 1 :] if len(found) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    order, same = _by_row_and_value(rows[at], found[at])
    repeated = same.copy()
    repeated[:-1] |= same[1:]
    marks = np.zeros(len(rows) + 1, dtype=np.int64)
    np.add.at(marks, at[order][repeated], 1)
    np.add.at(marks, at[order][repeated] + WINDOW, -1)
    covered = np.cumsum(marks)[:-1] > 0
    return Measures(
        n_words=np.bincount(rows, minlength=count),
        word_chars=_sums(solid & ((data & 0xC0) != 0x80), bounds),
        n_symbols=_sums(byte_table(SYMBOLS)[data], bounds),
        n_dup_lines=dup_lines,
        n_repeat_words=np.bincount(rows[covered], minlength=count),
    )


class Compressor:
    def __init__(self, bands: Bands):
        self._bands = bands
        self._zstd = zstandard.ZstdCompressor(level=bands.level)
        self._least = [row[0] for row in bands.whole]

    def ratio(self, data: memoryview) -> float:
        return len(data) / max(1, len(self._zstd.compress(data)))

    def chunk_ratios(self, data: memoryview, size: int) -> list[float]:
        count = max(1, (len(data) + size // 2) // size)
        cuts = [k * size for k in range(count)] + [len(data)]
        return [self.ratio(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def verdict(self, data: memoryview) -> tuple[bool, float, float]:
        """Whether the text lies in its bands; its ratio and the largest share of chunks outside."""
        ratio = self.ratio(data)
        _, low, high = self._bands.whole[int(np.searchsorted(self._least, len(data), side="right")) - 1]
        outside = 0.0
        for size, low_chunk, high_chunk in self._bands.chunks:
            if 2 * len(data) >= 3 * size:  # else the document is its only chunk
                chunks = np.array(self.chunk_ratios(data, size))
                outside = max(outside, float(((chunks < low_chunk) | (chunks > high_chunk)).mean()))
        return low <= ratio <= high and outside <= self._bands.outside, ratio, outside


def kept_by_label(report: DataFrame, labels: DataFrame) -> DataFrame:
    """Per label ``quality``: documents, and of them those the base rules reject, those the
    bands reject and those kept. A document without a label counts under null."""
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    count = lambda condition: F.count(F.when(condition, 1))
    return (
        report.join(marked, "doc_id", "left")
        .groupBy("quality")
        .agg(
            F.count("*").alias("documents"),
            count(F.col("base_failed")).alias("base_rejected"),
            count(~F.col("base_failed") & ~F.col("kept")).alias("bands_rejected"),
            count(F.col("kept")).alias("kept"),
        )
    )


def quality_report(documents: DataFrame, bands: Bands | None = None) -> DataFrame:
    """Per document: ``doc_id``, the base counts, ``base_failed``, ``kept``, and the figures
    behind the verdict, ``ratio`` and ``chunks_outside`` (null where the base rules failed)."""
    bands = bands or Bands()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident.release()
        compressor = Compressor(bands)
        for batch in slices(batches, "text"):
            texts = Texts(batch.column("text"))
            found = measure(texts)
            failed = (found.n_words < LEAST_WORDS) | (
                100 * found.n_repeat_words > MOST_REPEATED_PERCENT * found.n_words
            )
            kept = np.zeros(len(texts), dtype=bool)
            ratio, outside = [None] * len(texts), [None] * len(texts)
            view = memoryview(np.ascontiguousarray(texts.data))
            for row in np.flatnonzero(~failed).tolist():
                low, high = int(texts.bounds[row]), int(texts.bounds[row + 1])
                kept[row], ratio[row], outside[row] = compressor.verdict(view[low:high])
            columns = {"doc_id": batch.column("doc_id")}
            columns |= {name: pa.array(getattr(found, name).astype(np.int64)) for name in names}
            columns |= {"base_failed": pa.array(failed), "kept": pa.array(kept)}
            columns |= {"ratio": pa.array(ratio, pa.float64()), "chunks_outside": pa.array(outside, pa.float64())}
            yield pa.RecordBatch.from_pydict(columns)

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = ", ".join(f"{name} long" for name in names)
    return slim.mapInArrow(
        judge, f"doc_id long, {counts}, base_failed boolean, kept boolean, ratio double, chunks_outside double"
    )
