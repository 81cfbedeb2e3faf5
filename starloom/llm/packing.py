"""Packing documents into training sequences by cutting-stock patterns.

Documents longer than a sequence are cut; all other pieces stay whole. Piece lengths are
rounded up to a multiple of ``UNIT`` tokens and counted, one linear program over the
histogram finds patterns that waste little, and the pieces of each length class, ranked
in a fixed pseudo-random order, are dealt to the patterns' copies. The driver sees the
histogram and the patterns, whose number is bounded by the number of length classes; the
ranks, places and offsets are computed by Spark.

Sequences are padded to ``capacity``. Defined results: a null or empty text is a document
of its end token alone; a null ``doc_id`` is kept; rows that repeat an id are packed each;
an empty table gives no piece; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom import workspace
from starloom.llm import cutting_stock
from starloom.llm.texts import slices, small_batches
from starloom.llm.tokenizing import CACHED_PIECES, SLICE_BYTES, TokenizerFile, encoder, with_end

CAPACITY = 4096
END_ID = 2
UNIT = 8
_SLICES = 256

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, _place int"


def token_pieces(
    documents: DataFrame,
    tokenizer: TokenizerFile,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    cached: int = CACHED_PIECES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Tokenize and cut: one row per piece, its ids only if asked for.

    A worker encodes ``slice_bytes`` of text at a time, or one document, and keeps the ids of
    twice ``cached`` pieces of text at most.
    """
    # The vocabulary file: fixed in size whatever the data.
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer.definition)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value, cached).encode
        for batch in slices(batches, "text", slice_bytes):
            ids, bounds = with_end(*encode(batch.column("text")), end_id)
            tokens = np.diff(bounds)
            count = -(-tokens // capacity)
            rows = np.repeat(np.arange(len(tokens)), count)
            start = (np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)) * capacity
            length = np.minimum(capacity, tokens[rows] - start)
            first = bounds[rows] + start
            view = memoryview(ids)
            crc = [zlib.crc32(view[a : a + n]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(rows)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(tokens[rows]),
            }
            if with_ids:  # the pieces of a slice follow one another without a gap
                ends = np.concatenate((first, [len(ids)])).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(cut, _PIECES + (", ids array<int>" if with_ids else ""))


def _class(length: Column) -> Column:
    return F.ceil(length / UNIT).cast("int")


def _ranked(pieces: DataFrame) -> DataFrame:
    """Rank pieces within their length class, 0 first, in an order fixed by their values.

    The order is cut into slices first, so a class that holds most pieces is ranked by many
    tasks; only the slices' counts are summed per class.
    """
    key = F.xxhash64("doc_id", "start", "ids_crc32", "length")
    keyed = pieces.select("*", _class(F.col("length")).alias("_class"), key.alias("_key")).withColumn(
        "_slice", F.shiftrightunsigned("_key", 56)
    )
    counts = keyed.groupBy("_class", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_class").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_class", "_slice", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_class", "_slice").orderBy("_key", "doc_id", "start")) - 1
    return (
        keyed.withColumn("_inside", place)
        .join(offsets, ["_class", "_slice"])
        .withColumn("_rank", F.col("_before") + F.col("_inside"))
        .drop("_key", "_slice", "_inside", "_before")
    )


class _Deal:
    """For each class, the ranks at which each pattern's share begins."""

    def __init__(self, uses: list[cutting_stock.Use]):
        taken: dict[int, int] = {}
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for use in uses:
            place = 0
            for size, count in sorted(use.pattern, reverse=True):
                begin = taken.get(size, 0)
                rows.setdefault(size, []).append((begin, count, sequence, place))
                taken[size] = begin + count * use.copies
                place += count
            sequence += use.copies
        self.tables = {size: np.array(found, dtype=np.int64).T for size, found in rows.items()}

    def place(self, size: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence of each rank of a class and its place in that sequence."""
        begins, counts, firsts, places = self.tables[size]
        k = np.searchsorted(begins, ranks, side="right") - 1
        copy, slot = np.divmod(ranks - begins[k], counts[k])
        return firsts[k] + copy, places[k] + slot


def plan(pieces: DataFrame, capacity: int = CAPACITY) -> list[cutting_stock.Use]:
    """Patterns for the pieces; the histogram has at most ``capacity / UNIT`` rows."""
    histogram = pieces.groupBy(_class(F.col("length")).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    return cutting_stock.solve({row["size"]: row["n"] for row in histogram.collect()}, capacity // UNIT)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces read from a written table."""
    # Bounded by the number of length classes, like the patterns themselves.
    deal = pieces.sparkSession.sparkContext.broadcast(_Deal(plan(pieces, capacity)))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence = np.zeros(len(frame), dtype=np.int64)
            spot = np.zeros(len(frame), dtype=np.int64)
            classes, ranks = frame["_class"].to_numpy(), frame["_rank"].to_numpy()
            for size in np.unique(classes):
                own = classes == size
                sequence[own], spot[own] = deal.value.place(int(size), ranks[own])
            frame["sequence_id"], frame["_place"] = sequence, spot.astype(np.int32)
            yield frame.drop(columns=["_class", "_rank"])

    placed = _ranked(pieces).mapInPandas(place, _PLACED)
    # A sequence holds at most `capacity` pieces.
    before = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("_place")


def packed(
    documents: DataFrame, tokenizer: TokenizerFile, cached: int = CACHED_PIECES, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``."""
    spark = documents.sparkSession
    folder = workspace.scratch(spark, "pack-pieces")
    # Texts are tokenized once; the plan and the ranks both read the written pieces.
    with small_batches(spark):
        token_pieces(documents, tokenizer, cached=cached, slice_bytes=slice_bytes).write.parquet(folder)
    return pack(spark.read.parquet(folder))


def sequences(pieces: DataFrame, places: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` padded to ``capacity``, and ``used``.

    ``pieces`` come from :func:`token_pieces` with ids, ``places`` from :func:`pack`.
    """
    keys = ["doc_id", "start", "length", "ids_crc32"]
    numbered = Window.partitionBy(*keys).orderBy(F.lit(0))
    left = pieces.withColumn("_copy", F.row_number().over(numbered))
    right = places.select(*keys, "sequence_id", "offset").withColumn(
        "_copy", F.row_number().over(Window.partitionBy(*keys).orderBy("sequence_id", "offset"))
    )
    same = F.lit(True)
    for key in [*keys, "_copy"]:
        same = same & left[key].eqNullSafe(right[key])
    joined = left.join(right, same).select("sequence_id", "offset", "ids")
    grouped = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
    ids = F.flatten(F.transform("_p", lambda p: p["ids"]))
    return grouped.select("sequence_id", ids.alias("ids"), F.size(ids).alias("used")).withColumn(
        "ids", F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(capacity) - F.col("used")))
    )
