"""Token ids in Simple-8b files, documents in ascending order of their id.

The documents are range-partitioned and sorted by id, so the partitions in their order
hold the ids in theirs. Each partition is written as rows of one block each: the documents
of the block with their token counts, the ids before the block in its partition, and the
Simple-8b payload. Spark's own writer commits the files, so a lost executor's part is
written again. Reading adds the sums of the partitions before, one number a partition.

Defined results: a null or empty text is its end id alone; null ids come first; rows that
repeat an id follow one another in a fixed order; an empty table writes no rows; extra
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from starloom.llm import simple8b
from starloom.llm.texts import slices, small_batches
from starloom.llm.tokenizing import SLICE_BYTES, TokenizerFile, encoder, with_end

END_ID = 0

_BLOCKS = "part int, start long, doc_ids array<long>, doc_tokens array<long>, ids binary"


def write(documents: DataFrame, tokenizer: TokenizerFile, folder: str, end_id: int = END_ID) -> None:
    """Encode every text, append ``end_id``, and write the ids to a new folder."""
    # The vocabulary file: fixed in size whatever the data.
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer.definition)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode
        part, start = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, bounds = with_end(*encode(batch.column("text")), end_id)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "start": pa.array([start], pa.int64()),
                    "doc_ids": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "doc_tokens": pa.array([np.diff(bounds)], pa.list_(pa.int64())),
                    "ids": pa.array([simple8b.encode(ids)], pa.binary()),
                }
            )
            start += len(ids)

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The text's hash parts rows that share an id and fixes their order.
    order = ["doc_id", F.xxhash64("text")]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    with small_batches(documents.sparkSession):
        dealt.mapInArrow(blocks, _BLOCKS).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` and its ``ids``' digest."""
    stored = spark.read.parquet(folder)
    sizes = stored.groupBy("part").agg(F.sum(F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row a partition: grows with their number, not with the ids.
    placed = stored.join(F.broadcast(starts), "part").select(
        (F.col("_before") + F.col("start")).alias("start"), "doc_ids", "doc_tokens", "ids"
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tokens = batch.column("doc_tokens")[k].values.to_numpy()
                ids = simple8b.decode(batch.column("ids")[k].as_py()).astype("<u4")
                ends = np.cumsum(tokens)
                view = memoryview(ids)
                crc = [zlib.crc32(view[e - n : e]) for e, n in zip(ends.tolist(), tokens.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_ids")[k].values,
                        "start": pa.array(ends - tokens + batch.column("start")[k].as_py()),
                        "n_tokens": pa.array(tokens),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    return placed.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id`` and its ids with the end id."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tokens = batch.column("doc_tokens")[k].values.to_numpy()
                ids = simple8b.decode(batch.column("ids")[k].as_py()).astype(np.int64)
                ends = np.concatenate(([0], np.cumsum(tokens))).astype(np.int32)
                made = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_ids")[k].values, "ids": made})

    return spark.read.parquet(folder).select("doc_ids", "doc_tokens", "ids").mapInArrow(documents, "doc_id long, ids array<long>")
