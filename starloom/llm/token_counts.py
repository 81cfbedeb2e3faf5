"""Token counts of whole texts by compiled transducers, without encoding.

Defined results: a null or empty text has no tokens; a null ``doc_id`` is kept; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm import resident
from starloom.llm.texts import Texts, slices
from starloom.llm.tokenizing import TokenizerFile
from starloom.llm.transducers import TokenCounter

LIMIT = 512


def token_report(documents: DataFrame, tokenizer: TokenizerFile, limit: int = LIMIT) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``."""
    # The vocabulary file: fixed in size whatever the data.
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer.definition)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = resident.keep(("counter", shared.value), lambda: TokenCounter(shared.value))
        for batch in slices(batches, "text"):
            texts = Texts(batch.column("text"))
            tokens = counter.count(texts.column.to_pylist())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(texts.sizes.astype(np.int64)),
                    "n_tokens": pa.array(tokens),
                    "over_limit": pa.array(tokens > limit),
                }
            )

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
