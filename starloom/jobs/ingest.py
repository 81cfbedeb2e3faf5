"""CSV files to the staging layer."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from starloom import session
from starloom.jobs import publish
from starloom.schemas import SOURCES, Source
from starloom.sources import csv_files

logger = logging.getLogger(__name__)


def write_staged(
    spark: SparkSession, frames: Mapping[str, DataFrame], folder: str
) -> dict[str, int]:
    """Write each frame as one table; its rows are counted by the write itself."""

    def write(table: str) -> int:
        seen = Observation()
        counted = frames[table].observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.parquet(f"{folder}/{table}")
        logger.info("staged %d rows into %s", seen.get["rows"], table)
        return seen.get["rows"]

    return dict(zip(frames, session.side_by_side(spark, write, frames)))


def ingest(
    spark: SparkSession, raw: str, root: str, patterns: Mapping[str, str] | None = None
) -> dict[str, int]:
    """Load the four feeds from the raw folder and publish them together; rows per table.

    ``patterns`` replaces a feed's default file pattern, by staging table name.
    """
    patterns = patterns or {}

    def read(source: Source) -> DataFrame:
        pattern = patterns.get(source.table, source.pattern)
        return csv_files.read_csv(spark, f"{raw.rstrip('/')}/{pattern}", source.columns)

    # Every header is checked before anything is written.
    found = session.side_by_side(spark, read, SOURCES)
    frames = {source.table: frame for source, frame in zip(SOURCES, found)}
    layer = publish.staging(spark, root)
    with layer.new_load() as run_id:
        counts = write_staged(spark, frames, layer.run_folder(run_id))
        layer.publish(run_id, counts)
    return counts
