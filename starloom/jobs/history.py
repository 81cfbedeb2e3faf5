"""What each load did: its stages with their times, outcomes and row counts, as a table.

``<root>/loads`` holds one small file per load, done or failed, numbered from 1.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions import temporal
from starloom.jobs.numbered import NumberedFiles

DONE, FAILED = "done", "failed"

_LOADS = """load long, recorded_at timestamp_ntz, stages array<struct<
  stage: string, outcome: string, seconds: double, error: string, row_counts: map<string, bigint>>>"""


@dataclass
class Stage:
    """One stage of a load. Row counts are those of the tables it wrote or checked."""

    stage: str
    outcome: str = FAILED
    seconds: float = 0.0
    error: str | None = None
    row_counts: Mapping[str, int] = field(default_factory=dict)


def _files(spark: SparkSession, root: str) -> NumberedFiles:
    return NumberedFiles(spark, f"{root.rstrip('/')}/loads")


def record(spark: SparkSession, root: str, stages: Sequence[Stage]) -> int:
    """Keep what a load's stages did; the load's number."""

    def text(number: int) -> str:
        known = {"load": number, "recorded_at": str(temporal.now()), "stages": [asdict(s) for s in stages]}
        return json.dumps(known)

    return _files(spark, root).append(text)


def loads(spark: SparkSession, root: str) -> DataFrame:
    """A row per stage of every load."""
    kept = spark.read.schema(_LOADS).json(_files(spark, root).folder)
    return kept.select("load", "recorded_at", F.posexplode("stages").alias("position", "_stage")).select(
        "load", "recorded_at", "position", "_stage.*"
    )


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """A row per load, stage and table."""
    return loads(spark, root).select("load", "stage", F.explode("row_counts").alias("table_name", "row_count"))
