"""The gate between staging and warehouse."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Row, SparkSession

from starloom.jobs import publish
from starloom.operators import quality
from starloom.schemas import SOURCES

logger = logging.getLogger(__name__)


def staged_frames(
    spark: SparkSession, root: str, run_id: str | None = None
) -> dict[str, DataFrame]:
    """The staging tables of one run, the current one unless another is named."""
    layer = publish.staging(spark, root)
    run_id = run_id or layer.current_run()
    return {s.table: layer.read(s.table, s.schema, run_id) for s in SOURCES}


def validate(spark: SparkSession, root: str, run_id: str | None = None) -> list[Row]:
    """Check the staged tables; the first failure raises ``QualityError``.

    Repeated keys are stored in a folder beside the run.
    """
    layer = publish.staging(spark, root)
    run_id = run_id or layer.current_run()
    duplicates = f"{layer.folder}/duplicates/{layer.new_run()}"
    rows = quality.enforce(staged_frames(spark, root, run_id), SOURCES, duplicates)
    logger.info("%d checks passed", len(rows))
    return rows
