"""The staging layer to the warehouse layer."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from starloom.jobs import publish
from starloom.jobs.validate import staged_frames
from starloom.plans import star
from starloom.schemas import FACT_ORDERS, ORDER_ITEMS

logger = logging.getLogger(__name__)


def transform(spark: SparkSession, root: str, staged_run: str | None = None) -> dict[str, int]:
    """Rebuild all four warehouse tables and publish them together; rows per table."""
    staged = staged_frames(spark, root, staged_run)
    layer = publish.warehouse(spark, root)
    with layer.new_load() as run_id:
        counts = star.write_star(spark, staged, layer.run_folder(run_id))
        left_out = staged[ORDER_ITEMS.table].count() - counts[FACT_ORDERS.table]
        layer.publish(run_id, counts)
    if left_out:
        logger.warning("%d items left out: order, product, customer or date unknown", left_out)
    return counts
