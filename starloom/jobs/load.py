"""The whole load, or one of its stages, from the command line."""

from __future__ import annotations

import argparse
import logging
import sys
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Row, SparkSession

from starloom import files, session, workspace
from starloom.jobs import history, publish
from starloom.jobs.history import Stage
from starloom.jobs.ingest import ingest
from starloom.jobs.transform import transform
from starloom.jobs.validate import validate
from starloom.operators import quality

logger = logging.getLogger(__name__)

STAGES = ("ingest", "validate", "transform")

# Characters of a failure that are kept with the load.
_ERROR_LENGTH = 2_000


@contextmanager
def recorded(stage: str, done: list[Stage]) -> Iterator[Stage]:
    """Log a stage's start and end or failure; what it did goes to ``done`` either way."""
    logger.info("%s starts", stage)
    started = time.monotonic()
    current = Stage(stage)
    done.append(current)
    try:
        yield current
    except Exception as error:
        current.seconds = time.monotonic() - started
        current.error = f"{type(error).__name__}: {error}"[:_ERROR_LENGTH]
        logger.exception("%s failed after %.2f s", stage, current.seconds)
        raise
    current.outcome, current.seconds = history.DONE, time.monotonic() - started
    logger.info("%s took %.2f s", stage, current.seconds)


def _checked_rows(checks: list[Row]) -> dict[str, int]:
    return {r.table_name.split(".")[-1]: r.measured for r in checks if r.check_name == quality.ROW_COUNT}


def load(
    spark: SparkSession,
    root: str,
    raw: str | None = None,
    stages: tuple[str, ...] = STAGES,
    patterns: dict[str, str] | None = None,
    ingested: Callable[[], None] | None = None,
) -> list[Stage]:
    """Run the stages in order; a failing one ends the load. What they did is kept.

    Validate and transform work on the same staged run, whatever is staged meanwhile.
    ``ingested`` is called once the raw files are no longer needed.
    """
    done: list[Stage] = []
    try:
        with session.passing_shuffles(spark):
            if "ingest" in stages:
                with recorded("ingest", done) as stage:
                    stage.row_counts = ingest(spark, raw, root, patterns)
                if ingested:
                    ingested()
            if "validate" in stages or "transform" in stages:
                layer = publish.staging(spark, root)
                run_id = layer.current_run()
                staged_bytes = files.total_length(spark, layer.run_folder(run_id)) if run_id else 0
                with session.sized_shuffles(spark, staged_bytes):
                    if "validate" in stages:
                        with recorded("validate", done) as stage:
                            stage.row_counts = _checked_rows(validate(spark, root, run_id))
                    if "transform" in stages:
                        with recorded("transform", done) as stage:
                            stage.row_counts = transform(spark, root, run_id)
        if "drop-replaced" in stages:
            with recorded("drop-replaced", done):
                publish.drop_replaced(spark, root)
    finally:
        history.record(spark, root, done)
    return done


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom", description=__doc__)
    parser.add_argument("stage", choices=("all", *STAGES, "drop-replaced"))
    parser.add_argument("--root", required=True, help="folder of the staging and warehouse layers")
    parser.add_argument("--raw", default="data/raw", help="folder of the CSV files")
    parser.add_argument("--master", help="Spark master, when not given by spark-submit")
    parser.add_argument(
        "--file",
        action="append",
        default=[],
        metavar="TABLE=PATTERN",
        help="file pattern of a feed, e.g. stg_orders='orders/*.csv'",
    )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Exit status: 0 when all stages are done, 1 when one failed."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    args = _arguments(argv)
    patterns = dict(pair.split("=", 1) for pair in args.file)
    stages = STAGES if args.stage == "all" else (args.stage,)
    spark = session.configure(session.build_session(master=args.master))
    try:
        done = load(spark, args.root, args.raw, stages, patterns)
    except Exception:
        return 1
    finally:
        workspace.clear(spark)
        spark.stop()
    logger.info("done in %.2f s", sum(s.seconds for s in done))
    return 0


if __name__ == "__main__":
    sys.exit(main())
