"""Session settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, ExitStack, contextmanager
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Item = TypeVar("Item")
Result = TypeVar("Result")

# Strict casts and zone-free time carry the semantics; the rest lets Spark re-plan
# joins from measured sizes and split partitions that one hot key has filled.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Where all partitions of a side are measured small, they are hashed and neither side sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}
# What the plans of a load need in a session that others have made.
_STRICT = (
    "spark.sql.ansi.enabled",
    "spark.sql.session.timeZone",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold",
)

# Staged Parquet bytes per shuffle partition; they take several times that as rows.
# Adaptive execution merges partitions that come out small.
_PARTITION_BYTES = 32 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session for a job. Deployment settings stay with the submit command."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Plans here have hundreds of expressions; noting a line of Python for each takes long.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A session setting for the jobs run meanwhile; the caller's comes back."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def passing_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """For jobs run meanwhile: the shuffle files of each query go as soon as it ends, where
    later queries read what it has written. Otherwise they stay until the driver collects garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def strict(spark: SparkSession) -> Iterator[None]:
    """Casts that fail on bad text, zone-free time and hash joins of small partitions for the
    plans made meanwhile."""
    with ExitStack() as settings:
        for name in _STRICT:
            settings.enter_context(setting(spark, name, SETTINGS[name]))
        yield


def partitions_for(staged_bytes: int) -> int:
    """Shuffle partitions for Parquet files of this size, 1 at least."""
    return max(1, -(-staged_bytes // _PARTITION_BYTES))


@contextmanager
def sized_shuffles(spark: SparkSession, staged_bytes: int) -> Iterator[int]:
    """Enough shuffle partitions for the staged data."""
    name = "spark.sql.shuffle.partitions"
    count = max(int(spark.conf.get(name)), partitions_for(staged_bytes))
    with setting(spark, name, count):
        yield count


def side_by_side(
    spark: SparkSession, work: Callable[[Item], Result], items: Iterable[Item]
) -> list[Result]:
    """Run a few jobs that do not depend on each other, so that they share the cluster.

    Results come in the order of the items; so does the error, if several fail.
    """
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))
