"""All-or-nothing layers: each load writes a folder of its own, then is named current.

``<root>/<layer>/run=<id>/<table>`` holds the data and ``<root>/<layer>/manifests`` one small
file per published load, numbered from 1. A load publishes by creating the file of the next
number, which only one of several at a time can; the others take the numbers after it. A load
that fails is never named and its folder is removed, so readers keep the last one; no folder
in use is ever overwritten. Replaced runs stay readable until they are dropped, and those a
reader holds a lease on, or a load is writing, are not dropped.
"""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom import files
from starloom.functions import temporal
from starloom.jobs.numbered import NumberedFiles, NumberTaken

_RUNS = "run_id string, sequence long, published_at timestamp_ntz, row_counts map<string, bigint>"

# A lease ends by itself after so long, should its holder be lost.
LEASE_HOURS = 24.0
# The same for the mark on a run that is being dropped.
DROP_HOURS = 1.0


def _until(hours: float) -> str:
    return json.dumps({"until": time.time() + 3600 * hours})


class PublishConflict(RuntimeError):
    """Another load was published first, where that matters."""


class Manifest(NamedTuple):
    """What is known of a published load."""

    sequence: int
    run_id: str
    published_at: str
    row_counts: dict[str, int]


class Layer:
    """One layer (staging or warehouse) under a root folder all executors reach."""

    def __init__(self, spark: SparkSession, root: str, name: str) -> None:
        self.spark = spark
        self.folder = f"{root.rstrip('/')}/{name}"
        self.name = name
        self._manifests = NumberedFiles(spark, f"{self.folder}/manifests")

    def new_run(self) -> str:
        return f"{temporal.now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def run_folder(self, run_id: str) -> str:
        return f"{self.folder}/run={run_id}"

    @contextmanager
    def new_load(self) -> Iterator[str]:
        """A fresh run, under a lease; what a failing load has written is removed."""
        run_id = self.new_run()
        lease = self._take_lease(run_id, LEASE_HOURS)
        try:
            yield run_id
        except BaseException:
            files.delete(self.spark, self.run_folder(run_id))
            raise
        finally:
            files.delete(self.spark, lease)

    @contextmanager
    def reading(self, run_id: str | None = None, hours: float = LEASE_HOURS) -> Iterator[str]:
        """A run that is not dropped meanwhile, the current one unless another is named.

        The lease ends with the block, or after so many hours if the reader is lost. A reader
        first writes its lease and then looks whether the run is being dropped, who drops
        runs first marks one and then looks for leases; so one of them always sees the other.
        """
        while True:
            held = run_id or self.current_run()
            if held is None:
                raise LookupError(f"nothing published in layer {self.name}")
            lease = self._take_lease(held, hours)
            try:
                if files.exists(self.spark, self.run_folder(held)) and not self._holds(self._mark(held)):
                    yield held
                    return
            finally:
                files.delete(self.spark, lease)
            if run_id:
                raise LookupError(f"run {run_id} of layer {self.name} has been dropped")
            time.sleep(random.uniform(0, 0.05))

    def _take_lease(self, run_id: str, hours: float) -> str:
        path = f"{self.folder}/leases/{run_id}/{uuid.uuid4().hex}.json"
        files.create_new(self.spark, path, _until(hours))
        return path

    def _holds(self, path: str) -> bool:
        """Whether a lease or mark is there and has not ended; one without its text holds."""
        text = files.read_text(self.spark, path)
        return text is not None and (not text or json.loads(text)["until"] > time.time())

    def _is_leased(self, run_id: str) -> bool:
        leases = files.list_files(self.spark, f"{self.folder}/leases/{run_id}")
        return any(self._holds(lease.path) for lease in leases)

    def _mark(self, run_id: str) -> str:
        return f"{self.folder}/dropping/{run_id}.json"

    def publish(self, run_id: str, row_counts: Mapping[str, int], after: int | None = None) -> int:
        """Name the run current; its number.

        The number follows the last one's, so no driver's clock decides what is current. Of
        loads at the same time all are published, one after the other. With ``after``, only
        if the load of that number (0: none) is still the last one: a load built on what was
        current then cannot replace one it has not seen.
        """
        def manifest(number: int) -> str:
            return json.dumps(Manifest(number, run_id, str(temporal.now()), dict(row_counts))._asdict())

        try:
            return self._manifests.append(manifest, after)
        except NumberTaken as taken:
            raise PublishConflict(f"layer {self.name}: {taken}") from taken

    def published(self) -> DataFrame:
        """All published loads, replaced ones included."""
        return self.spark.read.schema(_RUNS).json(self._manifests.folder)

    def latest(self) -> Manifest | None:
        """The load published last, or None before the first."""
        text = self._manifests.last_text()
        return Manifest(**json.loads(text)) if text else None

    def current_run(self) -> str | None:
        """The run published last, or None before the first."""
        latest = self.latest()
        return latest.run_id if latest else None

    def drop_replaced(self) -> list[str]:
        """Remove every run but the current one and those under a lease, with the lists of
        duplicates; their ids. A reader without a lease would lose its run."""
        current = self.current_run()
        dropped = []
        for folder in files.list_folders(self.spark, self.folder):
            run_id = folder.rsplit("/", 1)[-1].removeprefix("run=")
            if not folder.endswith(f"/run={run_id}") or run_id == current:
                continue
            mark = self._mark(run_id)
            if not self._holds(mark):
                files.delete(self.spark, mark)
            if not files.create_new(self.spark, mark, _until(DROP_HOURS)):
                continue  # another job is dropping it
            # In this order: a load is published before it gives up its lease.
            if not self._is_leased(run_id) and run_id != self.current_run():
                files.delete(self.spark, folder)
                files.delete(self.spark, f"{self.folder}/leases/{run_id}")
                dropped.append(run_id)
            files.delete(self.spark, mark)
        files.delete(self.spark, f"{self.folder}/duplicates")
        return dropped

    def tables(self, run_id: str) -> list[str]:
        """The tables a published run holds."""
        runs = self.published().where(F.col("run_id") == run_id)
        return sorted(runs.first().row_counts)

    def read(self, table: str, schema: T.StructType, run_id: str | None = None) -> DataFrame:
        run_id = run_id or self.current_run()
        if run_id is None:
            raise LookupError(f"nothing published in layer {self.name}")
        return self.spark.read.schema(schema).parquet(f"{self.run_folder(run_id)}/{table}")


def staging(spark: SparkSession, root: str) -> Layer:
    return Layer(spark, root, "staging")


def warehouse(spark: SparkSession, root: str) -> Layer:
    return Layer(spark, root, "warehouse")


def drop_replaced(spark: SparkSession, root: str) -> list[str]:
    return staging(spark, root).drop_replaced() + warehouse(spark, root).drop_replaced()


def register(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Make the published tables known to SQL as ``staging.*`` and ``warehouse.*``.

    ``prefix`` goes before the database names, where those are taken. The tables are views
    of the runs current now; call it again after a load.
    """
    names = []
    for layer in (staging(spark, root), warehouse(spark, root)):
        latest = layer.latest()
        if latest is None:
            continue
        place = f"{layer.folder}/database".replace("'", "\\'")
        database = f"{prefix}{layer.name}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}'")
        for table in sorted(latest.row_counts):
            name = f"{database}.{table}"
            files = f"{layer.run_folder(latest.run_id)}/{table}".replace("`", "``")
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{files}`")
            names.append(name)
    return names
