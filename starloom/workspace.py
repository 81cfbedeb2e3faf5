"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

from starloom import files


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or else a folder in the warehouse, on any master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate").rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/starloom/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name; nothing else ever writes there.

    What is written there lasts until :func:`clear` or the end of the program.
    """
    if spark.sparkContext.applicationId not in _sessions:
        _sessions[spark.sparkContext.applicationId] = spark
        atexit.register(_clear_at_exit, spark)
    return f"{_own(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate folder made by :func:`scratch`."""
    if "/starloom/" not in folder:
        raise ValueError(f"not an intermediate folder: {folder}")
    files.delete(spark, folder)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate folders of this application."""
    files.delete(spark, _own(spark))


_sessions: dict[str, SparkSession] = {}


def _clear_at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None:  # not stopped before
        clear(spark)
