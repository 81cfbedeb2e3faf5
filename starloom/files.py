"""Listing, deleting and small text files through the Hadoop file system, without Spark jobs."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class File(NamedTuple):
    path: str
    length: int


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def list_files(spark: SparkSession, path: str) -> list[File]:
    """The files of a file, folder or glob, by name; hidden ones are left out."""
    system, place = _system(spark, path)
    named = [system.getFileStatus(place)] if system.exists(place) else system.globStatus(place) or []
    found = []
    for status in named:
        inner = system.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [
            File(_text(s.getPath()), s.getLen())
            for s in inner
            if not s.isDirectory() and not _hidden(s.getPath().getName())
        ]
    return sorted(found)


def _text(path) -> str:
    return path.toString()


def total_length(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    system, place = _system(spark, path)
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


def list_folders(spark: SparkSession, path: str) -> list[str]:
    system, place = _system(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().toString() for s in system.listStatus(place) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _system(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    system, place = _system(spark, path)
    try:
        stream = system.open(place)
    except Py4JJavaError as error:
        if "FileNotFound" not in error.java_exception.getClass().getName():
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; False if it does, whoever made it and when.

    Of several callers at a time one succeeds. Distributed file systems grant that for a
    creation without overwriting. The local one only checks and then creates, so there the
    text goes to a hidden file, which is then linked under the name: that is one step, too.
    """
    system, place = _system(spark, path)
    system.mkdirs(place.getParent())
    local = system.getUri().getScheme() == "file"
    target = _at(spark, place.getParent(), f".{uuid.uuid4().hex}") if local else place
    try:
        stream = system.create(target, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if local:
            paths = spark._jvm.java.nio.file
            names = [system.makeQualified(p).toUri().getPath() for p in (place, target)]
            paths.Files.createLink(*[paths.Paths.get(name, _no_more(spark)) for name in names])
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        if local:
            system.delete(target, False)
    return True


def _at(spark: SparkSession, folder, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder, name)


def _no_more(spark: SparkSession):
    """An empty list for Java methods that take any number of texts."""
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
