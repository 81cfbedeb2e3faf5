"""Small files numbered from 1 without a gap, written by several jobs at a time.

A file of the next number is created only if there is none yet, which one of several jobs
can; the others take the numbers after it.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from starloom import files

# How often a job tries for the next number, each time it was taken by another.
_ATTEMPTS = 100


class NumberTaken(RuntimeError):
    """Another job was first."""


class NumberedFiles:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def numbers(self) -> list[int]:
        names = [f.path.rsplit("/", 1)[-1] for f in files.list_files(self.spark, self.folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def append(self, text_of: Callable[[int], str], after: int | None = None) -> int:
        """Write the file of the next number; with ``after``, only if that is the last one."""
        for attempt in range(_ATTEMPTS):
            last = max(self.numbers(), default=0)
            if after is not None and last != after:
                raise NumberTaken(f"number {last} came after number {after}")
            if files.create_new(self.spark, self._path(last + 1), text_of(last + 1)):
                return last + 1
            time.sleep(random.uniform(0, 0.01 * (attempt + 1)))
        raise NumberTaken(f"no number to be had in {_ATTEMPTS} attempts")

    def last_text(self) -> str | None:
        """The text of the last file; a file system may show one before its text, which does
        not count yet."""
        for number in reversed(self.numbers()):
            text = files.read_text(self.spark, self._path(number))
            if text:
                return text
        return None
