"""Key ranges from a bounded sample, for range partitionings whose bounds are known.

``repartitionByRange`` runs its whole input once more to find its bounds and keeps them to
itself. Here the bounds come from a sample of the key columns alone, wherever those are at
hand, and every row's range is a column, so that other tables can be dealt by it too.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

RANGE = "_range"

# Sampled keys per range: the largest of many ranges then holds about twice its share at most.
SAMPLED_PER_RANGE = 64
_SEED = 7
_TREE_DEPTH = 8


class Ranges(NamedTuple):
    """Ascending first keys of all ranges but the first, by the named columns."""

    schema: T.StructType
    bounds: list[tuple]

    @property
    def count(self) -> int:
        return len(self.bounds) + 1

    def narrowed(self) -> Ranges:
        """The same bounds by as few leading columns as still tell them apart.

        Rows that agree in those share a range; a value that fills ranges of its own is
        several bounds, so the columns behind it stay.
        """
        for width in range(1, len(self.schema)):
            cut = [bound[:width] for bound in self.bounds]
            if len(set(cut)) == len(cut):
                return Ranges(T.StructType(self.schema.fields[:width]), cut)
        return self

    def runs(self, most: int) -> list[Run]:
        """The ranges in at most so many runs of about equally many, one after the other.

        Runs part between values of the first column, so rows that agree in it share a run.
        """
        edges: list[object] = []
        for n in range(1, most if self.bounds else 1):
            value = self.bounds[n * len(self.bounds) // most][0]
            if value is not None and (not edges or value != edges[-1]):
                edges.append(value)
        place = [_in_spark_order(bound[:1]) for bound in self.bounds]
        runs = []
        for low, high in zip([None, *edges], [*edges, None]):
            inside = [
                bound
                for bound, at in zip(self.bounds, place)
                # A bound that is the run's own begin would leave the range before it empty.
                if (low is None or (at >= _in_spark_order((low,)) and bound != (low,)))
                and (high is None or at < _in_spark_order((high,)))
            ]
            runs.append(Run(low, high, Ranges(self.schema, inside)))
        return runs

    def id_of(self, key: Sequence[str]) -> Column:
        """The range a key, given in SQL, lies in: how many bounds are not above it. NULL
        sorts first, as it does for Spark.

        A binary search, as a tree of comparisons that is compiled with the plan; where the
        tree would get too large, its leaves search what is left in a literal array. One SQL
        text, since a column for each of its parts would take a call to the JVM each.
        """
        parts = [f"CAST({part} AS {f.dataType.simpleString()})" for part, f in zip(key, self.schema, strict=True)]

        def search(low: int, high: int, depth: int) -> str:
            if low == high:
                return str(low)
            if depth == _TREE_DEPTH:
                return f"{low} + {_searched(parts, self.bounds[low:high], self.schema)}"
            middle = (low + high) // 2
            below = _less(parts, [_literal(v, f.dataType) for v, f in zip(self.bounds[middle], self.schema, strict=True)])
            return f"CASE WHEN {below} THEN {search(low, middle, depth + 1)} ELSE {search(middle + 1, high, depth + 1)} END"

        return F.expr(search(0, len(self.bounds), 0))


class Run(NamedTuple):
    """Neighbouring ranges, for rows whose first key column is ``low`` or above and below
    ``high``. None is no limit; the run without a lower one has the NULLs."""

    low: object
    high: object
    ranges: Ranges

    def of(self, df: DataFrame, column: str) -> DataFrame:
        """The rows of ``df`` that belong to the run, by its first key column."""
        kind = self.ranges.schema[0].dataType
        key = f"CAST({_quoted(column)} AS {kind.simpleString()})"
        if self.low is not None:
            df = df.where(f"{key} >= {_literal(self.low, kind)}")
        if self.high is not None:
            below = f"{key} < {_literal(self.high, kind)}"
            df = df.where(f"{below} OR {key} IS NULL" if self.low is None else below)
        return df


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    """A SQL text literal of any characters."""
    return f"CAST(X'{value.encode().hex()}' AS STRING)"


def _plain(value: object) -> object:
    if isinstance(value, (bytes, bytearray)):
        return base64.b64encode(bytes(value)).decode()
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def _literal(value: object, kind: T.DataType) -> str | None:
    """A value in SQL; None for NULL."""
    if value is None:
        return None
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    return f"CAST({_text(str(_plain(value)))} AS {kind.simpleString()})"


def _less(parts: list[str], bound: list[str | None]) -> str:
    """Whether a key lies before a bound; never NULL."""
    (part, *parts), (value, *values) = parts, bound
    if value is None:
        return f"({part} IS NULL AND {_less(parts, values)})" if parts else "false"
    lower = f"coalesce({part} < {value}, true)"
    return f"({lower} OR ({part} <=> {value} AND {_less(parts, values)}))" if parts else lower


def _searched(parts: list[str], rows: list[tuple], schema: T.StructType) -> str:
    """How many of some sorted rows are not above a key, in steps of falling powers of two."""
    named = [dict(zip(schema.names, map(_plain, row), strict=True)) for row in rows]
    kind = T.ArrayType(schema).simpleString()
    bounds = f"from_json({_text(json.dumps(named))}, '{kind}')"
    steps = ", ".join(str(1 << k) for k in reversed(range(len(rows).bit_length())))
    # The key is put together once and not at every step.
    sought = ", ".join(f"'{name}', {part}" for name, part in zip(schema.names, parts, strict=True))
    further = f"CASE WHEN at + step <= {len(rows)} AND get({bounds}, at + step - 1) <= sought THEN at + step ELSE at END"
    found = f"transform(array(named_struct({sought})), sought -> aggregate(array({steps}), 0, (at, step) -> {further}))"
    return f"coalesce(get({found}, 0), 0)"


def _in_spark_order(key: tuple) -> tuple:
    """NULL first, text by its UTF-8 bytes."""
    return tuple((False, 0) if part is None else (True, part.encode() if isinstance(part, str) else part) for part in key)


class Sample(NamedTuple):
    """Keys drawn at random, in order, and how many rows they were drawn from."""

    schema: T.StructType
    keys: list[tuple]
    rows: int

    def ranges(self, count: int, per_range: int = SAMPLED_PER_RANGE) -> Ranges:
        """At most ``count`` ranges with so many of the drawn keys each."""
        bounds: list[tuple] = []
        for key in self.keys[per_range::per_range]:
            if not bounds or key != bounds[-1]:
                bounds.append(key)
        return Ranges(self.schema, bounds[: count - 1])


def drawn(keys: DataFrame, columns: Sequence[str], size: int) -> Sample:
    """``size`` rows at random, all the driver ever holds; the same job counts all rows."""
    narrow = keys.select(*columns)
    schema = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(narrow.schema)])
    seen = Observation()
    counted = narrow.observe(seen, F.count(F.lit(1)).alias("rows"))
    found = counted.orderBy(F.rand(_SEED)).limit(size).collect()
    return Sample(schema, sorted((tuple(row) for row in found), key=_in_spark_order), seen.get["rows"])


def sampled(
    keys: DataFrame, columns: Sequence[str], count: int, per_range: int = SAMPLED_PER_RANGE
) -> Ranges:
    """At most ``count`` ranges of about equally many rows.

    The sample is ``count * per_range`` rows at random. Fewer rows than that make fewer
    ranges. A repeated key fills one range, however often it comes; where that matters, add
    a column that tells its rows apart.
    """
    return drawn(keys, columns, count * per_range).ranges(count, per_range)


def _with_range(df: DataFrame, ranges: Ranges, key: Sequence[str]) -> DataFrame:
    """``df`` with its range as a column, for all rows of a large table.

    A binary search in steps of falling powers of two, each a projection that looks up one
    bound. The tree of :meth:`Ranges.id_of` compares with every bound by code of its own,
    which for many bounds or columns is more than the JVM compiles.
    """
    if not ranges.bounds:
        return df.withColumn(RANGE, F.lit(0))
    types = [f.dataType.simpleString() for f in ranges.schema]
    rows = [[_literal(v, f.dataType) for v, f in zip(row, ranges.schema, strict=True)] for row in ranges.bounds]
    parts = [f"CAST({part} AS {kind})" for part, kind in zip(key, types, strict=True)]
    if len(types) == 1 and all(value is not None for (value,) in rows):
        # NULL is above no bound.
        values, sought = [value for (value,) in rows], parts[0]
    else:
        # Structs compare part by part, NULL first.
        values, sought = [_struct(ranges.schema, row, types) for row in rows], _struct(ranges.schema, parts, types)
    bounds = f"array({', '.join(values)})"
    found = df.select("*", F.expr(sought).alias("_sought"), F.lit(0).alias(RANGE))
    for step in (1 << k for k in reversed(range(len(values).bit_length()))):
        further = F.expr(f"IF(get({bounds}, {RANGE} + {step - 1}) <= _sought, {RANGE} + {step}, {RANGE})")
        found = found.withColumn(RANGE, further)
    return found.drop("_sought")


def _struct(schema: T.StructType, parts: Sequence[str | None], types: Sequence[str]) -> str:
    fields = (f"'{n}', {part or f'CAST(NULL AS {kind})'}" for n, part, kind in zip(schema.names, parts, types, strict=True))
    return f"named_struct({', '.join(fields)})"


def deal(df: DataFrame, ranges: Ranges, key: Sequence[str]) -> DataFrame:
    """``df`` with its range as a column, each range a partition of that number.

    Narrowed ranges take as many columns of ``key`` as they have.
    """
    quoted = [_quoted(c) for c in key]
    return _with_range(df, ranges, quoted[: len(ranges.schema)]).repartitionById(ranges.count, RANGE)
