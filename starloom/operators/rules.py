"""Rules on tables, all of them measured by one scan of each table and one shuffle.

Every row leaves a few marks: one that says which of the row rules it breaks, one a key that
must be unique, one a reference it makes and one a reference others make to it. A mark holds
the number of its rule and 128 bits of hash instead of the key (a whole number as it is), so
the marks of all tables and rules can be counted together. Marks of a kind combine before the shuffle: rows that
break the same rules, and rows with equal references, travel as one each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

ROWS = "rows"

# What a rule counts.
_ROW, _REPEATED, _REPEATED_OR_MISSING, _ORPHAN = range(4)


@dataclass(frozen=True, eq=False)
class Rules:
    """The rules of one table, by name and in the order of the report.

    ``row`` holds conditions that are true where a row breaks the rule (:data:`ROWS`, under
    any name, counts all rows), ``unique`` the columns of which no two rows may agree (NULLs
    agree), ``primary`` a column that must also not be NULL, ``references`` a column and the
    table and column that must hold its values; NULL refers to nothing.
    """

    table: str
    row: Mapping[str, Column] = field(default_factory=dict)
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    primary: Mapping[str, str] = field(default_factory=dict)
    references: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [*self.row, *self.unique, *self.primary, *self.references]


def literal_array(values: Sequence[int] | Sequence[str]) -> Column:
    """A literal array in one piece; a column for each value takes a call to the JVM each."""
    return F.expr(f"array({', '.join(repr(v) if isinstance(v, int) else _text(v) for v in values)})")


def _text(value: str) -> str:
    return f"CAST(X'{value.encode().hex()}' AS STRING)"


def _hashes(frame: DataFrame, columns: Sequence[str], like: T.DataType | None = None) -> list[Column]:
    """Two numbers for a key, for one column as the type it is compared as: a whole number by
    itself, which is shorter than its hash once compressed."""
    kinds = [frame.schema[c].dataType if like is None else like for c in columns]
    keys = [F.col(c).cast(kind) for c, kind in zip(columns, kinds)]
    if len(keys) == 1 and isinstance(kinds[0], T.IntegralType):
        return [keys[0].cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2")]
    return _hashed(keys)


def _hashed(columns: Sequence[Column]) -> list[Column]:
    # A hash passes over NULLs, so where they are is hashed too.
    parts = [*columns, *[c.isNull() for c in columns]]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")]


def _mark(rule: int, hashes: Sequence[Column], own: int = 1, missing: Column | None = None) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        *hashes,
        F.lit(own).cast("long").alias("own"),
        F.lit(False).alias("missing") if missing is None else missing.alias("missing"),
    )


def _marks(frame: DataFrame, marks: list[Column]) -> DataFrame:
    return frame.select(F.explode(F.array(*marks)).alias("mark")).select("mark.*")


def measured(frames: Mapping[str, DataFrame], rules: Sequence[Rules], part: int = 0, parts: int = 1) -> DataFrame:
    """``number`` of the rule, counted through all tables in order, ``table_name``, ``rule`` and
    ``measured``: the rows (keys, where those are unique) that break it.

    With ``parts``, by the marks of one part of all keys only; the sums over all parts are the
    measures. Marks of equal keys are in the same part.
    """
    names = [(r.table, name) for r in rules for name in r.names]
    if len(set(names)) < len(names):
        raise ValueError("two rules of a table have the same name")
    number = {pair: n for n, pair in enumerate(names)}
    kinds: dict[int, int] = {}
    marks: dict[str, list[Column]] = {r.table: [] for r in rules}
    # Row rules of one table share marks, under the number of the first of them.
    row_rules: dict[int, list[int]] = {}
    for r in rules:
        if r.row:
            numbers = [number[r.table, name] for name in r.row]
            row_rules[numbers[0]] = numbers
            bits = [F.when(broken, F.lit(1 << bit)).otherwise(F.lit(0)) for bit, broken in enumerate(r.row.values())]
            broken = reduce(lambda a, b: a.bitwiseOR(b), [b.cast("long") for b in bits])
            marks[r.table].append(_mark(numbers[0], [broken.alias("h1"), F.lit(0).cast("long").alias("h2")]))
            kinds[numbers[0]] = _ROW
        for name, columns in r.unique.items():
            kinds[number[r.table, name]] = _REPEATED
            marks[r.table].append(_mark(number[r.table, name], _hashes(frames[r.table], columns)))
        for name, column in r.primary.items():
            kinds[number[r.table, name]] = _REPEATED_OR_MISSING
            hashes = _hashes(frames[r.table], [column])
            marks[r.table].append(_mark(number[r.table, name], hashes, missing=F.col(column).isNull()))
        for name, (column, parent, parent_column) in r.references.items():
            n = number[r.table, name]
            kinds[n] = _ORPHAN
            like = frames[parent].schema[parent_column].dataType
            missing = F.col(column).cast(like).isNull()
            marks[r.table].append(_mark(n, _hashes(frames[r.table], [column], like), missing=missing))
            marks.setdefault(parent, []).append(_mark(n, _hashes(frames[parent], [parent_column]), own=0))

    every = reduce(DataFrame.unionByName, [_marks(frames[table], of) for table, of in marks.items() if of])
    if parts > 1:
        every = every.where(F.pmod(F.xxhash64("h1"), F.lit(parts)) == part)
    held_too = F.count_if(F.col("own") == 0) > 0
    counted = every.groupBy("rule", "h1", "h2").agg(
        F.sum("own").alias("own"), held_too.alias("held"), F.max("missing").alias("missing")
    )
    kind = F.get(literal_array([kinds.get(n, _ROW) for n in range(len(names))]), F.col("rule"))
    repeated, own = F.col("own") > 1, F.col("own")
    broken = (
        F.when(kind == _REPEATED, repeated.cast("long"))
        .when(kind == _REPEATED_OR_MISSING, (repeated | F.col("missing")).cast("long"))
        .when(kind == _ORPHAN, F.when(~F.col("held") & ~F.col("missing"), own).otherwise(0))
    )
    single = F.array(F.struct(F.col("rule").alias("number"), broken.alias("measured")))
    result = F.when(kind != _ROW, single)
    for first, numbers in row_rules.items():
        counts = ", ".join(
            f"named_struct('number', {n}, 'measured', IF(getbit(h1, {bit}) = 1, own, 0L))" for bit, n in enumerate(numbers)
        )
        result = result.when(F.col("rule") == first, F.expr(f"array({counts})"))
    values = counted.select(F.inline(result))
    # A rule without any row is measured too.
    none = every.sparkSession.range(len(names)).select(F.col("id").cast("int").alias("number"), F.lit(0).cast("long").alias("measured"))
    totals = values.unionByName(none).groupBy("number").agg(F.sum("measured").alias("measured"))
    tables, rule_names = ([pair[i] for pair in names] for i in (0, 1))
    return totals.select(
        "number",
        F.get(literal_array(tables), F.col("number")).alias("table_name"),
        F.get(literal_array(rule_names), F.col("number")).alias("rule"),
        "measured",
    )
