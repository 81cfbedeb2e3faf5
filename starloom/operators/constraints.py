"""The rules a warehouse table must meet before it is published."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators import rules
from starloom.schemas import Target

ROWS = rules.ROWS

# Rows whose keys are checked together, and the most parts, since each part reads all tables.
ROWS_A_PART = 1 << 27
MOST_PARTS = 4


class ConstraintError(ValueError):
    """A built table breaks one of its declared rules."""


def _row_rules(target: Target) -> dict[str, Column]:
    """Rules checkable on the row alone, true where it breaks one."""
    broken = {f"not_null({c})": F.col(c).isNull() for c in target.not_null}
    for column, limit in target.max_length.items():
        broken[f"max_length({column})"] = F.length(F.rtrim(F.col(column))) > limit
    return broken


def _key_rules(target: Target, row: Mapping[str, Column] | None = None) -> rules.Rules:
    return rules.Rules(
        target.table,
        row=row or {},
        unique={f"unique({', '.join(target.natural_key)})": target.natural_key},
        primary={f"primary_key({target.key})": target.key},
        references={
            f"references({column})": (column, parent, column) for column, parent in target.references.items()
        },
    )


def observed_rules(target: Target) -> list[Column]:
    """The row rules as metrics of the write itself: no extra scan."""
    counts = {name: F.count_if(broken) for name, broken in _row_rules(target).items()}
    return [rule.alias(name) for name, rule in {ROWS: F.count(F.lit(1)), **counts}.items()]


def enforce(target: Target, metrics: Mapping[str, int]) -> None:
    broken = {k: n for k, n in metrics.items() if k != ROWS and n}
    if broken:
        listed = "\n".join(f"{rule}: {n:,} violations" for rule, n in broken.items())
        raise ConstraintError(f"{target.qualified} breaks its rules:\n{listed}")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows and distinct values of ``column`` that ``parent`` does not hold; NULL is no orphan.

    Equal values are counted together first, so a hot one reaches the join as one row.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    held = parent.select(F.col(parent_column).alias("_value"))
    return counted.join(held, "_value", "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_values"),
    )


def enforce_keys(tables: Mapping[str, DataFrame], targets: tuple[Target, ...], rows: int = 0) -> None:
    """Unique keys, primary keys and references of written tables; only key columns are read.

    Tables of many ``rows`` are read several times, each time for a part of the keys, so that
    the marks of one part are all that is shuffled at a time.
    """
    parts = min(MOST_PARTS, max(1, -(-rows // ROWS_A_PART)))
    key_rules = [_key_rules(target) for target in targets]
    found: Counter[tuple[int, str, str]] = Counter()
    for part in range(parts):
        for row in rules.measured(tables, key_rules, part, parts).collect():
            found[row["number"], row["table_name"], row["rule"]] += row["measured"]
    broken = [(table, rule, count) for (_, table, rule), count in sorted(found.items()) if count]
    if broken:
        listed = "\n".join(f"{table} {rule}: {count:,} violations" for table, rule, count in broken)
        raise ConstraintError(f"the written tables break their rules:\n{listed}")


def constraint_report(tables: Mapping[str, DataFrame], targets: tuple[Target, ...]) -> DataFrame:
    """(table_name, rule, bad_rows) for every declared rule, references included."""
    every = rules.measured(tables, [_key_rules(target, _row_rules(target)) for target in targets])
    return every.select("table_name", "rule", F.col("measured").alias("bad_rows"))
