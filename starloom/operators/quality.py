"""Row-count, null and key-uniqueness checks over staged frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row, functions as F

from starloom.operators import rules
from starloom.schemas import Source

ROW_COUNT = "row_count"
NOT_NULL = "not_null"
UNIQUE = "unique"

# Duplicate groups named in an error message; all of them are stored beside the run.
SHOWN_DUPLICATES = 20


class QualityError(ValueError):
    """A staged table failed a check."""


def row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """NULLs per column, all from one aggregate over one scan."""
    columns = list(columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "null_rows").select(
        F.lit(table).alias("table_name"), "column_name", "null_rows"
    )


def duplicate_groups(df: DataFrame, key: Iterable[str]) -> DataFrame:
    """Keys held by more than one row. NULLs are equal; counts combine before the shuffle."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def ranked_duplicates(df: DataFrame, key: Iterable[str]) -> DataFrame:
    """All repeated keys, the most repeated first, ties in key order."""
    key = list(key)
    return duplicate_groups(df, key).orderBy(F.desc("cnt"), *key)


def _rules(source: Source) -> rules.Rules:
    return rules.Rules(
        source.qualified,
        row={ROW_COUNT: F.lit(True), **{c: F.col(c).isNull() for c in source.required}},
        unique={UNIQUE: source.primary_key},
    )


def quality_report(frames: Mapping[str, DataFrame], sources: Iterable[Source]) -> DataFrame:
    """Every check of every table as one job; ``position`` gives the order of the gate."""
    sources = list(sources)
    checks = [_rules(source) for source in sources]
    kinds = [kind for s in sources for kind in (ROW_COUNT, *[NOT_NULL] * len(s.required), UNIQUE)]
    columns = [c for s in sources for c in ("", *s.required, ", ".join(s.primary_key))]
    kind = F.get(rules.literal_array(kinds), F.col("number"))
    counts_rows = kind == ROW_COUNT
    return rules.measured({s.qualified: frames[s.table] for s in sources}, checks).select(
        F.col("number").alias("position"),
        "table_name",
        kind.alias("check_name"),
        F.when(~counts_rows, F.get(rules.literal_array(columns), F.col("number"))).alias("column_name"),
        "measured",
        F.when(counts_rows, F.col("measured") > 0).otherwise(F.col("measured") == 0).alias("passed"),
    )


def enforce(
    frames: Mapping[str, DataFrame], sources: Iterable[Source], folder: str | None = None
) -> list[Row]:
    """Run the report and raise on the first failure in table and check order.

    With a ``folder``, all duplicate groups of a failing table are written there.
    """
    sources = list(sources)
    rows = sorted(quality_report(frames, sources).collect(), key=lambda r: r.position)
    by_table = {source.qualified: source for source in sources}
    failed = next((r for r in rows if not r.passed), None)
    if failed is None:
        return rows
    table = failed.table_name
    if failed.check_name == ROW_COUNT:
        raise QualityError(f"{table} is empty")
    if failed.check_name == NOT_NULL:
        bad = [
            f"{r.column_name}: {r.measured:,} null rows"
            for r in rows
            if r.table_name == table and r.check_name == NOT_NULL and not r.passed
        ]
        raise QualityError(f"{table} null check failed:\n" + "\n".join(bad))
    source = by_table[table]
    ranked = ranked_duplicates(frames[source.table], source.primary_key)
    shown = ranked.limit(SHOWN_DUPLICATES).collect()
    lines = [str(tuple(r)) for r in shown]
    if failed.measured > len(shown):
        lines.append(f"and {failed.measured - len(shown):,} more")
    if folder:
        place = f"{folder}/{source.table}"
        ranked.write.parquet(place)
        lines.append(f"all of them: {place}")
    raise QualityError(
        f"{table} duplicate found in primary keys:\n    " + "\n    ".join(lines)
    )
