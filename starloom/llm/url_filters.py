"""Which rule of a block list decides each url: a sorted sweep over reversed-host keys.

A rule names a host and a path; it fits urls of that host and its subdomains whose path
starts with its own, and of the rules that fit the longest decides (host and path together,
then the longer host). The key of a rule is its host's labels from the last to the first,
``/``, and its path, so the keys that start with it are one interval. A url has one such key
for every ending of its host that is no longer than a rule's host can be; it fits a rule
exactly if one of its keys lies in the rule's interval.

Keys and rules are dealt to ranges of keys, a rule to each range its interval meets. In a
range they are swept in order: a rule opens at its key and is closed by the first key that
does not start with it. Open rules are nested, so they form a stack, and its top is the
longest rule for all keys up to the next opening or closing. What is left is the longest
over the few keys of a url.

A range's bound is a key and a number drawn for the row, so one host or url that holds many
rows is spread over several ranges. Rules travel as rows like the urls do; nothing that
grows with either is broadcast or collected but one key a range.

Defined results: a null url, or one without ``://``, has an empty host and path; equal rows
are judged one by one; extra columns are not read; an empty table gives an empty one. Only
A-Z are lower-cased, in urls and in rules; ports, user names and empty labels are part of
the host as they stand. A rule with a null or empty host fits nothing, a null path fits
every path, and of equal rules with different verdicts ``block`` counts.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom import workspace
from starloom.operators import ranges

ALLOW, BLOCK = "allow", "block"

# The rules of the registered query.
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)

_FIRST = "CAST('-9223372036854775808' AS BIGINT)"  # before every number drawn for a row
_MATCHES = "id long, size int, host_size int, rule string, verdict string"


def _lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``page_id``, ``host`` and ``path`` of every url."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise("")
    return pages.select(
        "page_id",
        _lowered(F.regexp_extract(rest, "^[^/?#]*", 0)).alias("host"),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _labels(host: Column) -> Column:
    """The labels of a host, the last one first."""
    return F.reverse(F.split(host, r"\.", -1))


def _key(labels: Column, path: Column) -> Column:
    # No host holds a slash, so the one put between parts host and path without doubt.
    return F.concat(F.array_join(labels, "."), F.lit("/"), path).cast("binary")


def _intervals(rules: DataFrame) -> DataFrame:
    """One row a rule: the start of its interval of keys, its sizes, text and verdict."""
    host, path = _lowered(F.col("host")), F.coalesce("path", F.lit(""))
    named = rules.where(F.col("host") != "").groupBy(host.alias("host"), path.alias("path"))
    return named.agg(F.max("verdict").alias("verdict")).select(
        _key(_labels(F.col("host")), F.col("path")).alias("key"),
        (F.length("host") + F.length("path")).alias("size"),
        F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.size(F.split("host", r"\.", -1)).alias("labels"),
        F.length("path").alias("path_size"),
    )


class Open(NamedTuple):
    key: bytes
    row: tuple[int, int, str, str]


def _end_of(keys: pa.Array, start: int, stop: int, prefix: bytes) -> int:
    """The first place from ``start`` on whose key does not start with ``prefix``."""
    while start < stop:
        middle = (start + stop) // 2
        if keys[middle].as_py().startswith(prefix):
            start = middle + 1
        else:
            stop = middle
    return start


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The longest open rule of every url key that has one.

    Rows come by range and key, rules before urls. The stack goes on from batch to batch;
    work in Python is done once a rule and once for each run of keys under the same rule.
    """
    stack: list[Open] = []
    current = None
    for batch in batches:
        keys, rows = batch.column("key"), batch.num_rows
        of_range = batch.column(ranges.RANGE).to_numpy()
        rules = np.flatnonzero(~batch.column("is_url").to_numpy(zero_copy_only=False))
        changes = np.flatnonzero(np.diff(of_range)) + 1
        events = np.unique(np.concatenate((rules, changes, [rows])))
        is_rule = np.zeros(rows + 1, dtype=bool)
        is_rule[rules] = True
        top = np.full(rows, -1, dtype=np.int64)
        used: list[Open] = []
        at = 0
        while at < rows:
            if of_range[at] != current:
                current = of_range[at]
                stack.clear()
            if is_rule[at]:
                key = keys[at].as_py()
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                row = tuple(batch.column(name)[at].as_py() for name in ("size", "host_size", "rule", "verdict"))
                stack.append(Open(key, row))
                at += 1
                continue
            stop = int(events[np.searchsorted(events, at, side="right")])
            while at < stop and stack:
                end = _end_of(keys, at, stop, stack[-1].key)
                if end == at:
                    stack.pop()
                    continue
                top[at:end] = len(used)
                used.append(stack[-1])
                at = end
            at = stop
        hit = np.flatnonzero(top >= 0)
        places = pa.array(top[hit])
        of_rules = list(zip(*(open_rule.row for open_rule in used), strict=True)) or [[], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string())
        columns = [pa.array(values, kind).take(places) for values, kind in zip(of_rules, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(hit)), *columns], ["id", "size", "host_size", "rule", "verdict"]
        )


def _points(urls: DataFrame, labels: int, path_size: int) -> DataFrame:
    """The keys of every url that can lie in an interval: as many labels as a rule can have,
    and as much of the path as a rule's path can be long."""
    reversed_host = _labels(F.col("host"))
    reach = F.least(F.size(reversed_host), F.lit(labels))
    path = F.substring(F.col("path"), 1, path_size)
    # An empty host has one empty label and fits no rule.
    return (
        urls.where(F.col("host") != "")
        .select("id", reversed_host.alias("_labels"), path.alias("_path"), F.explode(F.sequence(F.lit(1), reach)).alias("_n"))
        .select("id", _key(F.slice("_labels", 1, F.col("_n")), F.col("_path")).alias("key"), F.xxhash64("id", "_n").alias("draw"))
    )


def longest_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``id``, ``rule`` and ``verdict`` of the urls (``id``, ``host``, ``path``) a rule fits.

    ``urls`` is read more than once, so its ids must be fixed: a written table.
    """
    spark = urls.sparkSession
    place = workspace.scratch(spark, "url-rules")
    _intervals(rules).write.parquet(place)
    intervals = spark.read.parquet(place)
    longest = intervals.agg(F.max("labels").alias("labels"), F.max("path_size").alias("path_size")).first()
    points = _points(urls, longest["labels"] or 0, longest["path_size"] or 0)
    bounds = ranges.sampled(points, ["key", "draw"], int(spark.conf.get("spark.sql.shuffle.partitions")))

    dealt = points.select(
        bounds.id_of(["key", "draw"]).alias(ranges.RANGE), "key", F.lit(True).alias("is_url"), "id"
    )
    # Text in UTF-8 holds no 0xFF, so this ends the interval of all keys with that start.
    last = bounds.id_of(["concat(key, X'FF')", _FIRST])
    first = bounds.id_of(["key", _FIRST])
    opened = intervals.select(
        F.explode(F.sequence(first, last)).alias(ranges.RANGE),
        "key",
        F.lit(False).alias("is_url"),
        "size",
        "host_size",
        "rule",
        "verdict",
    )
    both = dealt.unionByName(opened, allowMissingColumns=True).repartitionById(bounds.count, ranges.RANGE)
    in_order = both.sortWithinPartitions(ranges.RANGE, "key", "is_url")
    best = F.max(F.struct("size", "host_size", "rule", "verdict")).alias("best")
    return in_order.mapInArrow(sweep, _MATCHES).groupBy("id").agg(best).select("id", "best.rule", "best.verdict")


def judged(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """Per page: ``page_id``, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    spark = pages.sparkSession
    place = workspace.scratch(spark, "urls")
    with_host_and_path(pages).withColumn("id", F.monotonically_increasing_id()).write.parquet(place)
    urls = spark.read.parquet(place)
    found = urls.join(longest_rules(urls, rules), "id", "left")
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


# SQL for the rules of the registered query (DuckDB).
SQL = r"""
WITH parts AS (
  SELECT row_number() OVER () AS id, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
urls AS (
  SELECT id, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules (rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
ranked AS (
  SELECT id, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM urls JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN ranked ON urls.id = ranked.id AND place = 1
"""
