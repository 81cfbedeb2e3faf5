"""Headered CSV files as untyped text, checked against the declared columns.

A line ends at a line feed, a carriage return or both. Lines of blanks alone are skipped.
How a file is read follows from what is in it and never from its size: if every line is
a record by itself, Spark splits it freely; otherwise its lines are put together to
records first.
"""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Callable
from functools import reduce
from operator import or_
from typing import NamedTuple
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F, types as T

from starloom import files as storage, workspace

logger = logging.getLogger(__name__)

# Field texts that mean "missing".
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

_QUOTING = {"quote": '"', "escape": '"'}
_RECORD = "_record"
# Appended to a malformed record to see where its fields end.
_END_MARK = "\u0001"
# A line on which every field is either free of quotes or wholly quoted.
_PLAIN_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
_PLAIN_LINE = f"^{_PLAIN_FIELD}(?:,{_PLAIN_FIELD})*+$"
# A field in general: a quote counts at its start only, and text may follow the closing one.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELD = f'(?:"{_QUOTED}|[^",][^,]*+|)'
# Lines that end outside quotes, when they begin outside and inside.
_ENDS_OUTSIDE = f"^{_FIELD}(?:,{_FIELD})*+$"
_CLOSES = f"^{_QUOTED}(?:,{_FIELD})*+$"
# One field after the other, each with the comma behind it, and the two parts of a quoted one.
_FIELDS = r'("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+),'
_QUOTED_FIELD = r'^"([^"]*+(?:""[^"]*+)*+)"([^,]*+)$'
# What a line shows, as bits.
_UNDECODABLE, _NUL, _DOUBTFUL = 1, 2, 4
_GLOB_SIGNS = r"([\[\]{}*?\\])"


class _Seen(NamedTuple):
    """What one scan found in a file."""

    path: str
    header: list[str | None]
    plain: bool
    # Where its last block begins; a block is what one task reads of a file.
    last_block: int


def _exact(paths: list[str]) -> list[str]:
    """The paths, with what would be a glob sign in them escaped."""
    return [re.sub(_GLOB_SIGNS, r"\\\1", p) for p in paths]


def _header_fields(line: str | None) -> list[str | None]:
    if line is None:
        return []
    return [name or None for name in next(csv.reader([line]))]


def _per_file(spark: SparkSession, paths: list[str]) -> DataFrame:
    """What the lines of each file show: one aggregate over all lines, a row a file.

    The signs of lines are collected as a set of few numbers. With a set among them Spark
    keeps the aggregates of a file as objects, and does not sort the lines by file, all of
    them in memory, for the sake of the first one's text.
    """
    line = F.col("value")
    filled = F.trim(line, F.lit(" \t")) != ""
    lines = spark.read.text(_exact(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    undecodable = ~F.is_valid_utf8(line)
    nul = F.contains(line, F.lit("\u0000"))
    doubtful = F.contains(line, F.lit('"')) & ~line.rlike(_PLAIN_LINE)
    signs = (_UNDECODABLE, undecodable), (_NUL, nul), (_DOUBTFUL, doubtful)
    return lines.groupBy("uri").agg(
        F.collect_set(reduce(Column.bitwiseOR, [F.when(shown, bit).otherwise(0) for bit, shown in signs])).alias("signs"),
        F.min(F.when(filled, F.struct("block", "id", "value"))).alias("first"),
        F.max("block").alias("last_block"),
        _file().alias("file"),
    )


def _scan(spark: SparkSession, path: str) -> list[_Seen]:
    """Header and kind of every file; fails on bytes that are not text."""
    found = storage.list_files(spark, path)
    if not found:
        raise FileNotFoundError(f"File not found: {path}")
    rows = _per_file(spark, [f.path for f in found]).collect()
    if len({row["file"] for row in rows}) < len(rows):
        raise ValueError(f"two file names of {path} have the same hash; rename one")
    seen = {unquote(urlparse(row["uri"]).path): row for row in rows}
    result = []
    for file in found:
        row = seen.get(urlparse(file.path).path if "://" in file.path else file.path.split(":", 1)[-1])
        if row is None or row["first"] is None:
            if len(found) == 1:
                raise ValueError(f"{path} has no header")
            continue
        found_signs = reduce(or_, row["signs"])
        if found_signs & _UNDECODABLE:
            raise ValueError(f"{file.path} holds bytes that are not UTF-8")
        if found_signs & _NUL:
            raise ValueError(f"{file.path} holds a NUL character")
        header = _header_fields(row["first"]["value"].lstrip("\ufeff"))
        result.append(_Seen(file.path, header, not found_signs & _DOUBTFUL, row["last_block"]))
    if not result:
        raise ValueError(f"{path} has no header")
    return result


def _column_names(header: list[str | None]) -> list[str]:
    """The header as usable names; a blank or repeated one gets its place as name."""
    names, seen = [], set()
    for place, name in enumerate(header):
        usable = name is not None and name.lower() not in seen
        names.append(name if usable else f"_field{place}")
        seen.add(names[-1].lower())
    return names


def missing_to_null(column: str) -> Column:
    return F.when(~F.col(column).isin(*MISSING_MARKERS), F.col(column))


def _schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _value(field: Column) -> Column:
    """The text of a field: quotes around it taken off and doubled ones made single, and what
    follows the closing quote as it stands."""
    inner, tail = (F.regexp_extract(field, _QUOTED_FIELD, i) for i in (1, 2))
    return F.when(F.startswith(field, F.lit('"')), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), tail)).otherwise(field)


def _has_more_fields(width: int) -> Column:
    """True for a record with too many fields; a short one is only padded.

    A marker appended as one more field shows behind at most ``width`` others.
    """
    fields = [f"f{i}" for i in range(width + 1)]
    ended = F.concat(F.col(_RECORD), F.lit("," + _END_MARK))
    parsed = F.from_csv(
        ended, ", ".join(f"{f} STRING" for f in fields), {**_QUOTING, "multiLine": "true"}
    )
    shown = F.array_contains(F.array(*[parsed[f] for f in fields]), _END_MARK)
    return ~F.coalesce(shown, F.lit(False))


def _read_plain(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """Files whose lines are their records; split like any text."""
    rows = (
        spark.read.schema(_schema([*names, _RECORD]))
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD, **_QUOTING)
        .csv(_exact(paths))
    )
    too_long = F.col(_RECORD).isNotNull() & _has_more_fields(len(names))
    return rows.withColumn(_RECORD, F.when(too_long, F.col(_RECORD)))


def _file() -> Column:
    """Stands for a file's name: short, and quick to sort by."""
    return F.xxhash64("uri")


def _lines_with_ends(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(uri, file, block, id, place, line, end): the lines of the files in order, as written."""
    raw = spark.read.text(_exact(paths), lineSep="\n").select(
        "value",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    # A carriage return right before the line feed belongs to it, any other is an end itself.
    with_feed = F.endswith("value", F.lit("\r"))
    text = F.when(with_feed, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    parts = raw.select("uri", "block", "id", with_feed.alias("both"), F.split(text, "\r", -1).alias("parts"))
    last = F.col("place") == F.size("parts") - 1
    return parts.select("*", F.posexplode("parts").alias("place", "line")).select(
        "uri",
        _file().alias("file"),
        "block",
        "id",
        "place",
        "line",
        F.when(~last, F.lit("\r")).when(F.col("both"), F.lit("\r\n")).otherwise(F.lit("\n")).alias("end"),
    )


def _begins(order: WindowSpec, outside: Column, inside: Column, first: Column) -> tuple[Column, Callable[[Column], Column]]:
    """Whether a line begins outside quotes, from the lines before it in a window.

    ``outside`` and ``inside`` tell where a line ends that begins there. It ends in the same
    place either way, or keeps or swaps the place. So the last line of the first kind and the
    swaps since decide, or all swaps where there is none and the ``first`` line begins as
    given. Returns the swaps so far, to be made a column, and what to do with that column.
    """
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swapped = F.coalesce(F.sum(F.when(~outside & inside, 1).otherwise(0)).over(before), F.lit(0)) % 2 == 1

    def begins(swapped_before: Column) -> Column:
        settled = F.last(F.when(outside == inside, outside != swapped_before), ignorenulls=True).over(before)
        return F.coalesce(settled, first) != swapped_before

    return swapped, begins


class UnclosedQuoteError(ValueError):
    """A quoted field without an end."""


def _heads(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """The blocks of files whose first lines go on with a record of an earlier block.

    ``home`` is the block that record begins in, ``close`` the place of its last line in this
    block (NULL if it goes on behind it), ``header_block`` the block of the file's header. A
    block is what one task reads of a file. What it does to the place, outside quotes or
    inside, is found within it for both places it may begin in; a running composition over a
    file's blocks, one row each, then tells which it is.
    """
    at, out, into = F.struct("id", "place"), F.col("out"), F.col("in")
    in_block = Window.partitionBy("file", "block").orderBy("id", "place")
    swapped, begins = _begins(in_block, out, into, F.lit(True))
    _, begins_inside = _begins(in_block, out, into, F.lit(False))
    mapped = lines.select("file", "block", "id", "place", "out", "in", "filled", swapped.alias("swapped")).select(
        "*", begins(F.col("swapped")).alias("b_out"), begins_inside(F.col("swapped")).alias("b_in")
    )
    end = {b: F.when(F.col(b), out).otherwise(into) for b in ("b_out", "b_in")}
    opening = {b: F.max(F.when(F.col(b) & ~end[b], at)) for b in end}
    blocks = mapped.groupBy("file", "block").agg(
        F.max_by(end["b_out"], at).alias("out"),
        F.max_by(end["b_in"], at).alias("in"),
        # The line with the quote that is still open at the end, if it opens in this block.
        opening["b_out"].alias("out_opens"),
        opening["b_in"].alias("in_opens"),
        F.min(F.when(end["b_in"], at)).alias("close"),
        F.max("filled").alias("filled"),
    )
    in_file = Window.partitionBy("file").orderBy("block")
    swapped, begins = _begins(in_file, out, into, F.lit(True))
    begin = F.col("begins")
    outside = F.when(begin, out).otherwise(into)
    opens = F.when(~outside, F.struct("block", F.when(begin, F.col("out_opens")).otherwise(F.col("in_opens")).alias("line")))
    placed = (
        blocks.select("*", swapped.alias("swapped"))
        .select("*", begins(F.col("swapped")).alias("begins"))
        .select("*", F.when(opens["line"].isNotNull(), opens).alias("opens"), outside.alias("outside"))
    )
    upto = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = placed.select(
        "file",
        "block",
        "close",
        "begins",
        F.last("opens", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))["block"].alias("home"),
        F.min(F.when(F.col("filled"), F.col("block"))).over(Window.partitionBy("file")).alias("header_block"),
        F.when(
            ~F.col("outside") & F.lead("block").over(in_file).isNull(), F.last("opens", ignorenulls=True).over(upto)
        ).alias("unclosed"),
    )
    needed = ~begin | (F.col("block") == F.col("header_block"))
    folder = workspace.scratch(spark, "csv-blocks")
    owned.where(needed | F.col("unclosed").isNotNull()).write.parquet(folder)
    stored = spark.read.schema(owned.schema).parquet(folder)
    unclosed = stored.where(F.col("unclosed").isNotNull()).orderBy("file").first()
    if unclosed:
        block, (number, part) = unclosed["unclosed"]
        opened = (F.col("file") == unclosed["file"]) & (F.col("block") == block) & (F.col("id") == number) & (F.col("place") == part)
        found = lines.where(opened).first()
        raise UnclosedQuoteError(_UNCLOSED.format(unquote(urlparse(found["uri"]).path), found["line"][:_SHOWN], block))
    return stored.where(needed).select(
        "file", "block", F.when(~begin, F.col("home")).alias("home"), "close", "header_block"
    )


_UNCLOSED = "{} has a quoted field without an end, in the line {!r} behind byte {}"
_SHOWN = 80


def _read_records(spark: SparkSession, files: list[_Seen], names: list[str]) -> DataFrame:
    """Files in which quoted fields run over line ends, a task for each block of a file.

    A block's lines are put together to records where they are. Lines that end a record of an
    earlier block go to that block, its ``home``; so the lines of a home begin with a record.
    Files that are one block each need no look at how blocks go on.
    """
    line = F.col("line")
    quoted = F.contains(line, F.lit('"'))
    lines = _lines_with_ends(spark, [f.path for f in files]).select(
        "*",
        # A line without quotes keeps the place.
        F.when(quoted, line.rlike(_ENDS_OUTSIDE)).otherwise(True).alias("out"),
        F.when(quoted, line.rlike(_CLOSES)).otherwise(False).alias("in"),
        (F.trim(line, F.lit(" \t")) != "").alias("filled"),
    )
    if any(f.last_block for f in files):
        at = F.struct("id", "place")
        is_head = F.col("home").isNotNull() & (F.col("close").isNull() | (at <= F.col("close")))
        home = F.when(is_head, F.col("home")).otherwise(F.col("block")).alias("home")
        at_home = lines.join(_heads(spark, lines), ["file", "block"], "left").select(*lines.columns, home, "header_block")
    else:
        at_home = lines.select("*", F.col("block").alias("home"), F.lit(0).alias("header_block"))
    in_order = Window.partitionBy("file", "home").orderBy("block", "id", "place")
    swapped, begins = _begins(in_order, F.col("out"), F.col("in"), F.lit(True))
    starts = F.col("begins") & F.col("filled")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        at_home.select("*", swapped.alias("swapped"))
        .select("*", begins(F.col("swapped")).alias("begins"))
        .select("*", F.count_if(starts).over(upto).alias("number"))
        # Lines of blanks between records.
        .where(~F.col("begins") | F.col("filled"))
    )
    is_header = (F.col("number") == 1) & F.col("home").eqNullSafe(F.col("header_block"))
    place = F.struct("block", "id", "place")
    records = numbered.where(~is_header).groupBy("file", "home", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "id", "place", "line", "end"))).alias("parts"),
        F.max_by(F.when(F.col("begins"), F.col("out")).otherwise(F.col("in")), place).alias("closed"),
        F.any_value("uri").alias("uri"),
    )
    # Lines of one record with the ends between them, without the last end.
    ends = F.array_join(F.transform("parts", lambda x: F.concat(x["line"], x["end"])), "")
    last_end = F.length(F.element_at("parts", -1)["end"])
    record = F.substring(ends, F.lit(1), F.length(ends) - last_end)
    start = F.get("parts", F.lit(0))
    unclosed = F.format_string(
        _UNCLOSED.replace("{!r}", "'%s'").replace("{}", "%s"), "uri", F.left(start["line"], F.lit(_SHOWN)), start["block"].cast("string")
    )
    whole = F.when(F.col("closed"), record).otherwise(F.raise_error(unclosed).cast("string"))
    fields = F.regexp_extract_all(F.concat(_RECORD, F.lit(",")), F.lit(_FIELDS), F.lit(1))
    parsed = records.select(whole.alias(_RECORD)).select(_RECORD, fields.alias("_fields"))
    too_long = F.when(F.size("_fields") > len(names), F.col(_RECORD))
    return parsed.select(*[_value(F.get("_fields", F.lit(i))).alias(n) for i, n in enumerate(names)], too_long.alias(_RECORD))


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The named columns, in that order, as text; missing markers become NULL.

    ``path`` is a file, a folder or a glob.
    """
    found = _scan(spark, path)
    header = found[0].header
    names = _column_names(header)
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"{path} is missing columns: {missing}")
    other = next((f for f in found if f.header != header), None)
    if other:
        raise ValueError(f"{other.path} has another header than {found[0].path}")

    plain = [f.path for f in found if f.plain]
    woven = [f for f in found if not f.plain]
    parts = [read(spark, files, names) for read, files in ((_read_plain, plain), (_read_records, woven)) if files]
    rows = reduce(DataFrame.unionByName, parts)

    message = F.concat(F.lit(f"{path} has a row with more fields than its header: "), _RECORD)
    checked = rows.where(
        F.when(F.col(_RECORD).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    )
    return checked.select(*[missing_to_null(c).alias(c) for c in columns])
