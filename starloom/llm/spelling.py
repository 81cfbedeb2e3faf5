"""Spelling variants: the words of a corpus, their near words, and the form each stands for.

Words are runs of letters of whole texts, with a few letters removed at fixed random places
to stand for misspellings. They are counted where they are read and then by Spark.

Near words are found by :mod:`bit_slices`, in blocks of the vocabulary. Of two words one
letter apart, the shorter with m letters, the first half of m letters or the last one is the
same. So each word goes to the blocks of its first and of its last half, once for m as its
own length and once for m one less. Blocks hold the words of many such halves, about
``BLOCK`` words each, so the work grows with the vocabulary and not with its square; every
pair is found in one block only. A block that one half overfills is cut into pieces, and
each piece of looked-up words meets each piece of the index in a task of its own.

Defined results: a null or empty text has no words; a null ``doc_id`` counts as an empty
one; rows that repeat are counted each; an empty table gives an empty one; extra columns
are not read; texts and words of any length are whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom import workspace
from starloom.llm.bit_slices import BitSlices, letter_matrix
from starloom.llm.texts import ASCII_LOWER, Hasher, Texts, runs, slices, small_batches
from starloom.operators.rules import literal_array

LEAST_LETTERS = 5
LEAST_COUNT = 3
REMOVED_EVERY = 97
FORM_FACTOR = 2

BLOCK = 2_048
# Blocks of words beyond this length share one count of blocks, so there are few counts.
_LONGEST_CLASS = 255

_POLYNOMIAL = 0xEDB88320
_LONG_RUN = 64  # bytes; longer ones go to zlib one by one


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(_POLYNOMIAL), value >> 1)
    return value


_CRC = _crc_table()


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The crc32 of each span of bytes, going on from the crc ``before`` it."""
    sizes = ends - starts
    result = np.empty(len(starts), dtype=np.uint32)
    for i in np.flatnonzero(sizes > _LONG_RUN):
        result[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    # The rest a byte at a time, all spans together, the longest first.
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] <= _LONG_RUN]
    at, left = starts[order], sizes[order]
    state = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    for step in range(int(left[0]) if len(left) else 0):
        active = int(np.searchsorted(-left, -step, side="left"))
        now = state[:active]
        state[:active] = _CRC[(now ^ data[at[:active] + step]) & np.uint32(255)] ^ (now >> np.uint32(8))
    result[order] = state ^ np.uint32(0xFFFFFFFF)
    return result


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    taken = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(taken)])


def _counted(ids: list[str | None], texts: Texts) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts with their counts; hashes of 64 bits tell them apart."""
    data = ASCII_LOWER[texts.data]
    # A letter is a-z, or the two bytes of U+00C0 to U+00FF, of which the first is 0xC3.
    lead = data == 0xC3
    second = np.concatenate(([False], lead[:-1])) if len(lead) else lead
    starts, ends = runs(texts, ((data >= 97) & (data <= 122)) | lead | second)
    leads = np.concatenate(([0], np.cumsum(lead)))
    letters = (ends - starts) - (leads[ends] - leads[starts])
    enough = letters >= LEAST_LETTERS
    starts, ends, letters = starts[enough], ends[enough], letters[enough]
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
    drawn = crc32_of_spans(data, starts, ends, before[texts.rows_of(starts)])

    shortened: Counter[str] = Counter()
    hit = drawn % REMOVED_EVERY == 0
    for i in np.flatnonzero(hit):
        if letters[i] > LEAST_LETTERS:
            word = data[starts[i] : ends[i]].tobytes().decode()
            place = int(drawn[i]) % len(word)
            shortened[word[:place] + word[place + 1 :]] += 1

    starts, ends = starts[~hit], ends[~hit]
    _, first, counts = np.unique(Hasher(data).spans(starts, ends), return_index=True, return_counts=True)
    whole = _strings(data, starts[first], ends[first])
    words = pa.concat_arrays([whole, pa.array(list(shortened), pa.large_string())])
    return words, np.concatenate((counts, np.fromiter(shortened.values(), np.int64, len(shortened))))


def vocabulary(documents: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the words that have enough letters and come often enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, counts = _counted(batch.column("doc_id").to_pylist(), Texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    slim = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = slim.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _blocks_by_class(words: DataFrame) -> list[int]:
    """How many blocks the words whose shorter partner has m letters are dealt to, by m."""
    size = F.length("word")
    classes = F.explode(F.array(size, size - 1))
    per_class = words.select(classes.alias("short")).groupBy(F.least("short", F.lit(_LONGEST_CLASS)).alias("short"))
    found = {row["short"]: row["n"] for row in per_class.agg(F.count("*").alias("n")).collect()}
    return [-(-found.get(m, 1) // BLOCK) for m in range(_LONGEST_CLASS + 1)]


def _entries(words: DataFrame) -> DataFrame:
    """A row for each block a word belongs to."""
    counts = literal_array(_blocks_by_class(words))
    size = F.length("word")
    head = F.floor((F.col("short") + 1) / 2).cast("int")
    half = F.when(F.col("first_half"), F.substring(F.col("word"), F.lit(1), head)).otherwise(
        F.substring(F.col("word"), size - (F.col("short") - head) + 1, size)
    )
    blocks = F.get(counts, F.least("short", F.lit(_LONGEST_CLASS)))
    return (
        words.select("*", F.explode(F.array(size, size - 1)).alias("short"))
        .where(F.col("short") >= LEAST_LETTERS)
        .select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("first_half"))
        .select("word", "n", "short", "first_half", F.pmod(F.xxhash64(half), blocks).cast("int").alias("block"))
    )


_BLOCK_KEY = ["short", "first_half", "block"]
_PIECE_KEY = [*_BLOCK_KEY, "query_piece", "index_piece"]


def _in_pieces(entries: DataFrame) -> DataFrame:
    """Entries with the task they belong to; those of overfull blocks are in several."""
    whole = [F.lit(0).alias("query_piece"), F.lit(0).alias("index_piece")]
    both = [F.lit(True).alias("looked_up"), F.lit(True).alias("indexed")]
    sizes = entries.groupBy(*_BLOCK_KEY).agg(F.count("*").alias("_size"))
    overfull = sizes.where(F.col("_size") > 4 * BLOCK).select(*_BLOCK_KEY, F.ceil(F.col("_size") / BLOCK).cast("int").alias("_pieces"))
    if overfull.isEmpty():
        return entries.select("*", *whole, *both)
    dealt = entries.join(overfull, _BLOCK_KEY, "left")
    own = F.pmod(F.xxhash64("word"), F.col("_pieces")).cast("int")
    every = F.sequence(F.lit(0), F.col("_pieces") - 1)
    true, false = F.lit(True).alias("looked_up"), F.lit(False).alias("looked_up")
    tasks = F.concat(
        F.transform(
            every,
            lambda p: F.struct(own.alias("query_piece"), p.alias("index_piece"), true, (p == own).alias("indexed")),
        ),
        F.transform(
            F.array_remove(every, own),
            lambda p: F.struct(p.alias("query_piece"), own.alias("index_piece"), false, F.lit(True).alias("indexed")),
        ),
    )
    cut = dealt.where(F.col("_pieces").isNotNull()).select(*entries.columns, F.explode(tasks).alias("_task"))
    rest = dealt.where(F.col("_pieces").isNull()).select(*entries.columns, *whole, *both)
    return rest.unionByName(cut.select(*entries.columns, "_task.*"))


_FOUND = "word string, n long, n_near long, best_n long, best string"


def _near_in_block(block: pa.Table) -> pa.Table:
    """Of every word looked up: how many words of the block are near, and the best of them."""
    short, first_half = block.column("short")[0].as_py(), block.column("first_half")[0].as_py()
    head = (short + 1) // 2
    texts = block.column("word").to_pylist()
    words = np.array([w.encode("latin-1") for w in texts], dtype=object)
    counts = block.column("n").to_numpy()
    indexed = np.flatnonzero(block.column("indexed").to_numpy())
    indexed = indexed[np.argsort(words[indexed], kind="stable")]
    looked_up = block.column("looked_up").to_numpy()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    index = BitSlices(words[indexed].tolist(), short)

    who, whom = [], []
    for size in (short, short + 1):
        asked = np.flatnonzero(looked_up & (sizes == size))
        at, near = index.near(letter_matrix(words[asked].tolist(), size), size, head, first_half)
        who.append(asked[at])
        whom.append(near)
    who, whom = np.concatenate(who), np.concatenate(whom)

    # Indexed words are sorted, so of equal counts the first is the smallest.
    order = np.lexsort((whom, -counts[indexed[whom]], who))
    who, whom = who[order], whom[order]
    n_near = np.bincount(who, minlength=len(words))
    best = np.full(len(words), -1)
    first = np.flatnonzero(np.diff(who, prepend=-1))
    best[who[first]] = indexed[whom[first]]
    # Every word is told of once, near ones or not, so that none is missing.
    own_class = (sizes == short) & first_half & (block.column("index_piece").to_numpy() == 0)
    told = np.flatnonzero(looked_up & ((n_near > 0) | own_class))
    partner = pa.array(best[told], mask=best[told] < 0)
    return pa.table(
        {
            "word": block.column("word").take(pa.array(told)),
            "n": pa.array(counts[told]),
            "n_near": pa.array(n_near[told].astype(np.int64)),
            "best_n": block.column("n").take(partner),
            "best": block.column("word").take(partner),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """``words`` (``word``, ``n``) with ``n_near`` and the most frequent near word as ``best``
    and ``best_n``. ``words`` is read more than once: a written table."""
    found = _in_pieces(_entries(words)).groupBy(*_PIECE_KEY).applyInArrow(_near_in_block, _FOUND)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("rank"), "best")))
    return found.groupBy("word").agg(
        F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("_best")
    ).select("word", "n", "n_near", F.col("_best.best").alias("best"), (-F.col("_best.rank")).alias("best_n"))


def _written(df: DataFrame, label: str) -> DataFrame:
    place = workspace.scratch(df.sparkSession, label)
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words that have a ``form``: the last of the forms that follow.

    Each round doubles the steps a row has gone. Counts at least double from word to form,
    so there are few steps, and none leads back.
    """
    hops = _written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = hops.join(further, "root", "left")
        moved = joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        hops = _written(moved, "spelling-roots")
        if hops.where("_moved").isEmpty():
            return hops.select("word", "root")
        hops = hops.select("word", "root")


def variants(documents: DataFrame) -> DataFrame:
    """Per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``."""
    with small_batches(documents.sparkSession):
        words = _written(vocabulary(documents), "spelling-words")
    is_form = F.col("best_n") >= FORM_FACTOR * F.col("n")
    named = near_words(words).select(
        "word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
    )
    named = _written(named, "spelling-forms")
    last = roots(named.where(F.col("form").isNotNull()))
    return named.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


# DuckDB. A crc32 goes through the UTF-8 bytes by a table of its 256 one-byte steps; words one
# letter apart agree when a letter is taken out of one of them, or out of both at one place.
SQL = r"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
              ORDER BY i) AS t FROM range(256) x(i)),
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
per_doc AS (
  SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 5 GROUP BY ALL),
drawn AS (
  SELECT run, n, xor(list_reduce(
      flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
              lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM per_doc, steps),
spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
              ELSE run END AS word, n FROM drawn),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT one.word AS a, two.word AS b FROM cut one JOIN cut two ON one.rest = two.rest AND one.i = two.i AND one.word <> two.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word),
ranked AS (
  SELECT a, b, n, count(*) OVER (PARTITION BY a) AS n_near,
         row_number() OVER (PARTITION BY a ORDER BY n DESC, encode(b)) AS place
  FROM near JOIN words ON b = word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN ranked.n >= 2 * words.n THEN b END AS form, CASE WHEN ranked.n >= 2 * words.n THEN ranked.n END AS form_n
  FROM words LEFT JOIN ranked ON a = word AND place = 1),
followed AS (
  SELECT word, word AS goal FROM forms
  UNION ALL SELECT followed.word, forms.form FROM followed JOIN forms ON goal = forms.word WHERE forms.form IS NOT NULL),
ends AS (SELECT followed.word, goal FROM followed JOIN forms ON goal = forms.word WHERE forms.form IS NULL)
SELECT forms.word, n, n_near, form, form_n, goal AS root FROM forms JOIN ends ON forms.word = ends.word
"""
