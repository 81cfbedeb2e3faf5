"""The best documents for each item, by impact vectors in buckets of falling length.

A document is a vector over the terms of the items: for each term its part, which grows with
the term's frequency in the document and falls with the document's length, times the square
root of the term's weight. An item is the vector of those roots for its own terms, so the
score is their inner product. Vectors are dealt and sorted by length, longest first, and
searched in buckets:

- The longest vectors are searched first. The ten best scores they yield are thresholds for
  all later ones, and scans skip the row groups in which every vector is so short that its
  length times the longest item's cannot reach any threshold (Cauchy-Schwarz).
- A bucket is passed over by the items for which that holds with the bucket's longest vector.
- Inside a bucket an item's heaviest coordinates are read, as many as it takes for what is
  left to stay under half the threshold. A vector goes on if its product over those
  coordinates, and the length of its rest times that of the item's rest, reach the threshold.
- Those that go on are scored exactly, in integers, from all their coordinates.

Items are taken in blocks of bounded size, each with a pass over the documents. A block's
terms, weights and thresholds are all that is broadcast or collected.

Defined results: a null or empty text has no terms, and counts in none of the statistics;
an item without terms, or with none that a document holds, has no rows; each row of the items
is an item and each row of the documents a document, repeated ids or not; a null ``doc_id``
comes after all others of equal score; extra columns are not read; empty tables give an
empty one. A term of the documents is known by a hash of 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from starloom import session, workspace
from starloom.llm.texts import ASCII_LOWER, Hasher, Texts, byte_table, runs, slices, small_batches

TOP = 10

# Fixed: the ASCII characters that are no part of a term (all but digits and letters).
_NO_TERM = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_IN_TERM = ~byte_table(_NO_TERM)

# An item block's bounds: rows and bytes of text. The terms of a block are held by each task.
BLOCK_ITEMS = 2_000
BLOCK_BYTES = 8 << 20

BUCKET = 2_048
# Shares of the vectors, the longest ones, that are searched before the others.
_FIRST_SHARES = (1 / 64, 1 / 8)
# Bounds are computed in doubles; this much more makes them safe.
_SLACK = 1 + 1e-9


def _spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = ASCII_LOWER[texts.data]
    return (data, *runs(texts, _IN_TERM[data]))


class Items(NamedTuple):
    """A block of items: the hashes of all their terms, sorted, and each item's terms by place."""

    hashes: np.ndarray
    ids: np.ndarray
    terms: list[np.ndarray]


def _hashed_terms(items: DataFrame) -> DataFrame:
    """``item`` and the hashes of its terms, each once."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = Texts(batch.column("text"))
            data, starts, ends = _spans(texts)
            row, hashes = texts.rows_of(starts), Hasher(data).spans(starts, ends).view(np.int64)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            found = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = [batch.column("item"), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "hashes"])

    return items.select("item", "text").mapInArrow(hashed, "item long, hashes array<long>")


def _collected(items: DataFrame) -> Items:
    rows = [r for r in _hashed_terms(items).collect() if r["hashes"]]
    rows.sort(key=lambda r: r["item"])
    every = [np.array(r["hashes"], dtype=np.int64).view(np.uint64) for r in rows]
    hashes = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
    terms = [np.searchsorted(hashes, h).astype(np.int64) for h in every]
    return Items(hashes, np.array([r["item"] for r in rows], dtype=np.int64), terms)


def _term_counts(documents: DataFrame, hashes: np.ndarray) -> DataFrame:
    """``doc_id``, ``n`` (all terms) and the items' ``terms`` it holds with their ``tf``, by term."""
    # At most the terms of a block of items.
    shared = documents.sparkSession.sparkContext.broadcast(hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "text"):
            texts = Texts(batch.column("text"))
            data, starts, ends = _spans(texts)
            rows = texts.rows_of(starts)
            found = Hasher(data).spans(starts, ends)
            place = np.searchsorted(known, found)
            hit = place < len(known)
            hit[hit] = known[place[hit]] == found[hit]
            pairs, tf = np.unique(rows[hit] * len(known) + place[hit], return_counts=True)
            bounds = np.searchsorted(pairs, np.arange(len(texts) + 1) * len(known)).astype(np.int32)
            n = np.bincount(rows, minlength=len(texts))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(n.astype(np.int64)),
                    "terms": pa.ListArray.from_arrays(bounds, (pairs % max(1, len(known))).astype(np.int32)),
                    "tf": pa.ListArray.from_arrays(bounds, tf.astype(np.int32)),
                }
            )

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(count, "doc_id long, n long, terms array<int>, tf array<int>").where("n > 0")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of a list column."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[bounds[0] : bounds[-1]], bounds - bounds[0]


def _squares(weights: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return weights.astype(np.float64) * parts.astype(np.float64) ** 2


def _vectors(counts: DataFrame, weights: np.ndarray, documents: int, all_terms: int) -> DataFrame:
    """``doc_id``, ``norm`` and the coordinates ``terms`` and ``parts`` of every vector but zero."""
    # One number a term of the block.
    shared = counts.sparkSession.sparkContext.broadcast(weights)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, bounds = _lists(batch.column("terms"))
            tf = _lists(batch.column("tf"))[0].astype(np.int64)
            n = batch.column("n").to_numpy()
            m = 100 - 90 + (90 * n * documents) // all_terms
            parts = (1_000_000_000 * tf) // (1_000 * tf + 8 * np.repeat(m, np.diff(bounds)))
            some = np.diff(bounds) > 0
            norm = np.zeros(len(n))
            if some.any():
                norm[some] = np.sqrt(np.add.reduceat(_squares(shared.value[terms], parts), bounds[:-1][some]))
            arrays = [
                batch.column("doc_id"),
                pa.array(norm),
                batch.column("terms"),
                pa.ListArray.from_arrays(bounds.astype(np.int32), parts),
            ]
            made = pa.RecordBatch.from_arrays(arrays, ["doc_id", "norm", "terms", "parts"])
            yield made.filter(pa.array(some))

    return counts.select("doc_id", "n", "terms", "tf").mapInArrow(
        weigh, "doc_id long, norm double, terms array<int>, parts array<long>"
    )


class Best(NamedTuple):
    """An item's best rows so far, the best first."""

    scores: np.ndarray
    missing: np.ndarray
    docs: np.ndarray

    def with_more(self, scores: np.ndarray, missing: np.ndarray, docs: np.ndarray, top: int) -> Best:
        every = [np.concatenate(pair) for pair in zip(self, (scores, missing, docs), strict=True)]
        order = np.lexsort((every[2], every[1], -every[0]))[:top]
        return Best(*[column[order] for column in every])


_NONE = Best(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))


class Searcher:
    """Searches buckets for the best vectors of a block of items."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, thresholds: np.ndarray, top: int):
        self.weights, self.top = weights, top
        # Heaviest first, and the item's length from each place on.
        self.terms = [t[np.argsort(-weights[t], kind="stable")] for t in terms]
        tails = [np.cumsum(weights[t][::-1])[::-1] for t in self.terms]
        self.rests = [np.sqrt(np.concatenate((tail, [0]))) * _SLACK for tail in tails]
        self.thresholds = thresholds.astype(np.int64)
        self.best = [_NONE] * len(terms)
        self.lengths = np.array([rest[0] for rest in self.rests])

    def bucket(self, norms: np.ndarray, terms: np.ndarray, parts: np.ndarray, bounds: np.ndarray, docs: pa.Array):
        if not len(norms):
            return
        longest = norms.max()
        active = np.flatnonzero(self.lengths * longest >= self.thresholds)
        if not len(active):
            return
        order = np.argsort(terms, kind="stable")
        holders = np.repeat(np.arange(len(norms)), np.diff(bounds))[order]
        columns = np.searchsorted(terms[order], np.arange(len(self.weights) + 1))
        products = (self.weights[terms] * parts)[order]
        squares = _squares(self.weights[terms], parts)[order]
        missing = docs.is_null().to_numpy(zero_copy_only=False)
        doc_ids = docs.fill_null(0).to_numpy()
        for item in active:
            threshold, rest = self.thresholds[item], self.rests[item]
            # As few coordinates as leave less than half the threshold open.
            read = int(np.searchsorted(-rest * longest, -threshold / 2, side="right"))
            read = min(max(read, 1), len(rest) - 1)
            score = np.zeros(len(norms), dtype=np.int64)
            seen = np.zeros(len(norms))
            for term in self.terms[item][:read]:
                span = slice(columns[term], columns[term + 1])
                score[holders[span]] += products[span]
                seen[holders[span]] += squares[span]
            if read < len(rest) - 1:
                left = np.sqrt(np.maximum(norms * norms * _SLACK - seen, 0))
                kept = np.flatnonzero((score + rest[read] * left) * _SLACK + 1 >= threshold)
                exact = self._exact(item, kept, terms, parts, bounds)
            else:
                kept = np.flatnonzero(score)
                exact = score[kept]
            good = (exact >= threshold) & (exact > 0)
            if good.any():
                kept = kept[good]
                self.best[item] = self.best[item].with_more(exact[good], missing[kept], doc_ids[kept], self.top)
                if len(self.best[item].scores) == self.top:
                    self.thresholds[item] = max(threshold, self.best[item].scores[-1])

    def _exact(self, item: int, kept: np.ndarray, terms: np.ndarray, parts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Scores of some vectors, from all their coordinates."""
        if not len(kept):
            return np.zeros(0, np.int64)
        own = np.zeros(len(self.weights), dtype=np.int64)
        own[self.terms[item]] = self.weights[self.terms[item]]
        sizes = np.diff(bounds)[kept]
        ends = np.cumsum(sizes)
        at = np.repeat(bounds[kept] - (ends - sizes), sizes) + np.arange(ends[-1])
        # No vector is without coordinates, so every segment has a start of its own.
        return np.add.reduceat(own[terms[at]] * parts[at], ends - sizes)


def _searched(vectors: DataFrame, terms: list[np.ndarray], weights: np.ndarray, thresholds: np.ndarray, top: int) -> DataFrame:
    """``place`` of the item in its block, ``doc_id`` and ``score``: each task's best rows."""
    # Bounded with the block: its items' terms, a weight a term, a threshold an item.
    shared = vectors.sparkSession.sparkContext.broadcast((terms, weights, thresholds))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*shared.value, top)
        for batch in batches:
            coordinates, bounds = _lists(batch.column("terms"))
            parts = _lists(batch.column("parts"))[0]
            searcher.bucket(batch.column("norm").to_numpy(), coordinates, parts, bounds, batch.column("doc_id"))
        for place, best in enumerate(searcher.best):
            if len(best.scores):
                yield pa.RecordBatch.from_pydict(
                    {
                        "place": pa.array(np.full(len(best.scores), place, np.int32)),
                        "doc_id": pa.array(best.docs, mask=best.missing),
                        "score": pa.array(best.scores),
                    }
                )

    return vectors.select("doc_id", "norm", "terms", "parts").mapInArrow(search, "place int, doc_id long, score long")


def _rank(group: str) -> Column:
    return F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))


def _written(df: DataFrame, label: str) -> DataFrame:
    place = workspace.scratch(df.sparkSession, label)
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def _ranked_block(documents: DataFrame, items: DataFrame, top: int) -> DataFrame | None:
    """``item``, ``rank``, ``doc_id``, ``score`` for one block of items."""
    spark = documents.sparkSession
    block = _collected(items)
    if not len(block.ids):
        return None
    seen = Observation()
    counts = _term_counts(documents, block.hashes).observe(
        seen, F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")
    )
    with small_batches(spark):
        counts = _written(counts, "search-terms")
    if not seen.get["documents"]:
        return None
    holding = np.zeros(len(block.hashes), dtype=np.int64)
    for row in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row["term"]] = row["count"]
    block = block._replace(terms=[t[holding[t] > 0] for t in block.terms])
    weights = np.array([weight(seen.get["documents"], int(df)) for df in holding], dtype=np.int64)

    with session.setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BUCKET):
        vectors = _vectors(counts, weights, seen.get["documents"], seen.get["terms"])
        # The id parts vectors of equal length, such as those of copies.
        dealt = vectors.repartitionByRange(F.desc("norm"), "doc_id").sortWithinPartitions(F.desc("norm"))
        vectors = _written(dealt, "search-vectors")
        shares = F.percentile_approx("norm", [1 - share for share in _FIRST_SHARES], 1_000)
        cuts = sorted(vectors.agg(shares.alias("cuts")).first()["cuts"] or [], reverse=True)
        lengths = np.array([math.sqrt(weights[t].sum()) for t in block.terms])
        thresholds = np.zeros(len(block.ids), dtype=np.int64)
        best = None
        for upper, lower in zip([None, *cuts], [*cuts, None], strict=True):
            band = vectors
            if upper is not None:
                band = band.where(F.col("norm") < upper)
            if lower is not None:
                band = band.where(F.col("norm") >= lower)
            if thresholds.all():
                # No item can reach its threshold with a shorter vector.
                band = band.where(F.col("norm") >= float((thresholds / np.maximum(lengths, 1e-9)).min() / _SLACK))
            found = _searched(band, block.terms, weights, thresholds, top)
            found = found if best is None else best.drop("rank").unionByName(found)
            best = _written(found.withColumn("rank", _rank("place")).where(F.col("rank") <= top), "search-best")
            if lower is not None:
                for row in best.where(F.col("rank") == top).collect():
                    thresholds[row["place"]] = row["score"]
    named = spark.createDataFrame(list(enumerate(block.ids.tolist())), "place int, item long")
    return best.join(named, "place").select("item", "rank", "doc_id", "score")


def ranked(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Per item its ``top`` best documents: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    spark = documents.sparkSession
    items = _written(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "search-items")
    size = items.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["rows"] // BLOCK_ITEMS), -(-size["bytes"] // BLOCK_BYTES))
    parts = []
    for block in range(blocks):
        of_block = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        found = _ranked_block(documents, of_block, top)
        if found is not None:
            parts.append(found)
    if not parts:
        return items.limit(0).select(
            "item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")
        )
    every = reduce(DataFrame.unionByName, parts)
    return every.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


# DuckDB.
SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM docs WHERE len(t) > 0),
asked AS (
  SELECT i, item_id, unnest(list_distinct(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
held AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, totals GROUP BY term, n_docs),
scores AS (
  SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), totals GROUP BY i, item_id, r, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
