"""Exact n-gram Jaccard join by grouped prefixes.

Two documents link when their shingle sets have a Jaccard similarity of at least
``percent``. Shingles are ordered from rare to frequent by a count sketch over all
documents. Sets that link share a shingle among their first ``(1 - t) n + 1``, their
prefix, so only documents that meet there are compared:

1. Documents with equal sets form a class, classes with equal prefix and size a group.
2. A shingle's place in a prefix bounds the sizes of the sets that can link through it. So a
   posting list holds, per shingle and band of sizes, the sets of that size in whose first
   places the shingle is, and is met by the sets that such a size could link with.
3. In every list all are compared with one leader, the set with the fewest rarer shingles:
   of near copies the one least changed. So are the members of a group. Large families
   join up at this cost, linear in their number.
4. Whatever then meets in a list without being connected yet is compared pair by pair. No
   pair of one component is looked at, since it could not change the result.

What the two prefixes do not rule out is compared exactly, on the sets of 64-bit shingle
hashes made from whole texts.

Defined results: a null text or one without words has no shingles and stays alone; a null
``doc_id`` takes part through equal sets only and never names a component; rows that repeat
an id are documents of their own; extra columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom import session, workspace
from starloom.llm import resident
from starloom.llm.components import connected
from starloom.llm.texts import (
    ASCII_LOWER,
    NOT_BLANK,
    U64,
    Hasher,
    Texts,
    mix,
    plainly_named,
    runs,
    slices,
    small_batches,
    windows,
)

#: Words of a shingle and the least similarity, unless a caller asks for others.
WORDS = 5
PERCENT = 80

#: Counters of the frequency sketch, 2 bytes each: the bound of what is broadcast.
SKETCH = 1 << 22
#: Bits of the filter on documents to compare: the bound of that broadcast.
FILTER = 1 << 24
_CHUNK = 1 << 14
_BLOCK = 500
_SLICE_BYTES = 1 << 20
_BAND = 1.05


def shingles(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the distinct shingles of every text, sorted by row and hash."""
    data = ASCII_LOWER[texts.data]
    starts, ends = runs(texts, NOT_BLANK[data])
    words, rows = Hasher(data).spans(starts, ends), texts.rows_of(starts)
    if not len(words):
        return rows, words
    found = windows(words, size)
    whole = rows[: len(found)] == rows[size - 1 :]
    all_rows, hashes = [rows[: len(found)][whole]], [found[whole]]
    counts = np.bincount(rows, minlength=len(texts))
    for short in range(1, size):  # too few words: the whole sequence is the only shingle
        at = np.flatnonzero(counts[rows] == short)
        if len(at):
            at = at[::short]
            all_rows.append(rows[at])
            hashes.append(mix(windows(words, short)[at] + U64(short)))
    row, value = np.concatenate(all_rows), np.concatenate(hashes)
    order = np.argsort(value)
    order = order[np.argsort(row[order].astype(np.uint16 if len(texts) < 1 << 16 else np.int64), kind="stable")]
    row, value = row[order], value[order]
    first = np.ones(len(row), dtype=bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[first], value[first]


def _bounds(rows: np.ndarray, count: int) -> np.ndarray:
    return np.searchsorted(rows, np.arange(count + 1))


def _fingerprints(value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set."""
    sums = []
    with np.errstate(over="ignore"):
        for salt in (U64(0x1F83D9ABFB41BD6B), U64(0x5BE0CD19137E2179)):
            total = np.concatenate(([U64(0)], np.cumsum(mix(value ^ salt))))
            sums.append(mix(total[bounds[1:]] - total[bounds[:-1]]).astype(np.int64))
    return sums[0], sums[1]


class Packed:
    """An array that is compressed wherever it is sent, so that the driver's JVM, which keeps
    what it broadcasts, does not hold it in full."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def __reduce__(self) -> tuple:
        return _unpacked, (zlib.compress(self.values.tobytes(), 1), self.values.dtype.str)


def _unpacked(data: bytes, dtype: str) -> Packed:
    return Packed(np.frombuffer(zlib.decompress(data), dtype=dtype))


def _merged(
    parts: DataFrame, size: int, dtype: str, merge: np.ufunc, last: Callable[[np.ndarray], np.ndarray], sent: str
) -> np.ndarray:
    """Merge partial arrays, given as numbered chunks, on their way to the driver, which gets of
    each whole chunk what ``last`` makes of it, of type ``sent``. Chunks without parts are 0."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("data").to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(data), dtype=dtype)
                total[chunk] = merge(total[chunk], part) if chunk in total else part
        yield _chunks({chunk: last(x).astype(sent) for chunk, x in total.items()})

    whole = np.zeros((size // _CHUNK, _CHUNK), dtype=sent)
    merged = parts.repartition("chunk").mapInArrow(add, _PARTS)
    for row in merged.collect():  # `size` numbers, whatever the data
        whole[row["chunk"]] = np.frombuffer(zlib.decompress(row["data"]), dtype=sent)
    return whole.ravel()


_PARTS = "chunk int, data binary"


def _chunks(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    packed = [zlib.compress(x.tobytes(), 1) for x in parts.values()]
    return pa.RecordBatch.from_pydict({"chunk": pa.array(parts.keys(), pa.int32()), "data": pa.array(packed, pa.binary())})


def _rank(counts: np.ndarray) -> np.ndarray:
    return np.minimum(65535, np.log2(counts + 1.0) * 1500)


def frequency_ranks(documents: DataFrame, words: int) -> np.ndarray:
    """Ranks by how many documents hold a shingle, summed over those that share a counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident.release()
        total = np.zeros(SKETCH, dtype=np.int32)  # documents of one task
        for batch in slices(batches, "text", _SLICE_BYTES):
            _, value = shingles(Texts(batch.column("text")), words)
            counter, times = np.unique(value & U64(SKETCH - 1), return_counts=True)
            total[counter.astype(np.int64)] += times.astype(np.int32)
        for low in range(0, SKETCH, 64 * _CHUNK):
            parts = total[low : low + 64 * _CHUNK].reshape(-1, _CHUNK)
            yield _chunks({low // _CHUNK + k: x.astype("<i8") for k, x in enumerate(parts) if x.any()})

    return _merged(documents.select("text").mapInArrow(count, _PARTS), SKETCH, "<i8", np.add, _rank, "<u2")


def _id_filter(ids: DataFrame, name: str) -> np.ndarray:
    """A bit array with a bit for the hash of each id in the column ``name``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER, dtype=bool)
        for batch in batches:
            bits[batch.column("slot").to_numpy()] = True
        yield _chunks({k: x for k, x in enumerate(np.packbits(bits).reshape(-1, _CHUNK)) if x.any()})

    slots = ids.select(_slot(F.col(name)).alias("slot"))
    return _merged(slots.mapInArrow(mark, _PARTS), FILTER // 8, "u1", np.bitwise_or, np.asarray, "u1")


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER)).cast("int")


def _told_apart(rows: DataFrame, name: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose id in the column ``name`` may be among ``ids``, and those whose id is not.

    Only the first need a join to tell, so where ``ids`` are few, few rows go to a shuffle. Rows
    without an id are left out.
    """
    bits = rows.sparkSession.sparkContext.broadcast(Packed(_id_filter(ids, name)))
    slotted = rows.where(F.col(name).isNotNull()).withColumn("slot", _slot(F.col(name)))
    columns = rows.columns

    def part(value: int) -> DataFrame:
        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                slot = batch.column("slot").to_numpy()
                yield batch.filter(pa.array((bits.value.values[slot >> 3] >> (7 - (slot & 7))) & 1 == value)).select(columns)

        return slotted.mapInArrow(chosen, rows.schema)

    return part(1), part(0)


def shingle_order(documents: DataFrame, words: int) -> Broadcast:
    """Ranks by counter of the sketch, rare before frequent; shingles of one rank go by hash.

    16 bits for each counter, sortable in linear time.
    """
    return documents.sparkSession.sparkContext.broadcast(Packed(frequency_ranks(documents, words)))


def signatures(documents: DataFrame, shared: Broadcast, words: int, percent: int) -> DataFrame:
    """Per document: ``doc_id``, ``n`` shingles, the set's fingerprint ``id``, ``id2``, and its
    prefix in the order of the sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident.release()
        ranks = shared.value.values
        for batch in slices(batches, "text", _SLICE_BYTES):
            texts = Texts(batch.column("text"))
            rows, value = shingles(texts, words)
            bounds = _bounds(rows, len(texts))
            first, second = _fingerprints(value, bounds)
            sizes = np.diff(bounds)
            order = np.argsort(ranks[(value & U64(SKETCH - 1)).astype(np.int64)], kind="stable")
            order = order[np.argsort(rows[order].astype(np.uint16), kind="stable")]
            length = np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1, 0)
            place = np.arange(len(rows)) - bounds[rows]
            prefix = value[order][place < length[rows]]
            ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(sizes, pa.int64()),
                    "id": pa.array(first, pa.int64()),
                    "id2": pa.array(second, pa.int64()),
                    "prefix": pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix.view(np.int64))),
                }
            )

    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(sign, "doc_id long, n long, id long, id2 long, prefix array<long>")


def _may_link(n_x: Column, n_y: Column, percent: int) -> Column:
    return (100 * F.least(n_x, n_y)) >= (percent * F.greatest(n_x, n_y))


def _positions_allow(n_x: Column, i: Column, n_y: Column, j: Column, percent: int) -> Column:
    """Whether enough shingles follow the first common one, at places ``i`` and ``j``."""
    most = 1 + F.least(n_x - i - 1, n_y - j - 1)
    return (100 + percent) * most >= percent * (n_x + n_y)


def plausible(pairs: DataFrame, classes: DataFrame, shared: Broadcast, percent: int) -> DataFrame:
    """Those of the class pairs (``a``, ``b``) that their prefixes alone do not rule out.

    A shingle of one prefix that comes before the last of the other, without being in it, is
    not in the other set at all. Too many of these leave too little in common. Prefixes of
    classes in no pair are left out first: most classes are in none.
    """
    folder = workspace.scratch(classes.sparkSession, "jaccard-pairs")
    pairs.write.parquet(folder)
    pairs = classes.sparkSession.read.parquet(folder)
    paired = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    possible, _ = _told_apart(classes.select("id", "n", "prefix"), "id", paired)
    # A shuffle behind each Python step: run in one stage, a task would hold two workers.
    side = possible.join(paired.distinct().hint("merge"), "id", "left_semi")
    one = side.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("prefix").alias("p_a"))
    two = side.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("prefix").alias("p_b"))
    both = pairs.join(one, "a").join(two, "b")

    def missing(x: np.ndarray, y: np.ndarray, ranks: np.ndarray) -> int:
        rank = ranks[(x & U64(SKETCH - 1)).astype(np.int64)]
        last = ranks[int(y[-1] & U64(SKETCH - 1))]
        before = (rank < last) | ((rank == last) & (x <= y[-1]))
        return int((before & ~np.isin(x, y)).sum())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value.values
        for batch in batches:
            sides = []
            for column in ("p_a", "p_b"):
                lists = batch.column(column)
                sides.append((lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)))
            sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            common = -(-percent * (sizes[0] + sizes[1]) // (100 + percent))
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k in range(batch.num_rows):
                x, y = (values[bounds[k] : bounds[k + 1]] for bounds, values in sides)
                keep[k] = (
                    missing(x, y, ranks) <= sizes[0][k] - common[k] and missing(y, x, ranks) <= sizes[1][k] - common[k]
                )
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "n_a", "p_a", "b", "n_b", "p_b").mapInArrow(judge, "a long, b long")


def verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the class pairs (``a``, ``b``) that link.

    The pairs of one ``a`` form blocks of bounded size. The set of ``a`` goes once to each of
    its blocks and that of ``b`` once per pair; sets are made anew from the texts.
    """
    spark = documents.sparkSession
    sized = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("_blocks"))
    leaders = sized.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"), F.col("a").alias("id"), F.lit(0).alias("_role")
    )
    members = pairs.join(sized, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("_blocks")).cast("int").alias("_block"), F.col("b").alias("id"), F.lit(1).alias("_role")
    )
    folder = workspace.scratch(spark, "jaccard-wanted")
    leaders.unionByName(members).join(classes.select("id", "id2", "rep"), "id").write.parquet(folder)
    wanted = spark.read.parquet(folder)
    slim = documents.select(F.col("doc_id").cast("long").alias("rep"), "text")
    possible, _ = _told_apart(slim, "rep", wanted)
    # A shuffle between the two Python steps: run in one stage, a task would hold two workers.
    texts = possible.join(wanted.hint("merge"), "rep")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident.release()
        for batch in slices(batches, "text", _SLICE_BYTES):
            texts = Texts(batch.column("text"))
            rows, value = shingles(texts, words)
            bounds = _bounds(rows, len(texts))
            first, second = _fingerprints(value, bounds)
            # An id may be repeated with other texts.
            right = (batch.column("id").to_numpy() == first) & (batch.column("id2").to_numpy() == second)
            made = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("a", "_block", "_role", "id")] + [made], names=["a", "_block", "_role", "id", "set"]
            ).filter(pa.array(right))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("a", "_block", "_role", "id")), strict=True)
            bounds = batch.column("set").offsets.to_numpy()
            values = batch.column("set").values.to_numpy().view(np.uint64)
            found_a, found_b = [], []
            for k, (a, block, role, id_) in enumerate(keys):
                value = values[bounds[k] : bounds[k + 1]]
                if role == 0:
                    leader, own = (a, block), value.copy()
                elif leader == (a, block):
                    at = np.minimum(np.searchsorted(own, value), len(own) - 1)
                    common = int((own[at] == value).sum())
                    if 100 * common >= percent * (len(own) + len(value) - common):
                        found_a.append(a)
                        found_b.append(id_)
            yield pa.RecordBatch.from_pydict({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    made = texts.mapInArrow(sets, "a long, _block int, _role int, id long, set array<long>")
    dealt = made.repartition("a", "_block").sortWithinPartitions("a", "_block", "_role")
    folder = workspace.scratch(spark, "jaccard-links")
    dealt.mapInArrow(compare, "a long, b long").distinct().write.parquet(folder)
    return spark.read.parquet(folder)


def _band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(_BAND))


def _lists(groups: DataFrame, percent: int) -> DataFrame:
    """Posting lists by shingle and band of sizes, as the sets that come to one to meet sets of at
    most their own size there.

    A row has ``token``, ``band``, ``g``, ``n``, the shingle's place ``pos``, whether the set is
    ``listed`` there itself, and the list's leader ``lead``. Lists that join nothing are left out.
    All of it happens behind one shuffle by shingle, in which rows are streamed list by list.
    """
    n, pos, band = F.col("n"), F.col("pos"), F.col("band")
    postings = groups.select("g", "n", F.posexplode("prefix").alias("pos", "token"))
    sharing = F.count(F.lit(1)).over(Window.partitionBy("token"))
    shared = postings.withColumn("_groups", sharing).where(F.col("_groups") > 1)
    # Sizes between which a partner has to be: similar enough, and with enough shingles left.
    low = F.ceil(n * percent / 100)
    high = F.least(n, F.floor((n - pos) * (100 + percent) / percent) - n)
    coming = shared.where(low <= high).select(
        "token", "g", "n", "pos", F.explode(F.sequence(_band(low), _band(high))).alias("band")
    )
    # A set that is listed comes to its own list; a list to which only one comes joins nothing.
    listed = ((100 + percent) * (n - pos) >= 2 * percent * n) & (band == _band(n))
    in_list = Window.partitionBy("token", "band")
    met = coming.withColumn("listed", listed).select(
        "*",
        F.count(F.lit(1)).over(in_list).alias("_coming"),
        F.min(F.when(F.col("listed"), F.struct("pos", "n", "g"))).over(in_list).alias("lead"),
    )
    return met.where((F.col("_coming") > 1) & F.col("lead").isNotNull()).drop("_coming")


def _star_pairs(coming: DataFrame, percent: int) -> DataFrame:
    """Each group with the leader of every list it comes to."""
    met = coming.where(F.col("g") != F.col("lead.g"))
    first = met.groupBy(F.col("lead.g").alias("a"), F.col("g").alias("b")).agg(
        F.first("lead.n").alias("n_a"), F.first("n").alias("n_b"), F.min("lead.pos").alias("i"), F.min("pos").alias("j")
    )
    return first.where(
        _may_link(F.col("n_a"), F.col("n_b"), percent)
        & _positions_allow(F.col("n_a"), F.col("i"), F.col("n_b"), F.col("j"), percent)
    ).select("a", "b")


def _open_pairs(
    coming: DataFrame, members: DataFrame, roots: DataFrame, percent: int, written: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """Class pairs that meet in a list, or in a group, and are not connected yet.

    The steps go through ``written`` tables. One query for all of them had some forty stages,
    whose threads, tasks and plans the driver held at the same time.
    """
    rooted = members.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select(
        "id", "g", F.coalesce("root", "id").alias("root")
    )
    rooted = written(rooted, "rooted")
    inside = written(rooted.select("g", "root").distinct(), "inside")
    place = ["token", "band"]
    # Only lists in which several components meet are opened at all.
    many = coming.select(*place, "g").join(inside, "g")
    many = many.groupBy(*place).agg(F.min("root").alias("_x"), F.max("root").alias("_y"))
    many = written(many.where(F.col("_x") != F.col("_y")).select(*place), "many")
    opened = coming.join(many, place).join(inside, "g").select(*place, "root", "g", "n", "pos", "listed")
    opened = written(opened, "opened")

    def side(postings: DataFrame, root: str, g: str, n: str, pos: str) -> DataFrame:
        return postings.select(
            *place, F.col("root").alias(root), F.col("g").alias(g), F.col("n").alias(n), F.col("pos").alias(pos)
        )

    x, y = side(opened.where("listed"), "rx", "a", "n_a", "i"), side(opened, "ry", "b", "n_b", "j")
    meeting = x.select(*place, "rx").distinct().join(y.select(*place, "ry").distinct(), place).where("rx != ry")
    both_sizes = percent * (F.col("n_a") + F.col("n_b"))
    met = (
        meeting.join(x, [*place, "rx"])
        .join(y, [*place, "ry"])
        .where(
            (F.col("n_a") <= F.col("n_b"))
            & _may_link(F.col("n_a"), F.col("n_b"), percent)
            & ((100 + percent) * (F.col("n_a") - F.col("i")) >= both_sizes)
            & ((100 + percent) * (F.col("n_b") - F.col("j")) >= both_sizes)
        )
        .select("rx", "ry", "a", "b")
        .distinct()
    )
    met = written(met, "met")
    one = rooted.select(F.col("g").alias("a"), F.col("root").alias("rx"), F.col("id").alias("id_a"))
    two = rooted.select(F.col("g").alias("b"), F.col("root").alias("ry"), F.col("id").alias("id_b"))
    apart = met.join(one, ["a", "rx"]).join(two, ["b", "ry"]).select("id_a", "id_b")
    # Members of one group that did not join up.
    split = inside.groupBy("g").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("g")
    grouped = rooted.join(split, "g")
    within = grouped.select("g", "root", F.col("id").alias("id_a")).join(
        grouped.select("g", F.col("root").alias("other"), F.col("id").alias("id_b")), "g"
    )
    within = within.where(F.col("root") < F.col("other")).select("id_a", "id_b")
    pairs = apart.unionByName(within)
    return pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def joined(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``component_id``."""
    spark = documents.sparkSession
    with small_batches(spark), session.passing_shuffles(spark):
        return _joined(documents, words, percent)


def _joined(documents: DataFrame, words: int, percent: int) -> DataFrame:
    spark = documents.sparkSession

    folders: dict[str, str] = {}

    def written(df: DataFrame, label: str, instead_of: str | None = None) -> DataFrame:
        folders[label] = workspace.scratch(spark, f"jaccard-{label}")
        df.write.parquet(folders[label])
        if instead_of:
            workspace.discard(spark, folders.pop(instead_of))
        return spark.read.parquet(folders[label])

    order = shingle_order(documents, words)
    signed = written(signatures(documents, order, words, percent), "signatures")
    # Equal sets: one class, represented by its smallest id. Copies are pre-aggregated.
    classes = written(
        signed.where(F.col("n") > 0)
        .groupBy("id", "id2", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix")),
        "classes",
    )
    # The prefixes go on with the classes; of the documents only this is read again.
    signed = written(signed.select("doc_id", "n", "id", "id2"), "sets", instead_of="signatures")
    usable = classes.where(F.col("rep").isNotNull())
    # Equal size and prefix: one group, named after its smallest class.
    slim = usable.select("id", "n", F.xxhash64("prefix").alias("_prefix"))
    named = slim.groupBy("n", "_prefix").agg(F.min("id").alias("g"))
    members = written(slim.join(named, ["n", "_prefix"]).select("id", "g"), "members")
    others = members.where(F.col("id") != F.col("g")).select("id")
    doubtful, leaders = _told_apart(usable.select("id", "n", "prefix"), "id", others)
    groups = leaders.unionByName(doubtful.join(others.hint("merge"), "id", "left_anti")).withColumnRenamed("id", "g")
    coming = written(_lists(groups, percent), "coming")
    alike = members.where(F.col("id") != F.col("g")).select(F.col("g").alias("a"), F.col("id").alias("b"))
    stars = _star_pairs(coming, percent)
    expanded = stars.join(members.select(F.col("g").alias("b"), "id"), "b").select("a", F.col("id").alias("b"))
    first_pairs = plausible(alike.unionByName(expanded).distinct(), usable, order, percent)
    first_pairs = written(first_pairs, "stars")
    links = verified(first_pairs, classes, documents, words, percent)
    roots = connected(links)
    open_pairs = plausible(_open_pairs(coming, members, roots, percent, written), usable, order, percent)
    for label in ("rooted", "inside", "many", "opened", "met"):  # the pairs are written by then
        workspace.discard(spark, folders.pop(label))
    open_pairs = written(open_pairs, "open", instead_of="coming")
    classes = written(classes.select("id", "id2", "n", "rep"), "named", instead_of="classes")
    more = verified(open_pairs, classes, documents, words, percent)
    links = links.unionByName(more)
    roots = connected(links) if not more.isEmpty() else roots

    named = classes.join(roots, classes["id"] == roots["node"], "left").select(
        "id", "id2", "n", "rep", F.coalesce("root", "id").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    found = named.join(smallest, "root").select("id", "id2", "n", "component_id")
    full = signed.where(F.col("n") > 0).join(found, ["id", "id2", "n"])
    alone = signed.where(F.col("n") == 0).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return full.select(*columns).unionByName(alone.select(*columns))


def one_of_each(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest id; the others go.

    Documents without words are nobody's copies and stay, as do those without an id. Of
    equal rows with one id a single one stays; where an id has several texts, all of them
    stay unless each is a copy of another document.
    """
    documents, columns = plainly_named(documents, ("doc_id", "text"))
    found = joined(documents, words, percent).where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    by_id = found.groupBy("doc_id").agg(
        F.min(F.col("doc_id") != F.col("component_id")).alias("_spare"), F.count(F.lit(1)).alias("_rows")
    )
    odd = by_id.where(F.col("_spare") | (F.col("_rows") > 1)).withColumnRenamed("doc_id", "_id")
    folder = workspace.scratch(documents.sparkSession, "jaccard-odd")
    odd.write.parquet(folder)
    odd = documents.sparkSession.read.parquet(folder)
    same = documents["doc_id"] == odd["_id"]
    kept = documents.join(odd, same, "left_anti")
    repeated = odd.where(~F.col("_spare"))
    if repeated.isEmpty():
        return kept.select(*columns)
    again = documents.join(repeated, documents["doc_id"] == repeated["_id"], "left_semi")
    return kept.unionByName(again.dropDuplicates(["doc_id", "text"])).select(*columns)
