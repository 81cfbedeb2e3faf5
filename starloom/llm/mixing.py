"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled, laid end to end and cut into blocks of equal word
count. Slot ``i`` of the schedule gets the point ``i`` of the van der Corput sequence; the
cumulative block demands of the sources map it to a source, and its rank among that
source's slots names the block, so every stretch of the schedule is mixed in proportion.
A source whose blocks are used up starts again with the first.

Targets: the sources by code point, null last, weigh 5, 2, 1, repeating, and share the sum
of all sizes; a target stops at three times its source's size and the excess is shared
again by weight. The last slot of a source ends at its target, so each source gives its
target in whole words and no document more than three times its size.

Defined results: a null text has size 0 and is taken 0 times; a null source is a source of
its own; rows that repeat an id are documents of their own, and since rows alike in id,
source and size are interchangeable the result is the same on every run; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom import workspace
from starloom.llm.texts import plainly_named

WORD = r"[^\x20\x09-\x0D]+"
# Fixed by the contract: weights by rank of the source, and the most a source may repeat.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3

BLOCK_WORDS = 1024
_POINT_BITS = 48
_CHUNK = 1 << 14


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column) -> Column:
    """A fixed pseudo-random order of documents; SQL engines agree on MD5."""
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def sized(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: its number, size, target and how many whole words to take.

    Sources are few against documents; the windows below run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    weighed = sources.select("source", "source_size", place.alias("source_no"), weight.alias("weight"))

    # Water-filling: in the order in which sources reach their cap, a source is capped if
    # the words left for it and all after it, shared by weight, would exceed the cap.
    cap = F.lit(MOST_REPEATS) * F.col("source_size")
    fill = Window.orderBy(cap.cast("double") / F.col("weight"), "source_no")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    filled = weighed.select(
        "*",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))).alias("_left"),
        F.sum("weight").over(onward).alias("_weights"),
    )
    capped = cap.cast("double") / F.col("weight") <= F.col("_left").cast("double") / F.col("_weights")
    # The first source that is not capped sets the words per weight for all the rest.
    level = F.min(F.when(~capped, F.struct(F.col("_weights") * -1, "_left", F.col("_weights").alias("_w")))).over(whole)
    target = F.when(capped, cap.cast("double")).otherwise(
        level["_left"].cast("double") * F.col("weight") / level["_w"]
    )
    return filled.select(
        "source", "source_no", "source_size", target.alias("target"), F.floor(target + F.lit(1e-6)).alias("take")
    )


def shuffled(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Every document with words and its place in its source's shuffled run of words.

    Running sums are taken inside slices of the shuffle order and then over the slices,
    so no window holds more than a slice of a source, however hot the source.
    """
    keyed = sizes.where(F.col("size") > 0).withColumn("_key", shuffle_key(F.col("doc_id")))
    numbered = keyed.withColumn("_slice", F.substring("_key", 1, 3)).join(
        targets, keyed["source"].eqNullSafe(targets["source"])
    ).drop(targets["source"])
    totals = numbered.groupBy("source_no", "_slice").agg(F.sum("size").alias("_size"))
    earlier = Window.partitionBy("source_no").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "source_no", "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    inside = (
        Window.partitionBy("source_no", "_slice")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        numbered.join(starts, ["source_no", "_slice"])
        .withColumn("start", F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .drop("_slice", "_start", "_key")
    )


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots in order: ``slot``, ``source_no``, ``pass``, ``block`` and the words
    ``[first, last)`` of the source's run that the slot takes."""
    spark = targets.sparkSession
    blocks = F.ceil(F.col("source_size") / block_words)
    rest = F.col("take") % F.col("source_size")
    passes = F.floor(F.col("take") / F.col("source_size"))
    demand = targets.where(F.col("take") > 0).select(
        "source_no",
        "source_size",
        blocks.alias("blocks"),
        rest.alias("rest"),
        passes.alias("passes"),
        (passes * blocks + F.ceil(rest / block_words)).alias("slots"),
    )
    counted = demand.agg(F.sum("slots").alias("slots"), F.count(F.lit(1)).alias("sources")).first()
    slots, sources = counted["slots"] or 0, counted["sources"]
    upto = Window.orderBy("source_no")
    edge = F.sum("slots").over(upto)
    scale = F.lit(float(1 << _POINT_BITS) / max(1, slots))
    bounds = demand.select(
        "*",
        F.floor((edge - F.col("slots")) * scale).alias("_low"),
        F.when(edge == slots, F.lit(1 << _POINT_BITS)).otherwise(F.floor(edge * scale)).alias("_high"),
    )
    # Sources and points meet in cells of a grid about as fine as the sources are many:
    # every cell gets as many points as any other, whatever the weights.
    shift = _POINT_BITS - max(1, sources).bit_length()
    cells = bounds.where(F.col("_low") < F.col("_high")).withColumn(
        "_cell", F.explode(F.sequence(F.shiftright("_low", shift), F.shiftright(F.col("_high") - 1, shift)))
    )
    point = F.conv(F.reverse(F.lpad(F.bin("id"), _POINT_BITS, "0")), 2, 10).cast("long")
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("_point"))
    drawn = (
        points.withColumn("_cell", F.shiftright("_point", shift))
        .join(cells, "_cell")
        .where((F.col("_point") >= F.col("_low")) & (F.col("_point") < F.col("_high")))
        .select("slot", "source_no")
        .withColumn("_chunk", F.floor(F.col("slot") / _CHUNK))
    )
    # Ranks per source: counts of the chunks before, then places inside the chunk.
    counts = drawn.groupBy("source_no", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("source_no").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source_no", "_chunk", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("source_no", "_chunk").orderBy("slot")) - 1
    ranked = drawn.join(offsets, ["source_no", "_chunk"]).select(
        "slot", "source_no", (F.col("_before") + place).alias("rank")
    )
    # The sequence meets each demand up to a few slots: surplus slots stay empty, and what
    # is missing follows after the last slot.
    reached = counts.groupBy("source_no").agg(F.sum("_n").alias("_reached"))
    missing = (
        demand.join(reached, "source_no", "left")
        .withColumn("_reached", F.coalesce("_reached", F.lit(0)))
        .where(F.col("_reached") < F.col("slots"))
        .select("source_no", F.explode(F.sequence("_reached", F.col("slots") - 1)).alias("rank"))
        .select((F.lit(slots) + F.col("rank")).alias("slot"), "source_no", "rank")
    )
    first = F.col("block") * block_words
    ends = F.least(first + block_words, F.col("source_size"))
    return (
        ranked.unionByName(missing)
        .join(demand, "source_no")
        .where(F.col("rank") < F.col("slots"))
        .withColumn("pass", F.floor(F.col("rank") / F.col("blocks")))
        .withColumn("block", F.col("rank") % F.col("blocks"))
        .withColumn("first", first)
        .withColumn("last", F.when(F.col("pass") == F.col("passes"), F.least(ends, F.col("rest"))).otherwise(ends))
        .select("slot", "source_no", "pass", "block", "first", "last")
    )


def mixed(documents: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` words."""
    return _taken(documents, block_words).drop("source")


def _taken(documents: DataFrame, block_words: int) -> DataFrame:
    """The rows of ``mixed`` with their ``source``."""
    spark = documents.sparkSession
    folder = workspace.scratch(spark, "mix-sizes")
    # The texts are read once; everything after works on these few bytes a document.
    sized(documents).write.parquet(folder)
    sizes = spark.read.parquet(folder)
    target_folder = workspace.scratch(spark, "mix-targets")
    source_targets(sizes).write.parquet(target_folder)
    targets = spark.read.parquet(target_folder)

    uses = schedule(targets, block_words).groupBy("source_no", "block").agg(
        F.collect_list(F.struct("first", "last")).alias("uses")  # at most one per pass, so three
    )
    # The schedule and the run of words are worked out one after the other, so that the driver
    # does not hold the stages of both.
    uses_folder = workspace.scratch(spark, "mix-uses")
    uses.write.parquet(uses_folder)
    uses = spark.read.parquet(uses_folder)
    run = shuffled(sizes, targets)
    end = F.col("start") + F.col("size")
    pieces = run.withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))),
    )
    overlap = F.aggregate(
        "uses",
        F.lit(0).cast("long"),
        lambda total, use: total
        + F.greatest(F.lit(0), F.least(use["last"], end) - F.greatest(use["first"], F.col("start"))),
    )
    # Within a source no two documents with words start at the same word.
    taken = (
        pieces.join(uses, ["source_no", "block"], "left")
        .groupBy("source_no", "start", "doc_id", "source", "size", "source_size", "target")
        .agg(F.sum(F.coalesce(overlap, F.lit(0))).cast("long").alias("taken"))
        .drop("source_no", "start")
    )
    empty = sizes.where(F.col("size") == 0)
    empty = empty.join(targets, empty["source"].eqNullSafe(targets["source"])).select(
        "doc_id", empty["source"], "size", "source_size", "target", F.lit(0).cast("long").alias("taken")
    )
    return taken.unionByName(empty)


def repeated(documents: DataFrame) -> DataFrame:
    """The mixture as documents: each as often as its taken words come to, to the nearest.

    Only the one document of a source at which its target ends is taken in part, so whole
    documents differ from the targets by half a document at most. Rows count one by one,
    whatever ids they share: those alike in id, source and size lie together in the shuffled
    run, so only where the target ends among them do they differ, by one copy.

    The texts stay where they are. Every pass begins with the first document of the run, so
    copies fall along it, at a few places a source; a document meets only those of its source.
    """
    documents, columns = plainly_named(documents, ("doc_id", "text", "source"))
    spark = documents.sparkSession
    copies = F.round(F.col("taken") / F.greatest(F.lit(1), F.col("size"))).cast("int")
    alike = (
        _taken(documents, BLOCK_WORDS)
        .select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), copies.alias("_n"))
        .groupBy("_id", "_source", "_size")
        .agg(F.min("_n").alias("_low"), F.max("_n").alias("_high"), F.sum("_n").alias("_all"), F.count("_n").alias("_rows"))
        .where(F.col("_high") > 0)
    )
    folder = workspace.scratch(spark, "mix-copies")
    alike.write.parquet(folder)
    alike = spark.read.parquet(folder)
    last = F.max(F.struct(shuffle_key(F.col("_id")).alias("key"), F.col("_id").alias("id"), F.col("_size").alias("size")))
    falls = alike.groupBy("_source", "_low", "_high").agg(last.alias("last"))
    split = F.col("_low") < F.col("_high")
    # The groups at which targets end, one a source at most, have their copies counted below.
    falls = falls.groupBy("_source").agg(
        F.collect_list(F.when(~split, F.struct(F.col("_low").alias("n"), "last"))).alias("_falls"),
        F.max(F.when(split, F.col("last"))).alias("_split"),
    )
    folder = workspace.scratch(spark, "mix-falls")
    falls.write.parquet(folder)
    falls = spark.read.parquet(folder)
    words = word_count(documents["text"])
    key = F.col("_key")

    def same(place: Column) -> Column:
        return (key == place["key"]) & F.col("doc_id").eqNullSafe(place["id"])

    def not_behind(place: Column) -> Column:
        before = F.struct(key.alias("key"), F.col("doc_id").alias("id")) < F.struct(place["key"], place["id"])
        # Words need counting only in documents that share a place's id.
        return F.when(same(place), words <= place["size"]).otherwise(before)

    met = documents.join(falls, documents["source"].eqNullSafe(F.col("_source"))).withColumn("_key", shuffle_key(F.col("doc_id")))
    most = F.aggregate("_falls", F.lit(0), lambda n, fall: F.when(not_behind(fall["last"]), F.greatest(n, fall["n"])).otherwise(n))
    at_split = F.when(F.col("_split").isNull(), False).when(same(F.col("_split")), words == F.col("_split.size")).otherwise(False)
    has_words = F.coalesce(documents["text"].rlike(WORD), F.lit(False))
    whole = met.where(has_words & ~at_split).withColumn("_n", most)
    same_row = documents["doc_id"].eqNullSafe(F.col("_id")) & documents["source"].eqNullSafe(F.col("_source"))
    # Sizes are compared by difference, as a filter behind the join.
    ends = documents.join(F.broadcast(alike.where(split)), same_row & (words - F.col("_size") == 0))
    place = F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy("text"))
    more = F.col("_all") - F.col("_low") * F.col("_rows")
    ends = ends.withColumn("_n", F.when(place <= more, F.col("_high")).otherwise(F.col("_low")))
    both = [*documents.columns, "_n"]
    return (
        whole.select(*both)
        .unionByName(ends.select(*both))
        .where(F.col("_n") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
        .select(*columns)
    )


SQL = r"""
WITH sizes AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT source, source_size, no,
         CASE no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM sources)),
filled AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS ratio,
         CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
           ORDER BY CAST(3 * source_size AS DOUBLE) / weight, no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS words_left,
         CAST(sum(weight) OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, no
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weights
  FROM weighed),
level AS (
  SELECT words_left, weights FROM filled WHERE NOT ratio <= CAST(words_left AS DOUBLE) / weights
  ORDER BY weights DESC LIMIT 1),
targets AS (
  SELECT f.source, f.no, f.source_size,
         CASE WHEN f.ratio <= CAST(f.words_left AS DOUBLE) / f.weights
              THEN CAST(3 * f.source_size AS DOUBLE)
              ELSE CAST(l.words_left AS DOUBLE) * f.weight / l.weights END AS target
  FROM filled f LEFT JOIN level l ON true),
runs AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CAST(floor(t.target + 1e-6) AS BIGINT) AS take,
         CAST(sum(s.size) OVER (PARTITION BY t.no
           ORDER BY md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id NULLS FIRST, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS BIGINT) AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0
            ELSE (take // source_size) * size
                 + greatest(0, least(size, take % source_size - start)) END AS taken
FROM runs
"""
