"""Connected components by alternating large and small stars.

Every star is a few shuffles over the links; the table of links is written to the shared
folder behind each, so a lost executor costs at most a star, no star is worked out twice and
the driver has few stages to hold at once. Minima are pre-aggregated, and the joins that
bring them back are split where one node has most of the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom import workspace

_MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, and that to a node without links of its own."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in"))
    ends = ends.unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return nodes.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0))).isEmpty()


def connected(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component as ``root``, for every node of ``links``
    (columns ``a``, ``b``) that is not its own root."""
    spark, folders = links.sparkSession, []

    def written(df: DataFrame) -> DataFrame:
        folders.append(workspace.scratch(spark, "components"))
        df.write.parquet(folders[-1])
        for read in folders[:-1]:
            workspace.discard(spark, read)
        folders[:] = folders[-1:]
        return spark.read.parquet(folders[-1])

    links = written(links.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    for _ in range(_MOST_ROUNDS):
        links = written(_large_star(links))
        links = written(_small_star(links).distinct())
        if _settled(links):
            break
    else:
        raise RuntimeError(f"components did not settle in {_MOST_ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
