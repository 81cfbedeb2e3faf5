"""Near-duplicate embeddings by an exact metric range join.

Vectors of one label that are equal count as one with a weight. Pivots, drawn from a
bounded sample of the large labels, part a label into cells by the nearest pivot; on the
unit sphere a cosine threshold is a distance ``r``. A vector has to be compared with a
foreign cell only if the triangle inequality allows a partner there: its distance to that
cell's pivot is at most the cell's radius plus ``r``, and at most its distance to its own
pivot plus ``2 r``. Cells are cut into blocks of bounded size that join independently: the
block's vectors are held, visitors from later blocks stream past.

A block returns sums of link weights and a spanning forest of its links, never all pairs,
so a large group of near copies costs rows in proportion to its members.

Defined results: a vector that is null, zero, or has null or non-finite components, or
whose label or id is null, links with nothing and is its own component; repeated rows are
vectors of their own; vectors of different lengths never link; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom import workspace
from starloom.llm.components import connected

THRESHOLD = 0.93
BLOCK = 2048
#: Pivots of all labels together: the bound of what is broadcast.
PIVOTS = 4096

_ROWS = "vec_id long, label long, dim int, weight long, embedding array<float>"


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of double precision."""
    width = len(column.values) and int(column.offsets[1].as_py() - column.offsets[0].as_py())
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _distances(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * unit @ pivots.T))


def _pivots(classes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Pivots of the labels that fill more than a block; at most about ``PIVOTS`` in all."""
    counts = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = max(BLOCK, math.ceil(total / PIVOTS))
    # Each of these labels has more than 1 / PIVOTS of all vectors.
    large = counts.where(F.col("n") > share).withColumn("_cells", F.ceil(F.col("n") / share).cast("int"))
    spread = F.xxhash64("vec_id")
    drawn = (
        classes.join(large, ["label", "dim"])
        .withColumn("_slot", F.pmod(spread, F.col("_cells")))
        .groupBy("label", "dim", "_slot")
        .agg(F.min(F.struct(spread.alias("h"), "embedding")).alias("p"))
    )
    found: dict[tuple[int, int], list] = {}
    for row in drawn.select("label", "dim", "_slot", "p.embedding").orderBy("label", "dim", "_slot").collect():
        found.setdefault((row["label"], row["dim"]), []).append(row["embedding"])
    return {key: _unit(np.array(rows, dtype=np.float64)) for key, rows in found.items()}


def _by_space(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
    """Rows of a batch by label and length, with their unit vectors."""
    labels, dims = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
    for label, dim in sorted(set(zip(labels.tolist(), dims.tolist(), strict=True))):
        rows = np.flatnonzero((labels == label) & (dims == dim))
        yield (label, dim), rows, _unit(_matrix(batch.column("embedding").take(pa.array(rows))))


def _with_cells(classes: DataFrame, pivots: dict) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, reach = np.zeros(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows)
            for key, rows, unit in _by_space(batch):
                if key in shared.value:
                    distance = _distances(unit, shared.value[key])
                    cell[rows] = distance.argmin(axis=1)
                    reach[rows] = distance.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(reach)], names=[*batch.schema.names, "cell", "reach"]
            )

    return classes.mapInArrow(assign, f"{_ROWS}, cell int, reach double")


def _with_visits(homes: DataFrame, pivots: dict, radius: float) -> DataFrame:
    """Add ``visits``: the earlier cells in which a partner may be."""
    stats = homes.groupBy("label", "dim", "cell").agg(F.max("reach").alias("reach")).where(F.col("reach") > 0)
    radii = {key: np.full(len(p), -np.inf) for key, p in pivots.items()}
    for row in stats.collect():  # cells with a pivot of their own: bounded like the pivots
        if (row["label"], row["dim"]) in radii:
            radii[row["label"], row["dim"]][row["cell"]] = row["reach"]
    for values in radii.values():
        values[np.isneginf(values)] = 0.0
    shared = homes.sparkSession.sparkContext.broadcast((pivots, radii))
    slack = 1e-9

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, radii = shared.value
        for batch in batches:
            visits: list[list[int]] = [[] for _ in range(batch.num_rows)]
            cells, reach = batch.column("cell").to_numpy(), batch.column("reach").to_numpy()
            for key, rows, unit in _by_space(batch):
                if key not in pivots:
                    continue
                distance = _distances(unit, pivots[key])
                near = distance <= np.minimum(radii[key][None, :] + radius, reach[rows][:, None] + 2 * radius) + slack
                near &= np.arange(distance.shape[1])[None, :] < cells[rows][:, None]
                for k, row in enumerate(rows.tolist()):
                    visits[row] = np.flatnonzero(near[k]).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(visits, pa.list_(pa.int32()))], names=[*batch.schema.names, "visits"]
            )

    return homes.mapInArrow(visit, f"{_ROWS}, cell int, reach double, visits array<int>")


def _roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index connected with each of ``count`` items."""
    root = np.arange(count)
    while True:
        before = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        root = root[root]
        if np.array_equal(root, before):
            return root


class _Block:
    """The vectors at home in a block; compares them with one another and with visitors."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], threshold: float):
        self.ids = np.concatenate([p[0] for p in parts])
        self.weights = np.concatenate([p[1] for p in parts])
        self.matrix = np.concatenate([p[2] for p in parts])
        self.norms = np.linalg.norm(self.matrix, axis=1)
        self.threshold = threshold
        self.links = np.zeros(len(self.ids), dtype=np.int64)
        left, right = [], []
        for at in range(0, len(self.ids), 512):
            near = self._near(self.matrix[at : at + 512], self.norms[at : at + 512])
            near[np.arange(near.shape[0]), at + np.arange(near.shape[0])] = False
            self.links[at : at + 512] += near @ self.weights
            i, j = np.nonzero(near)
            left.append(i + at)
            right.append(j)
        self.roots = _roots(len(self.ids), np.concatenate(left), np.concatenate(right))

    def _near(self, matrix: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return (matrix @ self.matrix.T) / (norms[:, None] * self.norms[None, :]) >= self.threshold

    def visit(self, ids: np.ndarray, weights: np.ndarray, matrix: np.ndarray) -> list[tuple]:
        found = []
        for at in range(0, len(ids), 512):
            part = matrix[at : at + 512]
            near = self._near(part, np.linalg.norm(part, axis=1))
            self.links += weights[at : at + 512] @ near
            counts = near @ self.weights
            for k in np.flatnonzero(counts):
                roots = np.unique(self.roots[np.flatnonzero(near[k])])
                found.append((int(ids[at + k]), int(counts[k]), [int(x) for x in self.ids[roots]]))
        return found

    def close(self) -> list[tuple]:
        return [
            (int(i), int(n), [int(self.ids[r])] if r != k else [])
            for k, (i, n, r) in enumerate(zip(self.ids, self.links, self.roots, strict=True))
            if n
        ]


def _block_links(placed: DataFrame, threshold: float) -> DataFrame:
    """``vec_id``, ``links`` (a part of its sum) and ``to`` (links enough to connect it)."""

    def result(rows: list[tuple]) -> pa.RecordBatch:
        ids, links, to = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_pydict(
            {"vec_id": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()), "to": pa.array(to, pa.list_(pa.int64()))}
        )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, gathered, block = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("label", "dim", "cell", "sub", "role")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if low == high:
                    continue
                here, role = tuple(keys[:4, low].tolist()), int(keys[4, low])
                if here != key:
                    block = _Block(gathered, threshold) if gathered else block
                    if block is not None:
                        yield result(block.close())
                    key, gathered, block = here, [], None
                part = batch.slice(low, high - low)
                values = (part.column("vec_id").to_numpy(), part.column("weight").to_numpy(), _matrix(part.column("embedding")))
                if role == 0:
                    gathered.append(values)
                    continue
                if gathered:
                    block, gathered = _Block(gathered, threshold), []
                if block is not None:
                    yield result(block.visit(*values))
        block = _Block(gathered, threshold) if gathered else block
        if block is not None:
            yield result(block.close())

    order = ["label", "dim", "cell", "sub"]
    dealt = placed.repartition(*order).sortWithinPartitions(*order, "role")
    return dealt.mapInArrow(join, "vec_id long, links long, to array<long>")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    spark = vectors.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        folder = workspace.scratch(spark, f"embeddings-{label}")
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    slim = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    )
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _valid(F.col("embedding"))
    valid = slim.where(usable)
    classes = written(
        valid.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight"))
        .select("vec_id", "label", F.size("embedding").alias("dim"), "weight", "embedding"),
        "classes",
    )
    radius = math.sqrt(2 - 2 * threshold)
    pivots = _pivots(classes)
    homes = written(_with_cells(classes, pivots), "homes")
    space = ["label", "dim", "cell"]
    blocks = homes.groupBy(*space).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    blocks = written(blocks, "blocks")
    # No block holds much more than BLOCK vectors: the hash spreads a cell evenly.
    settled = (
        _with_visits(homes, pivots, radius)
        .join(blocks, space)
        .withColumn("sub", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    )
    columns = ["vec_id", "label", "dim", "weight", "embedding", "cell", "sub"]
    home_rows = settled.select(*columns, F.lit(0).alias("role"))
    earlier_blocks = settled.where(F.col("sub") > 0).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("sub") - 1)))
    abroad = (
        settled.select("vec_id", "label", "dim", "weight", "embedding", F.explode("visits").alias("cell"))
        .join(blocks, space)
        .withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    placed = home_rows.unionByName(earlier_blocks.select(*columns, F.lit(1).alias("role"))).unionByName(
        abroad.select(*columns, F.lit(1).alias("role"))
    )
    found = written(_block_links(placed, threshold), "links")
    sums = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("vec_id").alias("a"), F.explode("to").alias("b")))
    named = (
        classes.join(sums, "vec_id", "left")
        .join(roots, classes["vec_id"] == roots["node"], "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "vec_id").alias("component_id"),
        )
    )
    linked = valid.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = slim.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
