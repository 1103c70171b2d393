"""Embedding near-dedup: an exact range join in the metric of unit vectors.

Vectors of a cosine of ``cosine`` or more are at most ``r`` = sqrt(2 - 2 * cosine) apart once they have length 1. A bounded
sample of vectors serves as pivots and each vector lives in the cell of its nearest pivot. Another cell may hold partners of
``y`` only if all of these hold, by the triangle inequality, with ``d`` the distance to that cell's pivot and ``own`` the
distance to y's own: d - own <= 2r; d <= farthest member of the cell + r; and y is at most r away from the plane between the
two pivots. Such cells get a copy of ``y`` as a guest. Cells are joined independently: members in chunks of bounded size, all
guests of the cell streaming past each chunk as matrix products in double precision.

Equal vectors are one class from the start. Links are counted in full, but only a forest of them is handed on, which is
enough for the components. How far cells prune depends on the data: vectors spread evenly over many dimensions have all
cells as neighbours, and the join then compares all pairs, in blocks.

A vector that is null, zero or has a null or non-finite component links with nothing; so do vectors of different lengths.
An empty table gives no rows. Rows that share a vec_id are one node: they do not link with each other, and their links add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.graph import components
from llm.tables import stored

#: Members a cell should have on average; pivots at most; members of a chunk; guests that meet a chunk at once.
CELL, PIVOTS, CHUNK, MEET = 8192, 1024, 8192, 256
SLACK = 1e-9


def matrix(column: pa.Array) -> np.ndarray:
    """[row, component] in double precision of a list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    width = batch.column("width").to_numpy()
    for w in np.unique(width):
        yield batch.filter(pa.array(width == w))


def _homes(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_length(batch) if batch.num_rows else ():
                d = distances(unit(matrix(part.column("embedding"))), pivots[part.column("width")[0].as_py()])
                home = d.argmin(1)
                yield pa.record_batch([*part.columns, pa.array(home.astype(np.int32)), pa.array(d[np.arange(len(home)), home])], [*part.schema.names, "home", "apart"])

    return run


def _guests(pivots: dict[int, np.ndarray], radius: dict[int, np.ndarray], r: float):
    """A row for each cell that a vector lives in (kind 0) or may have partners in (kind 1; its own cell too)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_length(batch) if batch.num_rows else ():
                width = part.column("width")[0].as_py()
                p = pivots[width]
                d = distances(unit(matrix(part.column("embedding"))), p)
                home, own = part.column("home").to_numpy(), part.column("apart").to_numpy()[:, None]
                near = (d - own <= 2 * r + SLACK) & (d <= radius[width] + r + SLACK)
                near &= d**2 - own**2 <= 2 * (r + SLACK) * np.maximum(distances(p, p)[home], SLACK) + SLACK
                near[np.arange(len(home)), home] = True
                row, cell = np.nonzero(near)
                row, cell = np.concatenate([np.arange(len(home)), row]), np.concatenate([home, cell])
                kind = np.concatenate([np.zeros(len(home), np.int32), np.ones(len(row) - len(home), np.int32)])
                for at in range(0, len(row), 8192):
                    take = pa.array(row[at : at + 8192])
                    yield pa.record_batch(
                        [
                            part.column("width").take(take), pa.array(cell[at : at + 8192].astype(np.int32)), pa.array(kind[at : at + 8192]),
                            *(part.column(k).take(take) for k in ("rep", "copies", "embedding")),
                        ], ["width", "cell", "kind", "rep", "copies", "embedding"],
                    )

    return run


class Chunk:
    """Members of a cell, and what the guests that pass by add to them."""

    def __init__(self, rep: np.ndarray, x: np.ndarray, cosine: float):
        self.rep, self.x, self.cosine = rep, x, cosine
        self.norm = np.linalg.norm(x, axis=1)
        self.links = np.zeros(len(rep), np.int64)
        self.label = np.arange(len(rep))
        self.forest: list[tuple[int, int]] = []

    def meet(self, rep: np.ndarray, copies: np.ndarray, y: np.ndarray) -> None:
        close = (self.x @ y.T) / (self.norm[:, None] * np.linalg.norm(y, axis=1)) >= self.cosine
        close &= self.rep[:, None] != rep
        self.links += close @ copies
        for g in np.flatnonzero(close.any(0)):
            mine = np.flatnonzero(close[:, g])
            self.forest.append((int(self.rep[mine[0]]), int(rep[g])))
            base = self.label[mine[0]]
            for label in np.unique(self.label[mine]):
                if label != base:
                    # two members with one guest in common are tied by it
                    self.forest.append((int(self.rep[np.flatnonzero(self.label == label)[0]]), int(rep[g])))
                    self.label[self.label == label] = base


def _join(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, key, waiting = None, None, []

        def result() -> pa.RecordBatch:
            rep = np.array([*chunk.rep, *(a for a, _ in chunk.forest)], np.int64)
            other = pa.array([*([None] * len(chunk.rep)), *(b for _, b in chunk.forest)], pa.int64())
            links = pa.array([*chunk.links.tolist(), *([None] * len(chunk.forest))], pa.int64())
            return pa.record_batch([pa.array(rep), other, links], ["a", "b", "links"])

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in ("width", "cell", "chunk", "kind")], 1) if batch.num_rows else np.zeros((0, 4), int)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                rep, x = part.column("rep").to_numpy(), matrix(part.column("embedding"))
                if tuple(keys[a, :3]) != key:
                    if chunk is not None:
                        yield result()
                    chunk, key, waiting = None, tuple(keys[a, :3]), []
                if keys[a, 3] == 0:
                    waiting.append((rep, x))
                    continue
                if chunk is None:
                    chunk = Chunk(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]), cosine)
                copies = part.column("copies").to_numpy()
                for at in range(0, len(rep), MEET):
                    chunk.meet(rep[at : at + MEET], copies[at : at + MEET], x[at : at + MEET])
        if chunk is not None:
            yield result()

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (``vec_id``, ``embedding``)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)")
    rows = rows.withColumn("embedding", F.when(sound, F.col("embedding")))
    named = rows.filter(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull())
    classes = named.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumn("width", F.size("embedding"))
    classes = stored(classes)

    r = float(np.sqrt(2 - 2 * cosine))
    pivots: dict[int, np.ndarray] = {}
    for width, n in classes.groupBy("width").agg(F.count("*").alias("n")).collect():
        count = int(min(PIVOTS, -(-n // CELL)))
        sample = classes.filter(F.col("width") == width).orderBy(F.xxhash64("rep"), "rep").limit(count).select("embedding").collect()
        pivots[width] = unit(np.array([s["embedding"] for s in sample], np.float64))
    homes = stored(classes.mapInArrow(_homes(pivots), "embedding array<double>, rep bigint, copies bigint, width int, home int, apart double"))
    sizes = homes.groupBy("width", "home").agg(F.max("apart").alias("far"), F.count("*").alias("n"))
    radius = {w: np.full(len(p), -np.inf) for w, p in pivots.items()}
    for s in sizes.collect():  # a row for each pivot
        radius[s["width"]][s["home"]] = s["far"]
    chunks = sizes.select("width", F.col("home").alias("cell"), F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    placed = homes.mapInArrow(_guests(pivots, radius, r), "width int, cell int, kind int, rep bigint, copies bigint, embedding array<double>")
    own = F.array(F.pmod(F.xxhash64("rep"), "chunks").cast("int"))
    placed = placed.join(F.broadcast(chunks), ["width", "cell"]).withColumn(
        "chunk", F.explode(F.when(F.col("kind") == 0, own).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1)))
    )
    found = stored(
        placed.repartition("width", "cell", "chunk").sortWithinPartitions("width", "cell", "chunk", "kind", "rep")
        .select("width", "cell", "chunk", "kind", "rep", "copies", "embedding").mapInArrow(_join(cosine), "a bigint, b bigint, links bigint")
    )
    joined = components(found.filter("b is not null").select("a", "b"))
    links = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    per_class = classes.join(links, "rep").join(joined, F.col("rep") == F.col("id"), "left").select(
        "embedding", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    out = rows.join(per_class, "embedding", "left").select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.col("n_links")).alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("c")
    )
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
