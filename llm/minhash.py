"""Near-duplicates by MinHash: many universal hash minima, banding, verification, and connected components.

1. Every text becomes the set of its distinct word shingles (hashed to 64 bits), a 128-bit key of that set, and one key for
   each band of minima. Texts of equal sets form a class with the smallest doc_id as its representative.
2. Representatives that share a band key are tied to the smallest one of the bucket, and ties form clusters: any linked
   pair lies in one cluster, but for pairs that no band holds together (about 5 in 100 million at the threshold).
3. Within a cluster minima are compared and pairs whose estimate may reach the threshold are confirmed on their full sets.
   Pairs that are connected already need no look, so links come out as a forest and not as all pairs. A large cluster is
   cut into chunks by a hash; each pair of chunks is a task of its own, bounded in documents and shingles.
4. The confirmed links give the components.

Null or empty texts have empty sets and link with nothing. A text with fewer words than a shingle is one shingle.
Rows that share a doc_id are one node: what links with one of them links with all. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.graph import components
from llm.tables import groups, stored
from llm.words import LOWER_KEYS, mix, signed, steps, window_hashes, words_of

BANDS, ROWS = 32, 4
#: Estimates this far below the threshold are not looked at; 5.7 standard deviations of 128 minima.
MARGIN = 0.2
CHUNK_DOCS, CHUNK_SHINGLES = 4096, 2_000_000

_random = np.random.Generator(np.random.PCG64(977))
FACTORS = _random.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(part: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one after another; and the first of each text."""
    words = words_of(part.column("text"))
    hashes = words.hashes(LOWER_KEYS)
    shingles = window_hashes(hashes, size)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(shingles[a : b - size + 1]))
        elif b > a:
            sets.append(mix(window_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            sets.append(hashes[:0])
    return np.concatenate([*sets, hashes[:0]]), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def minima(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[text, hash]: smallest value of each universal hash over each set; sets must not be empty."""
    out = np.empty((len(first) - 1, len(FACTORS)), np.uint64)
    for k, (factor, shift) in enumerate(zip(FACTORS, SHIFTS, strict=True)):
        out[:, k] = np.minimum.reduceat(values * factor + shift, first[:-1])
    return out >> np.uint64(16)


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", 1 << 20):
                values, first = shingle_sets(part, size)
                counts = np.diff(first)
                full = counts > 0
                k1, k2 = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
                bands = np.zeros((int(full.sum()), BANDS), np.int64)
                if len(bands):
                    at = np.append(first[:-1][full], first[-1])
                    k1[full] = signed(np.add.reduceat(mix(values), at[:-1]))
                    k2[full] = signed(np.add.reduceat(mix(values ^ FACTORS[0]), at[:-1]))
                    rows = minima(values, at).reshape(len(bands), BANDS, ROWS)
                    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
                    for r in range(ROWS):
                        key = mix(key + rows[:, :, r])
                    bands = signed(key)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)), pa.array(bands.reshape(-1)))
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(counts), pa.array(k1), pa.array(k2), lists], ["doc_id", "n_shingles", "k1", "k2", "bands"]
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                values, first = shingle_sets(part, size)
                lists = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.record_batch([*part.drop_columns(["text"]).columns, pa.array(lists, pa.binary())], [*part.drop_columns(["text"]).schema.names, "shingles"])

    return run


def confirmed_links(sets: list[np.ndarray], side: np.ndarray, part: int, whole: int) -> list[tuple[int, int]]:
    """A forest of the links among sets, by position: links need ``whole`` * common >= ``part`` * united.

    Positions of side 0 and 1 are compared across; with one side only, all are.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    same = side.min() == side.max()
    if n > 2:
        marks = minima(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])).astype(np.uint8)
    label = np.arange(n)
    rows, columns, votes = [], [], []
    least = (part / whole - MARGIN) * len(FACTORS)
    right = np.arange(n) if same else np.flatnonzero(side == 1)
    for i in np.arange(n) if same else np.flatnonzero(side == 0):
        other = right[right > i] if same else right
        small, large = np.minimum(sizes[i], sizes[other]), np.maximum(sizes[i], sizes[other])
        other = other[whole * small >= part * large]
        if n > 2 and len(other):
            vote = np.count_nonzero(marks[other] == marks[i], axis=1)
            other, vote = other[vote >= least], vote[vote >= least]
        else:
            vote = np.zeros(len(other), np.int64)
        rows.append(np.full(len(other), i, np.int32))
        columns.append(other.astype(np.int32))
        votes.append(vote.astype(np.uint8))
    a, b, vote = (np.concatenate([*x, np.zeros(0, np.int32)]).astype(np.int64) for x in (rows, columns, votes))
    links = []
    for level in np.unique(vote)[::-1]:
        at = np.flatnonzero(vote == level)
        while len(at):
            at = at[label[a[at]] != label[b[at]]]  # the rest is connected already
            for turn, k in enumerate(at[:512].tolist()):
                i, j = a[k], b[k]
                if label[i] == label[j]:
                    continue
                common = sizes[i] + sizes[j] - len(np.union1d(sets[i], sets[j]))
                if whole * common >= part * (sizes[i] + sizes[j] - common):
                    links.append((int(i), int(j)))
                    label[label == label[j]] = label[i]
            at = at[512:]
    return links


def _links(part: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in groups(batches, ["component", "i", "j"]):
            ids = group.column("rep").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            for x, y in confirmed_links(sets, group.column("side").to_numpy(), part, whole):
                a.append(ids[x])
                b.append(ids[y])
            if len(a) > 50_000:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the smallest doc_id of its component) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = stored(docs.mapInArrow(_signatures(shingle), "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>"))
    key = ["k1", "k2", "n_shingles"]
    classes = marks.filter("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    keys = classes.select("rep", F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.min("rep").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    ties = keys.join(buckets, "band").filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    clusters = components(ties)

    sized = clusters.join(classes.select(F.col("rep").alias("id"), "n_shingles"), "id").select("id", "component", "n_shingles")
    chunks = sized.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / CHUNK_DOCS), F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES), F.lit(1)).cast("int").alias("chunks")
    )
    placed = clusters.join(chunks, "component").select("id", "component", "chunks", F.pmod(F.xxhash64("id"), "chunks").cast("int").alias("chunk"))
    texts = docs.join(placed, docs.doc_id == placed.id).select("doc_id", "component", "chunks", "chunk", "text")
    sets = texts.mapInArrow(_sets(shingle), "doc_id bigint, component bigint, chunks int, chunk int, shingles binary")
    blocks = sets.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "component", F.least("chunk", "k").alias("i"), F.greatest("chunk", "k").alias("j"),
        (F.col("chunk") > F.col("k")).cast("int").alias("side"), F.col("doc_id").alias("rep"), "shingles",
    )
    links = blocks.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "side", "rep").mapInArrow(_links(part, whole), "a bigint, b bigint")
    joined = components(links)

    ids = classes.drop("bands").join(joined, F.col("rep") == F.col("id"), "left").select(*key, F.coalesce("component", "rep").alias("component"))
    out = marks.drop("bands").join(ids, key, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
