"""Substring dedup: passages of ``WINDOW`` words that occur more than once are cut out of every document.

1. *Anchors.* In each window the ``ANCHOR``-word run of the smallest hash is its anchor, so equal windows have equal anchors.
   Consecutive windows with one anchor form a *region*, kept as (anchor, hash of the region, place) without any text. Anchors
   that occur once cannot lie in a recurring window; anchors are counted and the others dropped.
2. *Confirmation.* Regions that occur twice as a whole recur with all their windows. For a region seen once whose anchor
   recurs, the windows themselves are counted, over one copy of each region of that anchor. Every region gets a bit mask of
   its recurring windows.
3. *Passages.* One copy of each confirmed region is read: the codes of its words (8 bits of their hashes), at most ``WINDOW - ANCHOR + 1``
   windows long, and 64-bit hashes to verify by. A passage carries no place; a document is handed the passages of the regions it has.
4. *Automata.* A shard takes the texts of one step of a task, compiles the distinct passages handed to them into an Aho-Corasick
   automaton (a word is one of 256 symbols, as nodes look up their branches one by one) and streams every text of the shard through it. The automaton alone says where passages
   lie; each match is verified by its window hashes and its words are removed. Its size is bounded by the texts of the step.

Null and empty texts have no words. Documents of fewer than ``WINDOW`` words keep all. Rows that repeat a doc_id, or have
none, count as documents of their own; a row that repeats another as a whole therefore loses all its windows. Equal words are
equal bytes, ties of the smallest hash go to the leftmost. A very long text is a step of its own. An empty table gives no rows,
and columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tables import stored
from llm.words import STEP_BYTES, mix, signed, steps, text_parts, window_hashes, window_owner, words_of

WINDOW, ANCHOR = 35, 8
#: What names a row: its doc_id and a 64-bit hash of its text; a null doc_id is replaced by a second hash.
ROW = ["id", "tail"]


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of ``size`` values."""
    out, have = values, 1
    while have * 2 <= size:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = size - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def regions(part: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: text, first window (word number in its text), windows, anchor, whole hash."""
    words = words_of(part.column("text"))
    hashes = words.hashes()
    start, text = window_owner(words.first, WINDOW)
    if not len(start):
        empty = np.zeros(0, np.int64)
        return {"text": empty, "first": empty, "n": empty, "anchor": empty, "region": empty}
    # the smallest hash counts by its upper half, and the leftmost of equal ones; its place is in the lower half
    anchors = window_hashes(hashes, ANCHOR)
    place = (anchors >> np.uint64(32) << np.uint64(32)) | np.arange(len(anchors), dtype=np.uint64)
    place = (sliding_min(place, WINDOW - ANCHOR + 1)[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    size = np.diff(at, append=len(start))
    # windows of a region overlap, so the sum of their hashes tells it from others
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(window_hashes(hashes, WINDOW)[start]))])
    whole = mix(sums[at + size] - sums[at] + size.astype(np.uint64))
    return {"text": text[at], "first": start[at] - words.first[text[at]], "n": size, "anchor": signed(anchors[place[at]]), "region": signed(whole)}


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            found = regions(part)
            yield pa.record_batch(
                [
                    pa.array(found["anchor"]), pa.array(found["region"]),
                    *(part.column(k).take(pa.array(found["text"])) for k in ROW),
                    pa.array(found["first"].astype(np.int32)), pa.array(found["n"].astype(np.int32)),
                ], ["anchor", "region", *ROW, "first", "n"],
            )


def codes_of(hashes: np.ndarray) -> np.ndarray:
    """One byte a word, from the upper bits of its hash."""
    return (hashes >> np.uint64(56)).astype(np.uint8)


def window_sums(hashes: np.ndarray) -> np.ndarray:
    """Sums of the window hashes before each word: their differences verify runs of windows."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(window_hashes(hashes, WINDOW)))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The regions listed beside each text: codes of their words, sum of their windows, and the windows where unsure."""
    for batch in batches:
        for part in steps(batch, "text"):
            words = words_of(part.column("text"))
            hashes = words.hashes()
            sums, windows, codes = window_sums(hashes), window_hashes(hashes, WINDOW), codes_of(hashes)
            listed = part.column("listed")
            rows = listed.flatten()
            owner = np.repeat(np.arange(part.num_rows), np.diff(listed.offsets.to_numpy()))
            first, n = (rows.field(k).to_numpy().astype(np.int64) for k in ("first", "n"))
            at = words.first[owner] + first
            raw = codes[_runs(at, n + WINDOW - 1)].tobytes()
            ends = np.concatenate([[0], np.cumsum(n + WINDOW - 1)]).astype(np.int32)
            told = np.where(rows.field("unsure").to_numpy(zero_copy_only=False), n, 0)
            values = pa.array(signed(windows[_runs(at, told)]))
            yield pa.record_batch(
                [
                    *(rows.field(k) for k in ("anchor", "region", "times")),
                    pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(raw)]),
                    pa.array(signed(sums[at + n] - sums[at])),
                    pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(told)]).astype(np.int32), values),
                ], ["anchor", "region", "times", "codes", "total", "windows"],
            )


def _runs(at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places ``at[k], at[k] + 1, ...`` of each k, ``length[k]`` of them."""
    before = np.cumsum(length) - length
    return np.arange(length.sum()) + np.repeat(at - before, length)


def passages_of(offered: pa.ListArray) -> tuple[set[bytes], np.ndarray]:
    """Codes of the distinct passages handed to the texts of a step, and the window sums of all of them."""
    rows = offered.flatten()
    found, totals = set(), set()
    for codes, mask, total, windows in zip(*(rows.field(k).to_pylist() for k in ("codes", "mask", "total", "windows")), strict=True):
        n = len(codes) - WINDOW + 1
        if mask == (1 << n) - 1:
            found.add(codes)
            totals.add(total)
        else:  # some windows only, so their hashes are at hand
            bits = np.concatenate([[False], (mask >> np.arange(n)) & 1 == 1, [False]])
            edges = np.flatnonzero(bits[1:] != bits[:-1]).tolist()
            parts = mix(np.array(windows, np.int64).view(np.uint64))
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                found.add(codes[a : b + WINDOW - 1])
                totals.add(int(parts[a:b].sum().view(np.int64)))
    return found, np.array(sorted(totals), np.int64)


def located(words, hashes: np.ndarray, passages: set[bytes], totals: np.ndarray) -> np.ndarray:
    """Words within any occurrence, in any text, of ``passages``: compiles them into an automaton and streams each text through it.

    An occurrence counts if the sum of its windows is one of ``totals``, so unequal words of one code are told apart.
    """
    removed = np.zeros(len(hashes) + 1, np.int64)
    if not passages:
        return removed[:-1] > 0
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for passage in passages:
        automaton.add_word(passage.decode("latin-1"))
    automaton.make_automaton()
    stream = codes_of(hashes).tobytes().decode("latin-1")
    lasts, lengths = [], []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= WINDOW:
            for last, length in automaton.iter(stream[a:b]):
                lasts.append(a + last)
                lengths.append(length)
    stop, sums = np.array(lasts, np.int64) + 1, window_sums(hashes)
    start = stop - np.array(lengths, np.int64)
    true = np.isin(signed(sums[stop - WINDOW + 1] - sums[start]), totals)
    np.add.at(removed, start[true], 1)
    np.add.at(removed, stop[true], -1)
    return np.cumsum(removed[:-1]) > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text", 2 * STEP_BYTES):
            words = words_of(part.column("text"))
            removed = located(words, words.hashes(), *passages_of(part.column("offered")))
            sums = np.concatenate([[0], np.cumsum(removed)])
            gone = sums[words.first[1:]] - sums[words.first[:-1]]
            raw, offsets = text_parts(part.column("text"))
            kept = []
            for k, n in enumerate(gone.tolist()):
                own = raw[offsets[k] : offsets[k + 1]].tobytes().split()
                if n:
                    stay = ~removed[words.first[k] : words.first[k + 1]]
                    own = list(compress(own, stay.tolist()))
                kept.append(b" ".join(own))
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(words.counts), pa.array(gone), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )


def other_key(name: str) -> Column:
    """``k``: another key for the same values, so that a join with their counts is dealt out anew and not where they were
    counted; only then can a frequent value be split among tasks."""
    return F.col(name).bitwiseXOR(F.lit(1)).alias("k")


def cut_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the other words, joined by a space) of every document."""
    own = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit(1), "text"))
    docs = docs.select("doc_id", "text", own.alias("id"), F.xxhash64("text").alias("tail"))
    found = docs.select("text", *ROW).mapInArrow(_regions, "anchor bigint, region bigint, id bigint, tail bigint, first int, n int")
    again = found.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1").select(other_key("anchor"))
    hits = stored(found.withColumn("k", other_key("anchor")).join(again, "k", "left_semi").drop("k"))

    # one row of each distinct region, with a place where it can be read
    region = hits.groupBy("anchor", "region").agg(F.count("*").alias("times"), F.min(F.struct(*ROW, "first", "n")).alias("at"))
    region = stored(region.select("anchor", "region", "times", "at.*"))
    # anchors with a region that was seen once: windows of all their regions count
    unsure = region.filter("times = 1").select("anchor").distinct().select(other_key("anchor"), F.lit(True).alias("unsure"))
    listed = region.withColumn("k", other_key("anchor")).join(unsure, "k", "left").groupBy(*ROW).agg(
        F.collect_list(F.struct("anchor", "region", "first", "n", "times", F.coalesce("unsure", F.lit(False)).alias("unsure"))).alias("listed")
    )
    texts = docs.join(listed, ROW).select("text", "listed")
    read = stored(texts.mapInArrow(_read, "anchor bigint, region bigint, times bigint, codes binary, total bigint, windows array<bigint>"))
    windows = read.select("anchor", "region", "times", F.posexplode("windows").alias("place", "window"))
    twice = windows.groupBy("window").agg(F.sum("times").alias("times")).filter("times > 1").select(other_key("window"))
    single = windows.filter("times = 1").withColumn("k", other_key("window")).join(twice, "k", "left_semi").groupBy("anchor", "region").agg(
        F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask")
    )
    whole = F.expr(f"shiftleft(1L, length(codes) - {WINDOW - 1}) - 1").alias("mask")
    none = F.expr("cast(array() as array<bigint>)").alias("windows")
    parts = read.filter("times = 1").join(single, ["anchor", "region"]).select("anchor", "region", "codes", "total", "mask", "windows")
    # equal rows have each read the same region
    sure = read.filter("times > 1").dropDuplicates(["anchor", "region"])
    passages = sure.select("anchor", "region", "codes", "total", whole, none).union(parts)
    # a region is handed to a document once, however often and on however many equal rows it lies there
    offers = hits.select(*ROW, "anchor", "region").distinct().join(passages, ["anchor", "region"])
    offered = offers.groupBy(*ROW).agg(F.collect_list(F.struct("codes", "total", "mask", "windows")).alias("offered"))
    nothing = F.expr("cast(array() as array<struct<codes:binary,total:bigint,mask:bigint,windows:array<bigint>>>)")
    shards = docs.join(offered, ROW, "left").select("doc_id", "text", F.coalesce("offered", nothing).alias("offered"))
    return shards.mapInArrow(_cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept_text string")


def digests(docs: DataFrame) -> DataFrame:
    return cut_passages(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
