"""Maximal periodic runs of words, found scale by scale in overlapping tiles.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and a length of at least ``LEAST`` words and
``TIMES`` periods, which no neighbouring word extends. Put another way, it is a longest stretch of *matches*, places i whose words i
and i + q are equal.

* **Octaves.** Periods from B to 2 B - 1 are looked for together, with boundaries every B words (B = 8 for all shorter ones). A run has
  matches over two periods or more, so matches fill the gap between two neighbouring boundaries c and c + B: the block of B words at c
  recurs q words on. Hashes of all blocks of an octave, made by doubling, show these places by one comparison a word.
* **Tiles.** Each octave cuts a document into tiles of ``CORE`` words or one B, with B words before and 3 B words behind. A tile is
  solved by itself: blocks that recur at the same distance from boundary to boundary form a chain, and the Z-function at its two
  outer boundaries (how far words agree with those q on, to the left and to the right) ends it to the word. What ends within the
  tile's reach is a whole stretch and is judged there; what goes on is a fragment.
* **Stitching.** Fragments are shuffled by document and period, and those that overlap are joined. A stretch leaves one fragment a
  tile, so a run as long as the document has as many rows as tiles.
* Periods are smallest ones: q is left out if the q words at a boundary are a shorter word sequence over and over. As a run
  covers three periods, its smallest period divides all others.

Tiles of documents of up to ``spread`` words are solved by the task that cut them; those of longer ones are dealt out over all tasks
along with the fragments. Time is that of n log^2 n comparisons in numpy for n words, whatever the words.

Null and empty texts have no words and no runs. Rows are told apart by doc_id (null is an id) and a 128-bit hash of the text: rows
equal in both have equal runs, each of them gets its result. Words are compared by 64-bit hashes. Columns besides doc_id and text are
not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import stored
from llm.words import steps, words_of

LEAST = 24
TIMES = 3
#: Words of a tile's core, and boundary distance of the lowest octave.
CORE = 4096
SMALL = 8
#: Longest document, in words, whose tiles are not dealt out.
SPREAD = 1 << 20

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def double(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of blocks of ``2 * width`` words from those of ``width`` words. Not linear, so no pattern of words defeats it."""
    out = hashes[:-width] * _K1 if width < len(hashes) else hashes[:0].copy()
    out += hashes[width:]
    out ^= out >> np.uint64(29)
    out *= _K2
    out ^= out >> np.uint64(32)
    return out


def primes_to(n: int) -> list[int]:
    sieve = np.ones(n + 1, bool)
    sieve[:2] = False
    for k in range(2, int(n**0.5) + 1):
        sieve[k * k :: k] &= not sieve[k]
    return np.flatnonzero(sieve).tolist()


def primitive(levels: list[np.ndarray], at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the ``q`` words at ``at`` are no repetition of a shorter sequence. ``levels[j]``: hashes of blocks of 2^j words."""
    good = np.ones(len(q), bool)
    if not len(q):
        return good
    rest, most = q.copy(), int(q.max())
    for m in primes_to(int(most**0.5) + 1):
        mine = np.flatnonzero(rest % m == 0)
        if len(mine):
            good[mine] &= ~_repeats(levels, at[mine], q[mine], q[mine] // m)
            while len(mine):
                rest[mine] //= m
                mine = mine[rest[mine] % m == 0]
    mine = np.flatnonzero(rest > 1)  # one prime over the root, at most
    good[mine] &= ~_repeats(levels, at[mine], q[mine], q[mine] // rest[mine])
    return good


def _repeats(levels, at, q, p):
    """Whether the ``q`` words at ``at`` have period ``p``, a proper divisor of ``q``."""
    size = q - p
    j = np.frexp(size.astype(np.float64))[1] - 1  # two blocks of 2^j words cover them
    out = np.zeros(len(q), bool)
    for k in np.unique(j):
        mine = np.flatnonzero(j == k)
        h, a, step, end = levels[k], at[mine], p[mine], (size - (1 << k))[mine]
        out[mine] = (h[a] == h[a + step]) & (h[a + end] == h[a + end + step])
    return out


def reach(words: np.ndarray, at: int, q: int, step: int, limit: int) -> int:
    """Z-function at a boundary: how many words from ``at`` on (``step`` 1) or before it (-1) equal those ``q`` on, ``limit`` at most."""
    if step > 0:
        limit = min(limit, len(words) - q - at)
        apart = words[at : at + limit] != words[at + q : at + q + limit]
    else:
        limit = min(limit, at)
        apart = (words[at - limit : at] != words[at - limit + q : at + q])[::-1]
    return int(apart.argmax()) if apart.any() else max(limit, 0)


def need(q: int) -> int:
    """Matches that a run of period ``q`` has at least."""
    return max((TIMES - 1) * q, LEAST - q)


def solve(levels: list[np.ndarray], octave: int, first: int, core: int, n: int, origin: int) -> list[tuple[int, int, int, bool]]:
    """Stretches of matches ``(period, from, to, whole)`` of one tile.

    ``levels[0]`` are the words of the document (of ``n`` words) from ``origin`` on, to which the hashes of longer blocks are added as far as
    they are wanted; the boundaries are ``first``, ``first + B`` ... before ``core``. Stretches that are whole and too short for a run are left out.
    """
    width, words = 1 << octave, levels[0]
    periods = np.arange(1 if width == SMALL else width, 2 * width)
    while len(levels) <= octave:
        levels.append(double(levels[-1], 1 << (len(levels) - 1)))
    blocks = levels[octave]
    bounds = np.arange(first, core, width) - origin
    bounds = bounds[bounds + width + periods[0] <= len(words)]
    if not len(bounds):
        return []
    padded = np.concatenate([blocks, np.zeros(2 * width, np.uint64)])
    ahead = np.lib.stride_tricks.sliding_window_view(padded, len(periods))
    which, k = np.nonzero(ahead[bounds + periods[0]] == blocks[bounds][:, None])
    at, q = bounds[which], periods[k]
    fits = at + q + width <= len(words)
    at, q = at[fits], q[fits]
    good = primitive(levels, at, q)
    at, q = at[good], q[good]
    if not len(at):
        return []
    order = np.lexsort((at, q))
    at, q = at[order], q[order]
    cut = np.flatnonzero((np.diff(q, prepend=-1) != 0) | (np.diff(at, prepend=-1) != width))
    out = []
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(at)], strict=True):
        p, start, end = int(q[a]), int(at[a]), int(at[b - 1]) + width
        left, right = reach(words, start, p, -1, width), reach(words, end, p, 1, width)
        lo, hi = start - left + origin, end + right + origin
        whole = (left < width or lo == 0) and (right < width or hi + p == n)
        if not whole or hi - lo >= need(p):
            out.append((p, lo, hi, whole))
    return out


def tiles(n: int, core: int = CORE) -> Iterator[tuple[int, int, int, int, int]]:
    """Tiles of a document of ``n`` words: octave, first boundary, end of the boundaries, first and last word needed."""
    octave = SMALL.bit_length() - 1
    while n >= max(LEAST, TIMES << octave) or (octave == SMALL.bit_length() - 1 and n >= LEAST):
        width = 1 << octave
        size = max(core, width)
        for first in range(0, n, size):
            yield octave, first, min(first + size, n), max(first - width, 0), min(first + size + 3 * width, n)
        octave += 1


STRETCH = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("whole", pa.bool_())]))
KINDS = {
    "doc_id": pa.int64(), "text_hash": pa.binary(), "n_words": pa.int64(), "text": pa.string(), "plain": pa.string(), "stretches": STRETCH,
    "octave": pa.int32(), "first": pa.int64(), "core": pa.int64(), "origin": pa.int64(), "words": pa.binary(),
}
CUT = (
    "doc_id bigint, text_hash binary, n_words bigint, text string, plain string, stretches array<struct<period:bigint,start:bigint,stop:bigint,whole:boolean>>, "
    "octave int, first bigint, core bigint, origin bigint, words binary"
)
SCHEMA = pa.schema(list(KINDS.items()))


def _cut(spread: int, core: int, digest: bool):
    """A row for every document, and one for every tile of those longer than ``spread``; other tiles are solved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                words = words_of(step.column("text"))
                hashes = words.hashes()
                ids, texts = step.column("doc_id").cast(pa.int64()).to_pylist(), step.column("text")
                rows = []
                for d, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                    n, found, levels = b - a, [], {}
                    if n <= spread:
                        for octave, first, end, lo, hi in tiles(n, core):
                            found += solve(levels.setdefault((lo, hi), [hashes[a + lo : a + hi]]), octave, first, end, n, lo)
                    text = texts[d].as_py() or ""
                    row = dict.fromkeys(KINDS) | {"doc_id": ids[d], "n_words": n}
                    if found or n > spread:
                        row |= {"text": text, "text_hash": hashlib.blake2b(text.encode(), digest_size=16).digest()}
                        row["stretches"] = [{"period": p, "start": x, "stop": y, "whole": w} for p, x, y, w in found]
                    else:
                        row["plain"] = _kept(b" ".join(text.encode().split()), digest)
                    rows.append(row)
                    if n > spread:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                        key, rows = {"doc_id": ids[d], "text_hash": row["text_hash"], "n_words": n}, []
                        for octave, first, end, lo, hi in tiles(n, core):
                            tile = {"octave": octave, "first": first, "core": end, "origin": lo, "words": hashes[a + lo : a + hi].tobytes()}
                            yield pa.RecordBatch.from_pylist([dict.fromkeys(KINDS) | key | tile], SCHEMA)
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return run


def _kept(text: bytes, digest: bool) -> str:
    return hashlib.sha256(text).hexdigest() if digest else text.decode()


FRAGMENT = "doc_id bigint, text_hash binary, period bigint, start bigint, stop bigint, whole boolean"


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments pass; tiles (``words`` is not null) are solved."""
    names = ["doc_id", "text_hash", "period", "start", "stop", "whole"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    for batch in batches:
        table = pa.Table.from_batches([batch])
        done = table.filter(table["words"].is_null()).select(names)
        yield from done.cast(pa.schema(list(zip(names, kinds, strict=True)))).to_batches()
        for r in table.filter(table["words"].is_valid()).to_pylist():
            found = solve([np.frombuffer(r["words"], np.uint64)], r["octave"], r["first"], r["core"], r["n_words"], r["origin"])
            if found:
                columns = [[r["doc_id"]] * len(found), [r["text_hash"]] * len(found), *map(list, zip(*found, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _stitched(fragments: DataFrame) -> DataFrame:
    """Runs ``doc_id, text_hash, start, length, period``: fragments of a document and period that overlap are one stretch of matches."""
    key = ["doc_id", "text_hash", "period"]
    by = Window.partitionBy(*key).orderBy("start", "stop")
    before = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before >= F.col("start"), 0).otherwise(1)
    islands = fragments.distinct().withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(by))
    whole = islands.groupBy(*key, "_island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    matches = F.col("stop") - F.col("start")
    least = F.greatest(F.col("period") * (TIMES - 1), F.lit(LEAST) - F.col("period"))
    return whole.filter(matches >= least).select("doc_id", "text_hash", "start", (matches + F.col("period")).alias("length"), "period")


def cut(docs: DataFrame, spread: int = SPREAD, core: int = CORE, digest: bool = False) -> DataFrame:
    """A row for every document: ``doc_id, n_words`` and, if a run is possible, ``text_hash, text, stretches``, else ``plain``, its words
    joined by one space (``digest``: the SHA-256 of that). Tiles that are dealt out are rows of their own, with ``octave``."""
    return stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_cut(spread, core, digest), CUT))


def find_runs(pieces: DataFrame) -> DataFrame:
    """Runs of the documents of ``cut``: ``doc_id, text_hash, start, length, period``, once for rows equal in id and text."""
    key, tile = ["doc_id", "text_hash"], ["octave", "first", "core", "origin", "n_words", "words"]
    stretch = {"period": "bigint", "start": "bigint", "stop": "bigint", "whole": "boolean"}
    solved = pieces.filter("stretches IS NOT NULL").select(*key, F.inline("stretches"))
    solved = solved.select("*", *[F.lit(None).cast(pieces.schema[c].dataType).alias(c) for c in tile])
    dealt = pieces.filter("octave IS NOT NULL").select(*key, *[F.lit(None).cast(k).alias(c) for c, k in stretch.items()], *tile)
    mixed = solved.unionByName(dealt).repartition(*key, "octave", "first", "period")
    return _stitched(mixed.mapInArrow(_solved, FRAGMENT))


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _collapse(digest: bool):
    """Text of the words that are in no run after its first period, joined by one space, as ``plain``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist(), strict=True):
                words = text.as_py().encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    change[r["start"] + r["period"]] += 1
                    change[r["start"] + r["length"]] -= 1
                gone = np.cumsum(change)[:-1] > 0
                out.append(_kept(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g), digest))
            names = ["doc_id", "n_words", "runs"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(out, pa.string())], names=[*names, "plain"])

    return run


def with_runs(docs: DataFrame, spread: int = SPREAD, core: int = CORE, digest: bool = False) -> DataFrame:
    """Every row of ``docs``: ``doc_id, n_words, runs`` (by start, then period) and ``collapsed``, its words without the repetitions of
    runs, joined by one space (``digest``: the SHA-256 of that)."""
    pieces = cut(docs, spread, core, digest)
    found = F.sort_array(F.collect_list(F.struct("start", "period", "length")))  # as many as a document can have
    runs = find_runs(pieces).groupBy("doc_id", "text_hash").agg(found.alias("_runs"))
    ordered = F.transform("_runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    runs = runs.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), ordered.alias("runs"))
    near = pieces.filter("text IS NOT NULL")
    both = near.join(runs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    both = both.select("doc_id", "n_words", "text", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
    found = both.mapInArrow(_collapse(digest), f"doc_id bigint, n_words bigint, runs {RUNS}, plain string")
    none = pieces.filter("plain IS NOT NULL").select("doc_id", "n_words", F.array().cast(RUNS).alias("runs"), "plain")
    return found.unionByName(none).withColumnRenamed("plain", "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, in which every tenth document (by the CRC-32 of its id) repeats some of its words from one word on to the end.

    With h that value, g = h div 10, n words, a = g mod n and p = 1 + (n - a) div (3 + g mod 8), each word i >= a is word a + (i - a) mod p.
    Documents without id or words stay as they are.
    """
    rows = docs.select("doc_id", "text", F.expr("crc32(cast(doc_id AS string))").alias("_h"))
    rows = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")))
    rows = rows.withColumns({"_n": F.size("_w"), "_g": F.floor(F.col("_h") / 10)})
    rows = rows.withColumn("_a", F.expr("if(_n > 0, cast(_g % _n AS int), null)"))
    rows = rows.withColumn("_p", F.expr("1 + cast((_n - _a) div (3 + _g % 8) AS int)"))
    repeated = F.expr("array_join(transform(sequence(0, _n - 1), i -> get(_w, if(i < _a, i, _a + (i - _a) % _p))), ' ')")
    return rows.select("doc_id", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """Runs of every planted document: their number, the one of greatest exact length / period, digests of all and of the rest."""
    rows = with_runs(planted(docs), digest=True)
    longer = "a.length * b.period > b.length * a.period"
    best = F.expr(f"aggregate(runs, get(runs, 0), (b, a) -> if({longer}, a, b))")  # by start, then period: the first of equals stays
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    rows = rows.withColumn("_best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )
