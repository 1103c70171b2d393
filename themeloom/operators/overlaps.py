"""Shared quotes of all pairs of codes, by blocks of a matrix product.

Codes on common quotes share something with nearly all others, so neither pairs nor their quotes can be written out to be counted.
Here only sets travel, in a compact form, and pairs are counted where they meet:

1. Quotes go by 96 bits of hash, dealt to ``SLICES`` of the hash range; duplicates are dropped before the shuffle and after.
2. In a slice, quotes of two codes or more get small numbers, frequent ones first; the entries of a slice, quote by quote, are stored
   as differences, about a byte and a half an entry.
3. Codes are put in an order, like ones together and then by size, and cut into chunks. The order changes no count, only where codes meet.
   It makes blocks either dense or nearly empty, and blocks of sets too different in size for the threshold are left out, which is exact.
4. Each other pair of chunks is a block: a task reads the slices of its two chunks one by one and adds up the number of shared quotes in
   one matrix, frequent quotes by products of dense pieces, the others pair by pair.

The counts are exact. The work grows with the pairs of codes; memory is one matrix and one slice of two chunks, and the disk holds the
compact sets once for each chunk they meet. The list of codes goes to all tasks, as it is small beside its pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.session import materialise

SLICES = 128
_SLICE_BITS = 7
# Entries and codes of a chunk, about; the matrix of a block has the square of the codes.
CHUNK_ENTRIES = 50_000_000
CHUNK_CODES = 6_144
# With fewer codes, chunks are smaller, so that there are blocks for many tasks; but not below this.
SMALL_CHUNK = 1_024
# Rows taken in before their duplicates are dropped.
HELD = 2_000_000
# A quote with more than this share of a block's pairs is counted by a product: a cell of one costs so much less than a pair.
DENSE_SHARE = 0.002
# Likeness is told from the slices below this number, and from no more entries than that.
_TOLD_SLICES = 4
_TOLD_ENTRIES = 4_000_000
_LEADERS = 32
_PIECE = 1_024
_PAIRS_AT_ONCE = 2_000_000
_MOST_TASKS = 2_000
# Bits of a place in a chunk, below the number of the quote.
_PLACE_BITS = 16
_ONE = np.int32(1)
_SLICED = "app string, slice int, codes array<string>, lens array<int>, first binary, second binary"
_COMPACT = "app string, slice int, codes array<string>, n array<int>, n_words long, words binary"
_PLACED = "app string, code string, n long, chunk int, place int"
_REGROUPED = "blocks array<int>, chunk int, slice int, words binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([pa.field(n, kinds[k]) for n, k in (x.split(" ") for x in ddl.split(", "))])


def _packed(keys: np.ndarray) -> bytes:
    """Ascending numbers as their differences; bytes of the same place stand together, as high ones are mostly zero."""
    steps = np.diff(keys, prepend=0)
    width = 4 if not len(steps) or int(steps.max()) < 1 << 32 else 8
    planes = steps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zlib.compress(np.ascontiguousarray(planes), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(memoryview(data)[1:]), np.uint8).reshape(data[0], -1).T
    return np.cumsum(np.ascontiguousarray(planes).view(f"<u{data[0]}").ravel(), dtype=np.int64)


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Beginning and end of each run of equal numbers."""
    return list(pairwise([*np.flatnonzero(np.diff(keys, prepend=-1)).tolist(), len(keys)]))


def _bits(n: int) -> int:
    return max(1, (n - 1).bit_length())


def _deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``app, code, _a, _b`` to one row for each app and slice: the codes, the entries of each and their hashes."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= HELD:
            yield from _dealt_rows(pa.Table.from_batches(held))
            held, n = [], 0
    if n:
        yield from _dealt_rows(pa.Table.from_batches(held))


def _dealt_rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
    apps, codes = (table.column(c).combine_chunks().dictionary_encode() for c in ("app", "code"))
    app_names, code_names = apps.dictionary.to_pylist(), codes.dictionary.to_pylist()
    first = table.column("_a").to_numpy().view(np.uint64)
    second = table.column("_b").to_numpy().view(np.uint64).astype(np.uint32)
    own = codes.indices.to_numpy().astype(np.uint64)
    if len(app_names) == 1:
        app_of, code_of = np.zeros(len(code_names), np.int64), np.arange(len(code_names))
    else:  # codes of an app are told from those of others
        both, own = np.unique(apps.indices.to_numpy().astype(np.int64) * len(code_names) + own.astype(np.int64), return_inverse=True)
        app_of, code_of, own = both // len(code_names), both % len(code_names), own.astype(np.uint64)
    bits = np.uint64(_bits(len(app_of)))
    below = np.uint64(64 - _SLICE_BITS)
    s = first >> below
    order = np.argsort((s << below) | (own << (below - bits)) | ((first << np.uint64(_SLICE_BITS)) >> (np.uint64(_SLICE_BITS) + bits)))
    s, own, first, second = s[order], own[order], first[order], second[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    s, own, first, second = s[new].astype(np.int64), own[new].astype(np.int64), first[new], second[new]
    starts = np.flatnonzero(np.diff(s * len(app_of) + own, prepend=-1))  # of the entries of a code in a slice
    ends = np.append(starts[1:], len(own))
    row_of = s[starts] * len(app_names) + app_of[own[starts]]
    kinds = _schema(_SLICED)
    for i, j in _runs(row_of):
        lo, hi = int(starts[i]), int(ends[j - 1])
        names = [code_names[x] for x in code_of[own[starts[i:j]]].tolist()]
        row = [[app_names[int(app_of[own[lo]])]], [int(s[lo])], [names], [(ends[i:j] - starts[i:j]).tolist()], [first[lo:hi].tobytes()], [second[lo:hi].tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, kinds, strict=True)], schema=kinds)


def _number(rows: pa.Table) -> pa.Table:
    """The rows of one app and slice to its codes, the size of each there, and the entries of shared quotes: number of the quote above that of the code."""
    at: dict[str, int] = {}
    own = [np.repeat(np.array([at.setdefault(x, len(at)) for x in names], np.int64), lens) for names, lens in zip(rows.column("codes").to_pylist(), rows.column("lens").to_pylist(), strict=True)]
    code = np.concatenate(own)
    first = np.concatenate([np.frombuffer(x, np.uint64) for x in rows.column("first").to_pylist()])
    second = np.concatenate([np.frombuffer(x, np.uint32) for x in rows.column("second").to_pylist()])
    order = np.argsort(first)
    a, b = first[order], second[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
    word = np.zeros(len(a), np.int64)
    np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]), out=word[1:])
    bits = _bits(len(at))
    keys = np.sort(word << bits | code[order])
    keys = keys[np.diff(keys, prepend=-1) != 0]
    word, code = keys >> bits, keys & ((1 << bits) - 1)
    sizes, often = np.bincount(code, minlength=len(at)), np.bincount(word)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(often))
    shared = often[word] > 1  # a quote of one code is in no intersection
    keys = np.sort(rank[word[shared]] << bits | code[shared])
    row = [[rows.column("app")[0].as_py()], [rows.column("slice")[0].as_py()], [list(at)], [sizes.tolist()], [len(keys)], [_packed(keys)]]
    return pa.table([pa.array(v, f.type) for v, f in zip(row, _schema(_COMPACT), strict=True)], schema=_schema(_COMPACT))


def _groups(names: list[str], rows: pa.Table) -> np.ndarray:
    """A number for each code, equal for like ones: those with a third of their entries told of among those of a leader, the largest code without a group."""
    at = {x: i for i, x in enumerate(names)}
    code, word, n_words = [], [], 0
    for own, packed in zip(rows.column("codes").to_pylist(), rows.column("words").to_pylist(), strict=True):
        if sum(map(len, code)) < _TOLD_ENTRIES:
            keys, bits = _unpacked(packed), _bits(len(own))
            code.append(np.array([at[x] for x in own], np.int64)[keys & ((1 << bits) - 1)])
            word.append((keys >> bits) + n_words)
            n_words += int(keys[-1] >> bits) + 1 if len(keys) else 0
    group = np.full(len(names), _LEADERS)
    if n_words:
        codes, words = np.concatenate(code), np.concatenate(word)
        lens = np.bincount(codes, minlength=len(names))
        for g in range(_LEADERS):
            left = np.where(group == _LEADERS, lens, 0)
            leader = int(left.argmax())
            if not left[leader]:
                break
            of_leader = np.zeros(n_words, bool)
            of_leader[words[codes == leader]] = True
            inside = np.bincount(codes[of_leader[words]], minlength=len(names))
            group[(left > 0) & (inside * 3 >= lens)] = g
    return group


def _place(chunk_entries: int, chunk_codes: int):
    kinds = _schema(_PLACED)

    def run(sizes: pa.Table, told: pa.Table) -> pa.Table:
        """Chunk and place of each code of an app."""
        names, n = sizes.column("code").to_pylist(), sizes.column("n").to_numpy()
        most = min(chunk_codes, max(SMALL_CHUNK, -(-len(names) // 8)))
        order = np.lexsort((np.array(names, object), n, _groups(names, told)))
        share = np.maximum(1 / most, n[order] / chunk_entries)
        _, chunk, counts = np.unique(np.floor(np.cumsum(share) - share + 1e-9).astype(np.int64), return_inverse=True, return_counts=True)
        place = np.arange(len(names)) - (np.cumsum(counts) - counts)[chunk]
        columns = [[sizes.column("app")[0].as_py()] * len(names), [names[i] for i in order], n[order], chunk, place]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    return run


class _Chunks:
    """The codes of all chunks, and the blocks, pairs of chunks of an app. Those without a pair of like sizes are left out."""

    def __init__(self, placed: pa.Table, part: int, whole: int) -> None:
        placed = placed.sort_by([("app", "ascending"), ("chunk", "ascending"), ("place", "ascending")])
        self.apps, self.codes = placed.column("app").to_pylist(), placed.column("code").combine_chunks()
        self.n, self.chunk, self.place = (placed.column(c).to_numpy() for c in ("n", "chunk", "place"))
        #: app, chunk, and range of its rows
        self.ranges = {(self.apps[i], int(self.chunk[i])): (i, j) for i, j in _runs(np.cumsum(self.place == 0))}
        size = {k: (int(self.n[i:j].min()), int(self.n[i:j].max()), int(self.n[i:j].sum())) for k, (i, j) in self.ranges.items()}
        of_app: dict[str, list[int]] = {}
        for app, c in self.ranges:
            of_app.setdefault(app, []).append(c)
        blocks = [
            (size[app, i][2] * size[app, j][2], app, i, j) for app, own in of_app.items() for i in own for j in own
            if i <= j and size[app, i][1] * whole >= size[app, j][0] * part and size[app, j][1] * whole >= size[app, i][0] * part
        ]
        #: the ones with most work first
        self.blocks = [b[1:] for b in sorted(blocks, key=lambda b: -b[0])]
        self.of: dict[tuple[str, int], list[int]] = {}
        for k, (app, i, j) in enumerate(self.blocks):
            for c in {i, j}:
                self.of.setdefault((app, c), []).append(k)


def _regroup(chunks):
    """Rows of apps and slices to rows of their chunks, with the numbers of the blocks of each: number of the quote above the place of the code."""
    kinds = _schema(_REGROUPED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = chunks.value
        at: dict[str, dict[str, int]] = {}
        for (app, _), (i, j) in c.ranges.items():
            at.setdefault(app, {}).update(zip(c.codes[i:j].to_pylist(), range(i, j), strict=True))
        for batch in batches:
            for row in batch.to_pylist():
                own = at[row["app"]]
                here = np.array([own[x] for x in row["codes"]], np.int64)
                keys, bits = _unpacked(row["words"]), _bits(len(here))
                code = here[keys & ((1 << bits) - 1)]
                chunk, keys = c.chunk[code], (keys >> bits) << _PLACE_BITS | c.place[code]
                order = np.argsort(chunk, kind="stable")
                chunk, keys = chunk[order], keys[order]
                for i, j in _runs(chunk):
                    of = c.of.get((row["app"], int(chunk[i])))
                    if of:
                        out = [[of], [int(chunk[i])], [row["slice"]], [_packed(np.sort(keys[i:j]))]]
                        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, kinds, strict=True)], schema=kinds)

    return run


class _Block:
    """The number of shared quotes of the codes of two chunks; of one chunk with itself, of places ``x < y`` only."""

    def __init__(self, rows: int, columns: int, same: bool) -> None:
        self.same = same
        self.counts = np.zeros((rows, columns), np.int32)
        self.a = np.zeros((rows, _PIECE), np.float32)
        self.b = self.a if same else np.zeros((columns, _PIECE), np.float32)
        self.used = 0

    def add(self, keys_a: np.ndarray, keys_b: np.ndarray) -> None:
        """Take in the entries of a slice, in the order of quotes."""
        mask = (1 << _PLACE_BITS) - 1
        word_a, word_b = keys_a >> _PLACE_BITS, keys_b >> _PLACE_BITS
        place_a, place_b = keys_a & mask, keys_b & mask
        n_words = int(max(word_a[-1], word_b[-1])) + 1
        of_a, of_b = np.bincount(word_a, minlength=n_words), np.bincount(word_b, minlength=n_words)
        dense = of_a * of_b > DENSE_SHARE * self.counts.size
        in_a, in_b = dense[word_a], dense[word_b]
        column = np.cumsum(dense) - 1
        sides = [(self.a, place_a[in_a], column[word_a[in_a]])] + [(self.b, place_b[in_b], column[word_b[in_b]])] * (not self.same)
        done, n_dense = 0, int(dense.sum())
        while done < n_dense:
            take = min(n_dense - done, _PIECE - self.used)
            for piece, places, columns in sides:
                lo, hi = np.searchsorted(columns, [done, done + take])
                piece[places[lo:hi], columns[lo:hi] + (self.used - done)] = 1
            done, self.used = done + take, self.used + take
            if self.used == _PIECE:
                self.flush()
        row, partners = place_a[~in_a], of_b[word_a[~in_a]]
        first_b = (np.cumsum(of_b) - of_b)[word_a[~in_a]]
        if self.same:  # those behind it
            behind = np.flatnonzero(~in_a) + 1
            partners, first_b = first_b + partners - behind, behind
        order = np.flatnonzero(partners)
        order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]  # a row of the matrix after the other
        self._pair(row[order], partners[order], first_b[order], place_b)

    def _pair(self, row: np.ndarray, partners: np.ndarray, first_b: np.ndarray, place_b: np.ndarray) -> None:
        upto = np.cumsum(partners)
        flat, start = self.counts.reshape(-1), 0
        base, shift = row * self.counts.shape[1], first_b - (upto - partners)
        while start < len(partners):
            before = int(upto[start] - partners[start])
            stop = max(start + 1, int(np.searchsorted(upto, before + _PAIRS_AT_ONCE, side="right")))
            times = partners[start:stop]
            at = np.arange(before, int(upto[stop - 1]))
            at += np.repeat(shift[start:stop], times)
            at = place_b[at]
            at += np.repeat(base[start:stop], times)
            np.add.at(flat, at, _ONE)  # a number of the same kind: others are converted one by one
            start = stop

    def flush(self) -> None:
        """Count the dense quotes taken in."""
        if self.used:
            a, b = self.a[:, : self.used], self.b[:, : self.used]
            for start in range(0, len(a), 1_024):
                left = start if self.same else 0
                self.counts[start:start + 1_024, left:] += (a[start:start + 1_024] @ b[left:].T).astype(np.int32)
            self.a.fill(0)
            self.b.fill(0)
            self.used = 0


def _pairs(app: str, block: _Block, codes_a: list[str], n_a: np.ndarray, codes_b: list[str], n_b: np.ndarray, part: int, whole: int, out: pa.Schema) -> Iterator[pa.RecordBatch]:
    block.flush()
    name_a, name_b = np.array(codes_a, object), np.array(codes_b, object)
    for start in range(0, len(n_a), 256):
        shared = block.counts[start:start + 256]
        x, y = np.nonzero((shared > 0) & (shared.astype(np.int64) * (whole + part) - n_b * part >= n_a[start:start + 256, None] * part))
        x += start
        if block.same:
            x, y = x[x < y], y[x < y]
        if len(x):
            a, b = name_a[x], name_b[y]
            swap = (a > b).astype(bool)
            columns = [
                pa.array([app] * len(x), pa.string()), pa.array(np.where(swap, b, a), pa.string()), pa.array(np.where(swap, a, b), pa.string()),
                pa.array(np.where(swap, n_b[y], n_a[x])), pa.array(np.where(swap, n_a[x], n_b[y])), pa.array(block.counts[x, y].astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=out)


def _count(part: int, whole: int, chunks):
    out = pa.schema([("app", pa.string()), ("code_a", pa.string()), ("code_b", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_shared", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, at, block, held = chunks.value, None, None, {}
        app, i, j = None, 0, 0

        def side(chunk: int) -> tuple[list[str], np.ndarray]:
            lo, hi = c.ranges[app, chunk]
            return c.codes[lo:hi].to_pylist(), c.n[lo:hi]

        def taken() -> None:
            if i in held and j in held:
                block.add(held[i], held[j])
            held.clear()

        at_slice = None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["_block"], row["slice"]) != (at, at_slice):
                    if block is not None:
                        taken()
                    if row["_block"] != at:
                        if block is not None:
                            yield from _pairs(app, block, *side(i), *side(j), part, whole, out)
                        at, block = row["_block"], None  # the old matrix goes before the new one comes
                        app, i, j = c.blocks[at]
                        (lo_a, hi_a), (lo_b, hi_b) = c.ranges[app, i], c.ranges[app, j]
                        block = _Block(hi_a - lo_a, hi_b - lo_b, i == j)
                    at_slice = row["slice"]
                held[row["chunk"]] = _unpacked(row["words"])
        if block is not None:
            taken()
            yield from _pairs(app, block, *side(i), *side(j), part, whole, out)

    return run


def compact_sets(codings: DataFrame) -> DataFrame:
    """The quote sets of ``app, code, quote``, a row for each app and slice of quotes. Rows without app, code or quote are left out."""
    full = codings.filter("app IS NOT NULL AND code IS NOT NULL AND quote IS NOT NULL")
    hashed = full.select("app", "code", F.xxhash64("quote").alias("_a"), F.xxhash64(F.lit("b"), "quote").alias("_b"))
    return hashed.mapInArrow(_deal, _SLICED).groupBy("app", "slice").applyInArrow(_number, _COMPACT)


def place_codes(sets: DataFrame, chunk_entries: int, chunk_codes: int) -> DataFrame:
    """``app, code, n, chunk, place`` of the codes of ``sets``, a table that is stored."""
    each = sets.select("app", F.explode(F.arrays_zip("codes", "n")).alias("_c"))
    sizes = each.groupBy("app", F.col("_c.codes").alias("code")).agg(F.sum("_c.n").alias("n"))
    told = sets.filter(F.col("slice") < _TOLD_SLICES).select("app", "codes", "words")
    return sizes.groupBy("app").cogroup(told.groupBy("app")).applyInArrow(_place(chunk_entries, min(chunk_codes, 1 << _PLACE_BITS)), _PLACED)


def pairs_over(codings: DataFrame, part: int, whole: int, chunk_entries: int = CHUNK_ENTRIES, chunk_codes: int = CHUNK_CODES) -> DataFrame:
    """``app, code_a, code_b, n_a, n_b, n_shared`` of pairs with ``n_shared / union >= part / whole``, a positive share."""
    sets = materialise(compact_sets(codings))
    chunks = _Chunks(place_codes(sets, chunk_entries, chunk_codes).toArrow(), part, whole)
    told = codings.sparkSession.sparkContext.broadcast(chunks)
    regrouped = sets.select("app", "slice", "codes", "words").mapInArrow(_regroup(told), _REGROUPED)
    tasks = min(max(1, len(chunks.blocks)), _MOST_TASKS)
    blocks = regrouped.select(F.explode("blocks").alias("_block"), "chunk", "slice", "words")
    placed = blocks.repartitionById(tasks, F.col("_block") % tasks).sortWithinPartitions("_block", "slice")
    return placed.mapInArrow(_count(part, whole, told), "app string, code_a string, code_b string, n_a long, n_b long, n_shared long")
