"""Codebooks of all batches, runs of batches, similar codes and partition hashes, against plain versions."""

import random
import tempfile
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from themeloom.operators import codebook as cb
from themeloom.operators import deductive as dd
from themeloom.operators import numbering, overlaps, quality
from themeloom.sources import tables as io

DECISIONS = "app string, batch_id long, seq int, type string, source_codes array<string>, target_codes array<string>"


def history(spark, seed=5):
    r = random.Random(seed)
    codes = [f"c{i}" for i in range(8)]
    codings = [("a", r.randrange(1, 40), r.choice(codes), f"q{i}") for i in range(150)] + [("a", None, "c0", "q"), ("b", 3, "c1", "q")]
    decisions = []
    for i in range(30):
        source, target = r.sample(codes, 2)
        kind = r.choice(["merge", "rename", "delete", "split"])
        targets = [] if kind == "delete" else [target] if kind != "split" else [target, r.choice(codes)]
        decisions.append(("a", r.randrange(1, 40), i, kind, [source], targets))
    return spark.createDataFrame(codings, "app string, batch_id long, code string, quote string"), spark.createDataFrame(decisions, DECISIONS)


@pytest.mark.parametrize("per_slot", [1, 3, 10_000])
def test_versions_hold_the_codebook_of_every_batch(spark, monkeypatch, per_slot):
    monkeypatch.setattr(numbering, "BATCHES_PER_SLOT", per_slot)
    codings, decisions = history(spark)
    versions = cb.codebook_versions(codings, decisions).collect()
    for b in (0, 1, 5, 17, 39, 100):
        got = {(v.app, v.code, v.since_batch) for v in versions if v.since_batch <= b and (v.until_batch is None or v.until_batch > b)}
        assert got == {tuple(r) for r in cb.codebook_as_of(codings.filter("batch_id IS NOT NULL"), decisions, b).collect()}


@pytest.mark.parametrize("per_slot", [1, 4, 10_000])
def test_codings_meet_the_state_of_their_batch(spark, monkeypatch, per_slot):
    monkeypatch.setattr(numbering, "BATCHES_PER_SLOT", per_slot)
    codings, decisions = history(spark, 6)
    rows = cb.codings_as_of(codings, decisions).collect()
    counts = {(r["app"], r["batch_id"], r["code"]): r["count"] for r in codings.filter("batch_id IS NOT NULL").groupBy("app", "batch_id", "code").count().collect()}
    assert {(r.app, r.batch_id, r.code): r.n_quotes for r in rows} == counts and len(rows) == len(counts)
    for b in {r.batch_id for r in rows}:
        active = {(v.app, v.code): v.since_batch for v in cb.codebook_as_of(codings.filter("batch_id IS NOT NULL"), decisions, b).collect()}
        for r in (r for r in rows if r.batch_id == b):
            assert r.active == ((r.app, r.code) in active)
            assert not r.active or r.since_batch == active[r.app, r.code]


@pytest.mark.parametrize("per_slot", [1, 2, 5, 10_000])
def test_islands(spark, per_slot):
    r = random.Random(per_slot)
    rows = [(g, i) for g in "xyz" for i in range(1, 60) if r.random() < 0.7] + [("w", 5), ("w", 6), ("w", 6)]
    got = sorted(tuple(x) for x in numbering.islands(spark.createDataFrame(rows, "g string, n long"), ["g"], "n", per_slot).collect())
    want = []
    for g, n in sorted(set(rows)):
        if want and want[-1][0] == g and want[-1][2] == n - 1:
            want[-1][2:] = [n, want[-1][3] + 1]
        else:
            want.append([g, n, n, 1])
    assert got == sorted(map(tuple, want))


def test_gap_islands_name_their_batches(spark):
    ordinals = spark.createDataFrame([("a", b, i) for i, b in enumerate([2, 4, 6, 8, 20, 21], 1)], "app string, batch_id long, ordinal long")
    gaps = [("a", b, "x") for b in (2, 4, 6, 20, 21)] + [("a", b, "y") for b in (6, 8, 20, 21, 21)]
    got = dd.gap_islands(spark.createDataFrame(gaps, "app string, batch_id long, label string"), ordinals).collect()
    assert sorted(map(tuple, got)) == [("a", "x", 2, 6, 3), ("a", "y", 6, 21, 4)]


@pytest.mark.parametrize(("part", "whole"), [(1, 2), (4, 5), (1, 1), (1, 10)])
def test_similar_codes_equal_brute_force(spark, part, whole):
    r = random.Random(part * 31 + whole)
    sets = {("a", f"k{i}"): {f"q{r.randrange(60)}" for _ in range(r.randrange(1, 25))} for i in range(30)}
    base = [f"s{i}" for i in range(20)]
    sets |= {("a", f"s{i}"): set(base[: 20 - i]) for i in range(6)} | {("b", "s0"): set(base)}
    rows = [(a, c, q) for (a, c), qs in sets.items() for q in qs] + [("a", "k1", min(sets["a", "k1"])), ("a", None, "s1"), ("a", "k2", None)]
    got = quality.similar_codes(spark.createDataFrame(rows, "app string, code string, quote string"), part, whole).collect()
    want = {(a, x, y, len(sets[a, x] & sets[a, y])) for a, x in sets for b, y in sets
            if a == b and x < y and whole * len(sets[a, x] & sets[a, y]) >= part * len(sets[a, x] | sets[a, y]) and sets[a, x] & sets[a, y]}
    assert {(p.app, p.code_a, p.code_b, p.n_shared) for p in got} == want and len(got) == len(want)


def test_prefixes_leave_few_candidates(spark):
    """Codes that share only a common quote never meet; a threshold of 0 is refused."""
    rows = [("a", f"c{i}", f"own{i}-{j}") for i in range(60) for j in range(10)] + [("a", f"c{i}", "common") for i in range(60)]
    rows += [("a", "twin", f"own0-{j}") for j in range(10)]
    codings = spark.createDataFrame(rows, "app string, code string, quote string")
    sets = codings.select("app", "code", F.unhex(F.md5("quote")).alias("_q")).distinct()
    found = quality.similar_candidates(sets, 4, 5).collect()
    assert [(r.code_a, r.code_b) for r in found] == [("c0", "twin")]
    with pytest.raises(ValueError, match="positive"):
        quality.similar_codes(codings, 0, 5)


def hashes(spark, rows, schema="a string, b string"):
    return io.table_hash(spark.createDataFrame(rows, schema), "t").first()["sha256"]


def test_no_content_passes_for_another_row(spark):
    pairs = [([("a\x1f=b", "c")], [("a", "b\x1f=c")]), ([("1:x", "")], [("", "1:x")]), ([(None, "a")], [("-", "a")]), ([("ab", "c")], [("a", "bc")]), ([("a", None)], [(None, "a")])]
    for x, y in pairs:
        assert hashes(spark, x) != hashes(spark, y)
    assert hashes(spark, [("a", "b")]) != hashes(spark, [("a", "b")], "a string, c string")
    assert hashes(spark, [("a", "b"), ("c", "d")]) == hashes(spark, [("c", "d"), ("a", "b")])


def test_manifest_tells_which_partitions_changed(spark):
    old = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), (None, 5), ("gone", 1)], "k string, v int")
    new = spark.createDataFrame([("x", 2), ("x", 1), ("y", 2), (None, 6), ("new", 1)], "k string, v int").repartition(3)
    a, b = io.partition_hashes(old, "t", "k"), io.partition_hashes(new, "t", "k")
    changed = {(r.part, r.change) for r in io.changed_partitions(a, b).collect()}
    assert changed == {("y", "changed"), (None, "changed"), ("gone", "removed"), ("new", "added")}
    root = {x: io.root_hash(p).first() for x, p in (("a", a), ("b", b), ("c", io.partition_hashes(old.repartition(4), "t", "k")))}
    assert root["a"]["sha256"] == root["c"]["sha256"] != root["b"]["sha256"]
    assert (root["a"]["n_parts"], root["a"]["n_rows"]) == (4, 5)


def test_every_sink_writes_the_manifest(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    manifest = io.run_manifest(io.table_hash(spark.range(3).toDF("n"), "n"), {"seed": 1}, "v")
    codes = spark.createDataFrame([("a", "k", "q")], "app string, code string, quote string")
    entries = spark.createDataFrame([("a", 0, 1, "[ID:1] [rating:2] x")], "app string, batch_id long, global_seq long, entry string")
    log = spark.createDataFrame([("a", "1", 1, 0, "r")], "app string, name string, global_seq long, batch_id long, run_id string")
    unused = spark.createDataFrame([("a", "1", "2", "x")], "app string, name string, rating string, review string")
    sinks = {
        "codebook": lambda p: io.write_codebook_csv(codes, p, manifest=manifest), "dictionary": lambda p: io.export_dictionary(codes, p, manifest=manifest),
        "batches": lambda p: io.write_batches(entries, p, manifest=manifest), "log": lambda p: io.append_log(log, p, manifest),
        "unused": lambda p: io.write_unused(unused, p, manifest=manifest),
        "prompts": lambda p: io.write_prompts(codes.withColumns({"stage": F.lit("s"), "batch_id": F.lit(1)}), p, manifest),
    }
    hashes = defaultdict(set)
    for name, write in sinks.items():
        write(f"{folder}/{name}")
        hashes[io.read_manifest(spark, f"{folder}/{name}").first()["source_hash"]].add(name)
    assert list(hashes.values()) == [set(sinks)]


@pytest.mark.parametrize("size", [dict(), dict(chunk_codes=70), dict(chunk_entries=3_000)])
def test_codes_on_common_quotes_are_counted_in_blocks(spark, size):
    """Nearly all codes share quotes: pairs are counted exactly where they meet, and no join writes them out."""
    r = random.Random(5)
    sets = {(a, f"{'é' if i % 9 == 0 else 'k'}{i}"): {f"q{j}" for j in range(90) if r.random() < (0.8 if j < 10 else i % 4 / 10)} | {f"own{i}"} for a in "ab" for i in range(200 if a == "a" else 5)}
    rows = [(a, c, q) for (a, c), qs in sets.items() for q in qs] * 2
    codings = spark.createDataFrame(rows, "app string, code string, quote string").repartition(3)
    found = overlaps.pairs_over(codings, 1, 5, **size)
    keys = sorted(sets)
    want = {(a, x, y, len(sets[a, x]), len(sets[a, y]), n) for a, x in keys for b, y in keys
            if a == b and x < y and (n := len(sets[a, x] & sets[a, y])) and 5 * n >= len(sets[a, x] | sets[a, y])}
    got = [tuple(p) for p in found.collect()]
    assert set(got) == want and len(got) == len(want)
    assert "Join" not in quality.similar_codes(codings, 1, 5)._jdf.queryExecution().executedPlan().toString()


def _brute_pairs(sets, part, whole):
    return {(x, y, n) for x in sets for y in sets if x < y and (n := len(sets[x] & sets[y])) and whole * n >= part * len(sets[x] | sets[y])}


def test_like_codes_share_chunks_and_sets_of_unlike_sizes_never_meet(spark):
    """Two vocabularies and two sizes: chunks hold like codes, the blocks of small and large sets are left out, and all pairs are there."""
    r = random.Random(8)
    sets = {f"{v}{k}{i}": {f"{v}q{j}" for j in r.sample(range(1000), k)} for v in "ab" for k in (40, 700) for i in range(50)}
    codings = spark.createDataFrame([("a", c, q) for c, qs in sets.items() for q in qs], "app string, code string, quote string")
    placed = overlaps.place_codes(overlaps.compact_sets(codings), 10**6, 25)
    chunks = overlaps._Chunks(placed.toArrow(), 1, 5)
    assert {len({c[0] for c in chunks.codes[i:j].to_pylist() if "700" in c}) for i, j in chunks.ranges.values()} <= {0, 1}
    assert len(chunks.blocks) < len(chunks.ranges) * (len(chunks.ranges) + 1) / 2
    got = [(p.code_a, p.code_b, p.n_shared) for p in overlaps.pairs_over(codings, 1, 5, chunk_codes=25).collect()]
    assert set(got) == _brute_pairs(sets, 1, 5) and len(got) == len(set(got))


@pytest.mark.parametrize("same", [True, False])
def test_shared_quotes_are_counted_densely_and_pair_by_pair(monkeypatch, same):
    """Frequent quotes fill several pieces, rare ones several steps of pairs; a chunk with itself counts each pair once."""
    monkeypatch.setattr(overlaps, "_PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(overlaps, "_PIECE", 64)
    r = np.random.default_rng(2)
    share = np.where(np.arange(500) < 200, 0.7, 0.03)
    a = r.random((40, 500)) < share
    b = a if same else r.random((30, 500)) < share
    monkeypatch.setattr(overlaps, "DENSE_SHARE", 0.1)
    block = overlaps._Block(len(a), len(b), same)
    for start in (0, 100, 350):
        stop = {0: 100, 100: 350, 350: 500}[start]
        keys = [np.sort([int(w) << 16 | int(c) for c, w in zip(*np.nonzero(x[:, start:stop]), strict=True)]) for x in (a, b)]
        block.add(*[overlaps._unpacked(overlaps._packed(k)) for k in keys])
    block.flush()
    want = a.astype(int) @ b.T.astype(int)
    upper = np.triu(np.ones_like(want, dtype=bool), 1) if same else np.ones_like(want, dtype=bool)
    assert (block.counts[upper] == want[upper]).all()


def test_quotes_of_one_first_hash_stay_apart():
    """Quotes are told apart by both hashes, also where rows of equal first ones lie mixed, and duplicates count once."""
    kinds = overlaps._schema(overlaps._SLICED)
    hashes = np.array([7, 7, 7, 7], np.uint64).tobytes(), np.array([1, 2, 1, 2], np.uint32).tobytes()
    rows = pa.table([pa.array(v, f.type) for v, f in zip([["a"] * 2, [0] * 2, [["x", "y"]] * 2, [[3, 1]] * 2, [hashes[0]] * 2, [hashes[1]] * 2], kinds, strict=True)], schema=kinds)
    row = overlaps._number(rows).to_pylist()[0]
    assert (row["codes"], row["n"], row["n_words"]) == (["x", "y"], [2, 1], 2)
    wide = np.array([1, 5, 1 << 40, (1 << 40) + 3])
    assert overlaps._unpacked(overlaps._packed(wide)).tolist() == wide.tolist() and not len(overlaps._unpacked(overlaps._packed(wide[:0])))
