"""Manifest, archive and periodic runs against plain versions, and on nulls, empty tables, repeated rows and clashing columns."""

from __future__ import annotations

import random

import brute_records as brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from pyspark.sql import functions as F

from llm import merkle, periodic, warc
from llm.words import words_of


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(got, want):
    assert got == sorted(want, key=repr)


# 11 Merkle manifest

PROOF = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
FIELDS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.select(*FIELDS).collect()]


def test_manifest_equals_brute_force(docs):
    same(table(merkle.digests(docs), *PROOF), brute.manifest(rows_of(docs)))


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_stretches_of_any_height_give_the_same_proofs(make, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "SPAN", 1 << levels)
    docs = make([(i * 7 % 301, f"text {i}") for i in range(301)])
    docs = docs.withColumn("lang", F.expr("CASE WHEN doc_id < 3 THEN null WHEN doc_id < 4 THEN 'é' WHEN doc_id % 50 = 0 THEN concat('l', doc_id) ELSE 'en' END"))
    same(table(merkle.digests(docs), *PROOF), brute.manifest(rows_of(docs)))


def test_manifest_of_one_row_one_language_and_none(make, nothing):
    for rows in [[(5, "a")], [(i, "b") for i in range(0, 12, 3)]]:
        docs = make(rows).withColumn("lang", F.lit("en"))
        same(table(merkle.digests(docs), *PROOF), brute.manifest(rows_of(docs)))
    empty = merkle.digests(nothing)
    assert empty.columns == PROOF and empty.count() == 0


def test_manifest_of_nulls_repeats_long_texts_and_clashing_columns(spark):
    rows = [
        (None, None, None, None, None), (None, "x", None, "s", 1), (None, "x", None, "s", 1), (3, "", "", "", 0), (3, "", "", "", 0), (3, "other", "", "", 5),
        (24, "é" * 200_000, "=", None, 200_000), (11, "a", "^", "b", None), (12, "-", "-", "-", 7), (13, "1:a", "en", "2", -4),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    wide = docs.withColumns({c: F.lit(7) for c in ("tree", "pos", "leaf", "start", "home", "_file", "_row", "hash", "changed")})
    same(table(merkle.digests(wide), *PROOF), brute.manifest(rows))


def test_recursion_is_not_cut_at_the_row_limit(spark, make):
    key = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(key, "100")
    try:
        docs = make([(i, str(i)) for i in range(500)])
        same(table(merkle.digests(docs), *PROOF), brute.manifest(rows_of(docs)))
    finally:
        spark.conf.unset(key)


def test_other_tables_are_checked_against_a_stored_manifest(make):
    """What a user does: keep the manifest, verify a later copy of the table."""
    docs = make([(i, f"text {i}") for i in range(40)]).withColumn("lang", F.lit("en"))
    leaves = merkle.leaves_of(docs, F.lit(0))
    nodes = merkle.manifest(leaves.select("tree", "pos", F.col("leaf").alias("hash")))
    later = docs.withColumn("text", F.expr("if(doc_id = 7, 'changed', text)"))
    now = later.select("doc_id", merkle.leaf_hash().alias("_now"))
    found = merkle.proofs(leaves.join(now, "doc_id").withColumn("start", F.col("_now")).drop("_now"), nodes)
    assert [r.doc_id for r in found.filter("folded_root <> root").collect()] == [7]


def test_positions_within_groups(spark):
    rows = spark.range(1000).select(F.expr("if(id % 10 = 0, 'a', 'b')").alias("g"), (F.col("id") * 37 % 1000).alias("k")).repartition(7)
    got = merkle.in_order(rows, "g", "k").collect()
    for g in "ab":
        mine = sorted((r.k, r.pos) for r in got if r.g == g)
        assert [p for _, p in mine] == list(range(len(mine)))


# 12 WARC

PAGE = "page_id bigint, url string, html string"
CAPTURED = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
PAGES = [
    (None, None, None), (1, "http://u:p@Host.com:80/a b\r\nX: y#f", ""), (2, "http://a.b", "é" * 9_000_000), (2, "http://a.b", "x"), (2, "http://a.b", "x"),
    (2, "http://a.b#top", "x"), (None, "nonsense\n", "x"), (5, "http://1.2.3.4/?q", "x"), (4, "http://a.b/", ""), (9, "http://a.b", "q"), (9, "http://a.b", "r\r\n\r\n"),
]


def test_archive_equals_brute_force(spark):
    same(table(warc.digests(spark.createDataFrame(PAGES, PAGE)), *CAPTURED), brute.archive(PAGES))
    assert warc.digests(spark.createDataFrame([], PAGE)).count() == 0


def test_archive_with_small_blocks_files_and_clashing_columns(spark, monkeypatch):
    r = random.Random(3)
    rows = [(i, f"http://h{r.randrange(4)}.example.com/{r.randrange(50)}", f"body {r.randrange(200)}" * 30) for i in range(600)]
    rows += [(1000 + i, "http://hot.example.com/", "hot") for i in range(400)]
    for name, value in (("BLOCK", 7), ("ARCHIVE_BYTES", 5000), ("READ", 2000), ("STRETCH_BYTES", 3000)):
        monkeypatch.setattr(warc, name, value)
    pages = spark.createDataFrame(rows, PAGE).withColumns({c: F.lit(1) for c in ("key", "file", "start", "size", "_hash", "_n", "_first", "exact", "refers_to")})
    same(table(warc.digests(pages.repartition(5)), *CAPTURED), brute.archive(rows))


def test_small_payloads_are_always_responses(spark, tmp_path):
    rows = [(1, "http://a/", "ab"), (2, "http://b/", "ab"), (3, "http://c/", "abcdef"), (4, "http://d/", "abcdef"), (5, None, None), (6, None, None)]
    pages = spark.createDataFrame(rows, PAGE)
    folder, index = warc.archive(pages, f"file:{tmp_path}/w", min_bytes=3)
    wanted = pages.select("url", "page_id", F.lit(True).alias("exact"))
    same(table(warc.read_records(warc.look_up(wanted, index, folder), folder), *CAPTURED), brute.archive(rows, 3))


def test_look_up_by_url_returns_all_captures_and_payloads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 3)
    rows = [(i, f"https://www.example.com/p{i % 5}#{i}", f"text {i}") for i in range(60)] + [(99, "http://other.org", "text 1")]
    pages = spark.createDataFrame(rows, PAGE).repartition(4)
    folder, index = warc.archive(pages, str(tmp_path / "w"))
    wanted = spark.createDataFrame([("http://www.example.com/p3", None, False), ("http://other.org/", None, False), ("http://none.org/", None, False), ("https://www.example.com/p4", 3, True)], "url string, page_id bigint, exact boolean")
    got = warc.read_records(warc.look_up(wanted, index, folder), folder).collect()
    assert sorted((r.page_id, r.payload and bytes(r.payload).decode()) for r in got) == [(i, f"text {i}") for i in range(3, 60, 5)] + [(99, None)]
    assert {r.page_id: r.refers_to for r in got}[99] == 1
    assert index.agg(F.sum("captures")).first()[0] == 61


def test_archives_are_plain_gzip_members(spark, tmp_path):
    import gzip

    folder, _ = warc.archive(spark.createDataFrame([(1, "http://a/", "one"), (2, "http://b/", "one")], PAGE).coalesce(1), str(tmp_path / "w"))
    names = [f.path for f in fs.LocalFileSystem().get_file_info(fs.FileSelector(folder)) if f.path.endswith(".warc.gz")]
    text = b"".join(gzip.open(n).read() for n in names)
    assert text.count(b"WARC/1.1\r\n") == len(names) + 2 and text.count(b"WARC-Type: revisit") == 1 and text.endswith(b"\r\n\r\n")


def test_damaged_records_are_found():
    raw = warc.record(1, "http://a/", b"payload", None, False)
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw.replace(b"\r\n\r\npayload", b"\r\n\r\npayl0ad"))


@pytest.mark.parametrize(("url", "key"), [
    ("http://www.Example.com:8080/a?b#c", "com,example,www:8080)/a?b"), ("https://me:pw@a.b.", "b,a)/"), ("http://10.0.0.1/x", "10.0.0.1)/x"), ("no url", "no url"), (None, ""),
])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


# 13 periodic runs

RUN = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def by_tiles(w, core):
    """Runs from the fragments of all tiles of a text, stitched."""
    h, n = words_of(pa.array([" ".join(w)])).hashes(), len(w)
    found = {s for o, first, end, lo, hi in periodic.tiles(n, core) for s in periodic.solve([h[lo:hi]], o, first, end, n, lo)}
    whole = []
    for q, a, b, _ in sorted(found):
        if whole and whole[-1][0] == q and a <= whole[-1][2]:
            whole[-1][2] = max(whole[-1][2], b)
        else:
            whole.append([q, a, b])
    return sorted(((a, b - a + q, q) for q, a, b in whole if b - a >= periodic.need(q)), key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([24, 40, 90, 200, 500]), st.sampled_from([1, 2, 3, 9]), st.sampled_from([8, 16, 64, 4096]))
def test_tiles_give_all_runs(seed, n, letters, core):
    r = random.Random(seed)
    w = [str(r.randrange(letters)) for _ in range(n)]
    for _ in range(r.randrange(3)):
        p, a = r.randrange(1, n // 3 + 1), r.randrange(n)
        w[a:] = [w[a + (i - a) % p] if a + (i - a) % p < n else w[i] for i in range(a, n)]
    assert by_tiles(w, core) == brute.runs(w)


def test_strings_full_of_repeats():
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    thue = [str(bin(i).count("1") % 2) for i in range(1024)]
    for w in (list(b), thue, ["a"] * 700, ["a", "b"] * 350, (["a"] * 30 + ["b"]) * 20, thue[:40] * 20):
        for core in (16, 4096):
            assert by_tiles(w, core) == brute.runs(w)


def cases():
    r = random.Random(8)
    base = [str(r.randrange(50)) for _ in range(400)]
    texts = [" ".join(base[: r.randrange(400)] + base[100 : 100 + (p := r.randrange(1, 90))] * r.randrange(1, 9)) + f" {p}" for _ in range(60)]
    return [(i, t) for i, t in enumerate([None, "", " \n", "one", "a " * 23, "a " * 24, "a " * 500, "a b " * 12, " ".join(map(str, range(7))) + " x" * 30, *texts])]


@pytest.mark.parametrize(("spread", "core"), [(periodic.SPREAD, periodic.CORE), (periodic.SPREAD, 16), (100, 32)])
def test_runs_of_documents(make, monkeypatch, spread, core):
    monkeypatch.setattr(periodic.with_runs, "__defaults__", (spread, core, False))
    rows = cases()
    same(table(periodic.digests(make(rows).repartition(3)), *RUN), brute.periodic(rows))


def test_runs_equal_brute_force(docs, rows):
    same(table(periodic.digests(docs), *RUN), brute.periodic(rows))


def test_runs_of_repeated_rows_null_ids_long_texts_and_clashing_columns(make, nothing):
    r = random.Random(2)
    long = " ".join([str(r.randrange(3000)) for _ in range(7000)] * 3 + ["end"] * 4000)
    rows = [(None, "a b c " * 20), (None, "a b c " * 20), (None, "d " * 30), (1, "a b c " * 20), (1, "a b c " * 20), (1, "d " * 30), (2, None), (3, long)]
    wide = make(rows).withColumns({c: F.lit(3) for c in ("text_hash", "runs", "period", "start", "stop", "_id", "_hash", "plain", "octave", "words", "n_words")})
    same(table(periodic.digests(wide), *RUN), brute.periodic(rows))
    assert periodic.digests(nothing).count() == 0


def test_runs_and_collapsed_text_of_the_operator(make):
    rows = [(4, "x  y\n" + "a b c " * 10 + "z"), (5, "no run"), (6, None)]
    got = {r.doc_id: r for r in periodic.with_runs(make(rows)).collect()}
    assert [tuple(x) for x in got[4].runs] == [(2, 30, 3)] and got[4].collapsed == "x y a b c z" and got[4].n_words == 33
    assert got[5].runs == [] and got[5].collapsed == "no run" and got[6].collapsed == "" and got[6].n_words == 0


def test_a_run_over_many_tiles_is_a_row_a_tile(make):
    pieces = periodic.cut(make([(1, "a b " * 5000)]), core=256)
    assert pieces.select(F.sum(F.size("stretches"))).first()[0] <= 10_000 // 256 + 1
    dealt = periodic.cut(make([(1, "a b " * 5000)]), spread=100, core=256)
    assert dealt.filter("octave IS NOT NULL").count() > 100
    assert periodic.find_runs(dealt).select("start", "length", "period").collect() == [(0, 10_000, 2)]


def test_primitive_words():
    w = np.array([1, 2, 1, 2, 1, 2, 3, 1, 1, 1, 1, 1, 1, 1, 5, 6], np.uint64)
    levels = [w]
    for j in range(3):
        levels.append(periodic.double(levels[-1], 1 << j))
    at, q = np.array([0, 0, 0, 7, 7, 6]), np.array([4, 6, 7, 6, 1, 7])
    assert periodic.primitive(levels, at, q).tolist() == [False, False, True, False, True, True]
