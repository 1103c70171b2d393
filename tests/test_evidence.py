"""Quality evidence, codebook evolution, deductive matching and prompts on small fixtures."""

import json
import re

import pytest

from themeloom import schemas
from themeloom.functions import fixed
from themeloom.operators import codebook as cb
from themeloom.operators import deductive as dd
from themeloom.operators import prompts as pr
from themeloom.operators import quality as ql
from themeloom.plans import bindings as b
from themeloom.plans.queries import QUERIES

CODINGS = "app string, batch_id long, theme string, code string, quote string"


def _c(spark, rows):
    return spark.createDataFrame([("a", *r) for r in rows], CODINGS)


def _set(df):
    return {tuple(r) for r in df.collect()}


# --- quality ------------------------------------------------------------------------------------

def test_verbatim_and_coverage(spark):
    reviews = spark.createDataFrame(
        [("a", 0, "n1", "晚上排队要等半个小时"), ("a", 0, "n2", "音乐好听"), ("a", 1, "n3", "排队太久")],
        "app string, batch_id long, name string, review_norm string")
    quotes = spark.createDataFrame([("a", 0, "排队要等半个小时"), ("a", 0, "排队太久"), ("a", 1, "排队太久")], "app string, batch_id long, quote string")
    src = ql.quote_sources(quotes, reviews)
    assert _set(src) == {("a", 0, "n1", "排队要等半个小时"), ("a", 1, "n3", "排队太久")}
    assert _set(ql.altered_quotes(quotes, src)) == {("a", 0, "排队太久")}
    assert ql.verbatim_quotes(quotes, src).count() == 2
    assert _set(ql.uncoded_reviews(reviews, src)) == {("a", 0, "n2")}
    scope = spark.createDataFrame([("a", "n2")], "app string, name string")
    assert ql.uncoded_reviews(reviews, src, scope).isEmpty()


def test_quotes_by_sources_of_their_own_batch(spark):
    """Rows stay as often as they come; a quote found in another batch counts as altered, and so does one without app, batch or text."""
    rows = [("a", 0, "x"), ("a", 0, "x"), ("a", 1, "x"), ("a", 0, "y"), ("b", 0, "x"), (None, 0, "x"), ("a", None, "x"), ("a", 0, None), ("c", 5, "z")]
    found = [("a", 0, "n", "x"), ("a", 0, "m", "x"), ("a", 2, "n", "y"), (None, 0, "n", "x"), ("a", None, "n", "x"), ("a", 0, "n", None)]
    quotes = spark.createDataFrame(rows, "app string, batch_id long, quote string")
    sources = spark.createDataFrame(found, "app string, batch_id long, name string, quote string")
    assert [tuple(r) for r in ql.verbatim_quotes(quotes, sources).collect()] == [("a", 0, "x")] * 2
    assert sorted(map(str, map(tuple, ql.altered_quotes(quotes, sources).collect()))) == sorted(map(str, rows[2:]))
    assert ql.altered_quotes(quotes, sources.limit(0)).count() == len(rows) and ql.altered_quotes(quotes, sources).schema == quotes.schema


def test_filed_quotes_are_moved_once(spark, tmp_path):
    """The quotes are cut and dealt to their batches once, for the search and for what it leaves, and only hashes come back from it."""
    texts = ["One here. Two here. ab", "Two here. Two here.Three  here", None, "...", "One here"]
    docs = [(i if i != 3 else None, f"src{i}", "en", 10, texts[i % len(texts)]) for i in range(120)]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    filed = b.filed_quotes(spark, str(tmp_path))
    own = {(r.app, r.batch_id, r.quote) for r in b.codings(spark, str(tmp_path)).collect()}
    assert sorted(map(tuple, filed.collect())) == sorted({(a, n + k, q) for a, n, q in own for k in (0, 1)})
    altered = QUERIES["j4_altered_quotes"](spark, str(tmp_path))
    assert _set(altered) == {(a, n + 1, q) for a, n, q in own if (a, n + 1, q) not in own}
    plan = altered._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and not re.search(r"hashpartitioning\([^)]*quote", plan)


@pytest.mark.parametrize("same,total,band", [(18, 20, "stable"), (17, 20, "mild_drift"), (14, 20, "mild_drift"), (13, 20, "severe_drift")])
def test_gold_bands(spark, same, total, band):
    rows = [("a", f"n{i}", "first", "x") for i in range(total)] + [("a", f"n{i}", "repeat", "x" if i < same else "y") for i in range(total)]
    r = ql.gold_agreement(spark.createDataFrame(rows, "app string, name string, run string, code string")).first()
    assert (r["n_same"], r["band"]) == (same, band) and r["mean_jaccard"] == pytest.approx(same / total)


def test_gold_missing_side_and_extra_code(spark):
    rows = [("a", "1", "first", "x"), ("a", "1", "repeat", "x"), ("a", "1", "repeat", "y"), ("a", "2", "first", "x")]
    r = ql.gold_agreement(spark.createDataFrame(rows, "app string, name string, run string, code string")).first()
    assert (r["n_reviews"], r["n_same"], r["mean_jaccard"]) == (2, 0, 0.25)


def test_drift(spark):
    c = _c(spark, [(0, "t", "x", "q"), (1, "t", "y", "q"), (0, "t", "x", "r"), (0, "t", "y", "r"), (1, "t", "x", "r"), (1, "t", "y", "r"), (0, "t", "x", "s")])
    assert _set(ql.drifting_quotes(c)) == {("a", "q", 2, 2, 2)}


def test_overlap(spark):
    c = _c(spark, [(0, "t", k, q) for k, qs in {"x": "abc", "y": "bcd", "z": "e", "w": "bc"}.items() for q in qs])
    got = {(r["code_a"], r["code_b"]): (r["n_shared"], r["jaccard"]) for r in ql.overlapping_codes(c).collect()}
    assert got == {("x", "y"): (2, 0.5), ("w", "x"): (2, 2 / 3), ("w", "y"): (2, 2 / 3)}
    assert ql.overlapping_codes(c, 0.6).count() == 2


def test_theme_rules(spark):
    c = _c(spark, [(0, "甲", "甲", "q"), (0, "甲", "x", "q"), (0, "甲", "y", "q"), (0, "乙", "x", "q")])
    got = {r["theme"]: (r["n_codes"], r["codes_in_range"], r["theme_used_as_code"]) for r in ql.theme_shape(c).collect()}
    assert got == {"甲": (3, True, True), "乙": (1, False, False)}


def test_scope_warning_edge(spark):
    rows = [("a", 0, i < 1) for i in range(4)] + [("a", 1, i < 2) for i in range(4)]
    got = {r["batch_id"]: r["warn"] for r in ql.scope_rate(spark.createDataFrame(rows, "app string, batch_id long, out_of_scope boolean")).collect()}
    assert got == {0: False, 1: True}


def test_completeness(spark):
    book = spark.createDataFrame([
        ("a", "v", "t", "x", "def", ["i"], ["e"], ["q1", "q2", "q3"], None),
        ("a", "v", "t", "y", " ", ["i"], [], ["q1", "nope"], None), ("a", "v", "t", "z", None, None, None, None, None)], schemas.CODEBOOK)
    c = _c(spark, [(0, "t", "x", q) for q in ("q1", "q2", "q3")] + [(0, "t", "y", "q1")])
    got = {r["code"]: tuple(r)[3:] for r in ql.codebook_completeness(book, c).collect()}
    assert got == {"x": (True, True, 3, True, 0), "y": (False, False, 2, False, 1), "z": (False, False, 0, False, 0)}


# --- codebook -----------------------------------------------------------------------------------

def _decisions(spark, *rows):
    return spark.createDataFrame([("a", b, s, t, src, tgt, None, None) for b, s, t, src, tgt in rows], schemas.DECISIONS)


def test_canonical_chain_delete_split_revival(spark):
    d = _decisions(
        spark, (1, 1, "merge", ["等待过长", "排队久"], ["等候问题"]), (2, 1, "rename", ["等候问题"], ["等候"]), (3, 1, "rename", ["等候"], ["久"]),
        (4, 1, "rename", ["久"], ["漫长"]), (2, 2, "delete", ["总体感受"], []), (2, 3, "split", ["音效问题"], ["背景音乐", "按键声音"]),
        (5, 1, "merge", ["杂项"], ["音效问题x"]), (6, 1, "split", ["音效问题x"], ["p", "q"]), (1, 5, "rename", ["旧"], ["新"]), (3, 5, "rename", ["新"], ["旧"]),
        (7, 1, "merge", ["A", "B"], ["A"]))
    got = {r["code"]: (r["canonical"], r["status"]) for r in cb.canonical_map(d).collect()}
    slow = ("漫长", "mapped")
    assert got == {
        "等待过长": slow, "排队久": slow, "等候问题": slow, "等候": slow, "久": slow, "总体感受": (None, "deleted"), "音效问题": (None, "split"),
        "音效问题x": (None, "split"), "杂项": (None, "split"), "新": ("旧", "mapped"), "B": ("A", "mapped")}
    c = _c(spark, [(9, "t", "排队久", "q"), (9, "t", "总体感受", "q"), (9, "t", "别的", "q")])
    assert {(r["canonical"], r["status"]) for r in cb.canonicalise(c, cb.canonical_map(d)).collect()} == {
        ("漫长", "mapped"), ("总体感受", "deleted"), ("别的", "kept")}


def test_revived_codes(spark):
    d = _decisions(spark, (1, 1, "merge", ["x"], ["y"]), (3, 1, "rename", ["z"], ["x"]))
    c = _c(spark, [(b, "t", "x", "q") for b in range(6)])
    assert {r["batch_id"] for r in cb.revived_codes(c, d).collect()} == {2, 3}


def test_as_of(spark):
    d = _decisions(spark, (2, 1, "merge", ["x"], ["y"]))
    c = _c(spark, [(0, "t", "x", "q"), (5, "t", "late", "q")])
    assert {r["code"] for r in cb.codebook_as_of(c, d, 1).collect()} == {"x"}
    assert {r["code"] for r in cb.codebook_as_of(c, d, 4).collect()} == {"y"}


def test_upsert(spark):
    s = "app string, code string, batch_id long, seq int, deleted boolean, definition string"
    cur = spark.createDataFrame([("a", "x", 0, 0, False, "old"), ("a", "y", 0, 0, False, "old"), ("a", "k", 0, 0, False, "kept")], s)
    chg = spark.createDataFrame([("a", "x", 1, 0, False, "mid"), ("a", "x", 1, 1, False, "new"), ("a", "y", 1, 0, True, None), ("a", "z", 1, 0, False, "add")], s)
    assert {(r["code"], r["definition"]) for r in cb.upsert_codebook(cur, chg).collect()} == {("x", "new"), ("k", "kept"), ("z", "add")}


def test_change_log(spark):
    batch = {"batch_id": 1, "timestamp": "2026-04-16T14:30:00", "codebook_version": "v0.2", "themes": ["甲"], "changes": [
        {"type": "initial", "themes": ["甲"], "codes_count": 15, "reason": "r"}, {"type": "add", "code": "x", "theme": "甲"},
        {"type": "merge", "source_codes": ["a", "b"], "target_code": "c", "theme": "甲"}]}
    docs = spark.createDataFrame([("one", json.dumps(batch)), ("all", json.dumps({"batches": [batch]})), ("none", '{"batches": []}')], "app string, json string")
    changes = cb.read_change_log(docs)
    assert changes.count() == 6
    r = cb.change_matrix(changes.filter("app = 'one'")).first()
    assert (r["n_initial"], r["n_add"], r["n_merge"], r["n_delete"]) == (1, 1, 1, 0)
    assert {(x["type"], x["n_initial_codes"]) for x in cb.change_counts(changes).filter("app = 'all'").collect()} == {("initial", 15), ("add", 0), ("merge", 0)}


# --- deductive ----------------------------------------------------------------------------------

def test_dictionary_and_fallback(spark):
    reviews = spark.createDataFrame([("a", 0, "1", "外挂太多 打不过"), ("a", 0, "2", "很好"), ("b", 0, "1", "外挂")], "app string, batch_id long, name string, review_norm string")
    terms = spark.createDataFrame([("a", "作弊", "外挂"), ("a", "难度", "打不过"), ("a", "作弊", "挂")], schemas.DICTIONARY)
    m = dd.match_dictionary(reviews, terms)
    assert m.count() == 3
    assert {(r["app"], r["name"], r["code"]) for r in dd.code_reviews(reviews, m).collect()} == {
        ("a", "1", "作弊"), ("a", "1", "难度"), ("a", "2", fixed.OTHER_CODE), ("b", "1", fixed.OTHER_CODE)}


@pytest.mark.parametrize("gaps,band", [(9, "other_or_ignore"), (10, "review"), (20, "review"), (21, "iterate_codebook")])
def test_gap_bands(spark, gaps, band):
    reviews = spark.createDataFrame([("a", 0, str(i), "t") for i in range(100)], "app string, batch_id long, name string, review_norm string")
    hits = spark.createDataFrame([("a", str(i), "c", "t") for i in range(gaps, 100)], "app string, name string, code string, term string")
    assert dd.gap_rate(reviews, hits).first()["band"] == band


def test_recurring_gaps(spark):
    ordinals = spark.createDataFrame([("a", b, i) for i, b in enumerate([0, 1, 4, 5, 9], 1)], "app string, batch_id long, ordinal long")
    gaps = spark.createDataFrame([("a", b, "x") for b in (0, 1, 4, 4, 9)] + [("a", b, "y") for b in (1, 4, 5, 9)], "app string, batch_id long, label string")
    assert _set(dd.recurring_gaps(gaps, ordinals)) == {("a", "x", 4), ("a", "y", 5), ("a", "y", 9)}


# --- prompts ------------------------------------------------------------------------------------

def test_prompt_text(spark):
    layers = spark.createDataFrame([("a", "inductive", i, f"\n L{i} \n") for i in (1, 2, 3, 4)] + [("a", "deductive", 1, "x")], schemas.LAYERS)
    batches = spark.createDataFrame([("a", 3, 2, "e2"), ("a", 3, 1, "e1")], "app string, batch_id long, global_seq long, entry string")
    row = pr.build_prompts(layers, pr.batch_texts(batches)).collect()
    assert len(row) == 1 and row[0]["stage"] == "inductive"
    lines = row[0]["prompt"].split("\n")
    assert lines[:5] == [fixed.PROMPT_RULE, fixed.PROMPT_TITLES[0], fixed.PROMPT_RULE, "L1", ""]
    assert "【本批待编码数据:批次 3】" in lines and "e1\n\ne2\n\n" in row[0]["prompt"]
    assert row[0]["prompt"].endswith(fixed.PROMPT_START_TEXT) and row[0]["n_chars"] == len(row[0]["prompt"])
    apps = spark.createDataFrame([("a",), ("b",)], "app string")
    assert pr.missing_layers(apps, layers).count() == 3 + 8
    size = pr.prompt_sizes(pr.build_prompts(layers, pr.batch_texts(batches)), batches, 10).first()
    assert size["over_budget"] and size["suggested_batch_size"] == 5
