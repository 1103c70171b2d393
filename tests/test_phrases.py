import random

import pytest

from themeloom.operators import phrases as ph

WAYS = {
    "list": dict(list_phrases=10**6),
    "broadcast set": dict(list_phrases=0),
    "broadcast open": dict(list_phrases=0, set_phrases=0),
    "set": dict(list_phrases=0, max_rows=0),
    "open": dict(list_phrases=0, set_phrases=0, max_rows=0),
    "mixed": dict(list_phrases=25, set_phrases=60, max_rows=0),
}


def _data():
    rng = random.Random(7)
    words = ["操作", "卡顿", "the", "game", "lag ", "好", "难😀", "aaaaaaaa", "abcabcabcabc", "…", "\n", "of the people and by the people"]
    texts, phrases = [], []
    for scope in ("s", "t"):
        for i in range(40):
            texts.append((scope, f"n{i}", "".join(rng.choice(words) for _ in range(rng.randint(0, 60)))))
        own = [t for s, _, t in texts if s == scope]
        for _ in range(120):
            t = rng.choice(own) or "x"
            a = rng.randrange(len(t))
            piece = t[a:a + rng.choice([1, 2, 3, 4, 6, 8, 11, 15, 16, 25, 60])]
            phrases.append((scope, piece))
            phrases.append((scope, piece[:-1] + "#"))  # mostly absent
    texts.append(("u", "lonely", "no phrases here"))
    phrases += [("s", ""), ("v", "no texts here")]
    return texts, phrases


@pytest.mark.parametrize("way", WAYS)
def test_every_way_equals_brute_force(spark, way):
    texts, phrases = _data()
    want = {(s, n, p) for s, n, t in texts for s2, p in phrases if s == s2 and p and p in t}
    found = ph.find_phrases(
        spark.createDataFrame(texts, "app string, name string, review_norm string"),
        spark.createDataFrame(phrases, "app string, phrase string"), ["app"], **WAYS[way])
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_search_in_batches_equals_brute_force(spark):
    texts, phrases = _data()
    want = {(s, n, p) for s, n, t in texts for s2, p in phrases if s == s2 and p and p in t}
    found = ph.find_in_batches(
        spark.createDataFrame(texts, "app string, name string, review_norm string"),
        spark.createDataFrame(phrases, "app string, phrase string"), ["app"])
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_phrases(spark):
    texts = spark.createDataFrame([("s", "n", "t")], "app string, name string, review_norm string")
    found = ph.find_phrases(texts, spark.createDataFrame([], "app string, phrase string"), ["app"])
    assert found.columns == ["app", "name", "phrase"] and found.isEmpty()


def test_plans_have_no_nested_loop(spark):
    texts, phrases = _data()
    t = spark.createDataFrame(texts, "app string, name string, review_norm string")
    p = spark.createDataFrame(phrases, "app string, phrase string")
    for kw in WAYS.values():
        plan = ph.find_phrases(t, p, ["app"], **kw)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_repeated_names_are_told_apart(spark):
    texts = spark.createDataFrame([("s", "n", "alpha beta gamma delta"), ("s", "n", "other text")], "app string, name string, review_norm string")
    phrases = spark.createDataFrame([("s", "beta gamma delta"), ("s", "other")], "app string, phrase string")
    for kw in WAYS.values():
        assert {r["phrase"] for r in ph.find_phrases(texts, phrases, ["app"], **kw).collect()} == {"beta gamma delta", "other"}


def test_values_are_carried_with_their_phrase(spark):
    texts = spark.createDataFrame([("s", "n", "alpha beta gamma"), ("t", "n", "alpha")], "app string, name string, review_norm string")
    phrases = spark.createDataFrame([("s", "beta", "x"), ("s", "beta", "y"), ("s", "alpha beta gamma", "z"), ("t", "alpha", "x"), ("s", "none", "x")], "app string, phrase string, code string")
    for kw in WAYS.values():
        got = sorted(tuple(r) for r in ph.find_phrases(texts, phrases, ["app"], carry="code", **kw).collect())
        assert got == [("s", "n", "alpha beta gamma", "z"), ("s", "n", "beta", "x"), ("s", "n", "beta", "y"), ("t", "n", "alpha", "x")]


@pytest.fixture
def hot(spark, monkeypatch):
    """One app with one term in every text, and nothing in it but that term to be found by."""
    monkeypatch.setattr(ph, "SHARES", 400)
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    texts = spark.range(4000).selectExpr("if(id % 10 = 0, 'b', 'a') AS app", "cast(id AS string) AS name", "concat(md5(cast(id AS string)), ' the commonplace ', md5(cast(-id AS string))) AS review_norm")
    phrases = spark.createDataFrame([("a", "the commonplace"), ("a", "commonplace"), ("b", "absent from all")], "app string, phrase string")
    yield texts, phrases
    for k in keys:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("as_set", [True, False])
def test_a_term_in_every_text_is_dealt_to_many_tasks(spark, hot, as_set):
    from pyspark.sql import functions as F

    texts, phrases = hot
    keyed = texts.withColumn("_text", F.xxhash64("review_norm"))
    carried = phrases.withColumn("_carry", F.array(F.lit("c")))
    met = ph._candidates(keyed, carried, ["app"], "review_norm", "name", {0, 8}, as_set, False)
    rows = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(rows) >= 7200 and max(rows) <= sum(rows) / 4
    kw = dict(list_phrases=0, max_rows=0) if as_set else dict(list_phrases=0, set_phrases=0, max_rows=0)
    assert ph.find_phrases(texts, phrases, ["app"], **kw).count() == 7200


def test_a_scope_with_most_texts_is_dealt_to_many_tasks(spark, hot):
    from pyspark.sql import functions as F

    texts, phrases = hot
    lists = phrases.groupBy("app").agg(F.collect_list("phrase").alias("_phrases"))
    rows = [r["count"] for r in ph._by_scope(texts, lists, ["app"], "name", False).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 4000 and max(rows) <= 1000


def test_frequent_ngrams_are_not_anchors(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ph, "SHARES", 50)
    phrases = spark.createDataFrame([("a", "commonest zebra")], "app string, phrase string").withColumn("_carry", F.array(F.lit("c")))
    texts = spark.range(500).selectExpr("'a' AS app", "cast(id AS string) AS name", "concat('commonest ', if(id = 7, 'zebra', md5(cast(id AS string)))) AS review_norm", "id AS _text")
    met = ph._candidates(texts, phrases, ["app"], "review_norm", "name", {0, 8}, True, False)
    assert [r.name for r in met.collect()] == ["7"]


def test_phrases_are_not_stored(spark):
    texts, phrases = _data()
    t = spark.createDataFrame(texts, "app string, name string, review_norm string")
    p = spark.createDataFrame(phrases, "app string, phrase string")
    plan = ph.find_phrases(t, p, ["app"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Checkpoint" not in plan


def test_search_in_batches_on_nulls_and_empty_sides(spark):
    texts = spark.createDataFrame([("s", "n", None), ("s", "m", "a b"), (None, "o", "a"), ("z", "q", "a")], "app string, name string, review_norm string")
    phrases = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", None), ("s", ""), (None, "a"), ("y", "a")], "app string, phrase string")
    assert sorted(map(tuple, ph.find_in_batches(texts, phrases, ["app"]).collect()), key=str) == [("s", "m", "a"), (None, "o", "a")]
    assert ph.find_in_batches(texts, phrases.limit(0), ["app"]).isEmpty()


def test_a_bounded_dictionary_reads_each_text_once(spark):
    """As automata where the texts lie: as brute force, with all codes of a phrase, and no n-grams of the texts."""
    texts, phrases = _data()
    coded = [(s, p, c) for i, (s, p) in enumerate(phrases) for c in (["x", f"y{i % 3}"] if i % 2 else ["x"])] + [(None, "the", "z"), ("s", "game", None)]
    want = {(s, n, p, c) for s, n, t in texts for s2, p, c in coded if s == s2 and p and p in t and c is not None}
    rows = spark.createDataFrame(texts + [("s", "none", None), (None, "lost", "the game")], "app string, name string, review_norm string")
    found = ph.find_phrases(rows, spark.createDataFrame(coded, "app string, phrase string, code string"), ["app"], carry="code", automaton_chars=10**6)
    got = [(r.app, r.name, r.phrase, r.code) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract_all" not in plan


def test_first_characters_settle_hits_or_hand_over():
    """In a batch phrases are looked up by their first characters; where these tell little apart, an automaton takes over."""
    texts, phrases = _data()
    read, wanted = [t for _, _, t in texts] + [None], list({p for _, p in phrases if p})
    want = [{p for p in wanted if t and p in t} for t in read]
    assert [set(x) for x in ph._automaton_hits(read, wanted)] == want
    few = [p for p in wanted if len(p) > 3][:40]
    assert [set(x) for x in ph._anchored_hits(read, few)] == [{p for p in few if t and p in t} for t in read]
    assert ph._anchored_hits(["a" * 5_000], ["a" * 16 + "b" * i for i in range(60)]) is None
