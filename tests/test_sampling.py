import random

import pytest
from pyspark.sql import functions as F

from themeloom import schemas
from themeloom.operators import numbering, sampling as sm


def _reviews(spark, n, app="a", ratings=5):
    rows = [(app, f"u{i}", str(i % ratings + 1), f"review number {i}") for i in range(n)]
    return spark.createDataFrame(rows, schemas.REVIEWS)


def _no_log(spark):
    return spark.createDataFrame([], schemas.SAMPLING_LOG)


# worked out by hand: strata sizes, rows wanted, quotas
QUOTAS = [
    ([10, 10], 5, [2, 3]),  # 2.5 rounds to the even 2, the last stratum takes what is left
    ([3, 7], 5, [2, 3]),
    ([1, 9], 5, [0, 5]),
    ([9, 1], 5, [4, 1]),
    ([19, 1], 10, [10, 0]),
    ([6, 6, 6, 6, 6], 3, [1, 1, 1, 1, 0]),  # the last quota would be -1
    ([9, 30, 12, 9, 10], 4, [1, 2, 1, 1, 0]),
    ([5, 5, 5, 5, 1], 10, [3, 2, 2, 2, 1]),  # the last stratum is one short, the first makes up for it
    ([1, 5, 5, 5, 5, 1], 12, [1, 3, 3, 3, 3, 0]),  # 2.7 rounds up four times, so the last has none
    ([4, 2], 9, [4, 2]),  # more wanted than there are
    ([7], 3, [3]),
]


def _quotas(spark, cases, n):
    rows = [(f"app{i}", str(g), s) for i, c in enumerate(cases) for g, s in enumerate(c)]
    got = {(r["app"], int(r["rating"])): r["quota"] for r in sm.stratum_quotas(spark.createDataFrame(rows, "app string, rating string, n_rows long"), n).collect()}
    return [[got[(f"app{i}", g)] for g in range(len(c))] for i, c in enumerate(cases)]


@pytest.mark.parametrize("sizes,n,want", QUOTAS)
def test_quotas_by_hand(spark, sizes, n, want):
    assert _quotas(spark, [sizes], n) == [want]


@pytest.mark.parametrize("n", [1, 4, 20, 61, 500])
def test_quota_properties(spark, n):
    rng = random.Random(n)
    cases = [[rng.randint(1, 60) for _ in range(rng.randint(1, 9))] for _ in range(60)]
    for sizes, quotas in zip(cases, _quotas(spark, cases, n), strict=True):
        total, wanted = sum(sizes), min(n, sum(sizes))
        assert all(0 <= q <= s for q, s in zip(quotas, sizes, strict=True))
        assert sum(quotas) >= wanted
        if quotas[-1] > 0:
            assert sum(quotas) == wanted
        # no stratum but the last falls short of its rounded share, and what is over goes to the front as long as there is room
        over = [q - wanted * s / total for q, s in zip(quotas[:-1], sizes[:-1], strict=True)]
        assert all(x >= -0.5 for x in over)
        made_up = [k for k, x in enumerate(over) if x > 0.5]
        assert all(quotas[k] == sizes[k] or abs(over[k]) <= 0.5 for k in range(max(made_up, default=0)))


def test_null_and_numeric_strata_order(spark):
    rows = [("a", "10", 3), ("a", "9", 3), ("a", None, 3)]
    got = sm.stratum_quotas(spark.createDataFrame(rows, "app string, rating string, n_rows long"), 5).collect()
    assert {r["rating"]: r["quota"] for r in got} == {"9": 2, "10": 2, None: 1}


def test_negative_quota_draws_exactly_n(spark):
    run = sm.run_sampling(_reviews(spark, 30), _no_log(spark), 3, 1, stratify=True)
    assert run.batches.count() == 3
    assert run.unused().count() == 27  # the surplus pick stays in the pool


def test_same_sample_for_any_partitioning(spark):
    r = _reviews(spark, 500)
    a = sm.run_sampling(r.repartition(1), _no_log(spark), 20, 3, stratify=True).batches.collect()
    b = sm.run_sampling(r.repartition(13), _no_log(spark), 20, 3, stratify=True).batches.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_resume(spark):
    r = _reviews(spark, 100)
    one = sm.run_sampling(r, _no_log(spark), 20, 2, run_id="r1")
    log = one.log_rows()
    two = sm.run_sampling(r, log, 20, 3, run_id="r2")
    names1 = {x["name"] for x in one.batches.collect()}
    rows2 = two.batches.collect()
    assert not names1 & {x["name"] for x in rows2}
    assert sorted(x["global_seq"] for x in rows2) == list(range(41, 101))
    assert {x["batch_id"] for x in rows2} == {2, 3, 4}
    s = two.summary().first()
    assert (s["n_read"], s["n_excluded"], s["n_available"], s["n_actual"], s["last_batch_size"], s["is_short"]) == (100, 40, 60, 60, 20, False)
    three = sm.run_sampling(r, log.unionByName(two.log_rows()), 20, 1)
    assert three.batches.isEmpty() and three.summary().first()["is_empty"]
    with pytest.raises(ValueError):
        sm.run_sampling(r, log.unionByName(two.log_rows()), 20, 1, fail_on_empty=True)


def test_last_batch_may_be_short(spark):
    run = sm.run_sampling(_reviews(spark, 25), _no_log(spark), 10, 5)
    assert sorted(r["n"] for r in run.batches.groupBy("batch_id").agg(F.count("*").alias("n")).collect()) == [5, 10, 10]
    s = run.summary().first()
    assert (s["n_batches"], s["last_batch_size"], s["is_short"], s["first_seq"], s["last_seq"]) == (3, 5, True, 1, 25)


def test_without_rating_falls_back(spark):
    r = _reviews(spark, 40)
    plain = {x["name"] for x in sm.simple_sample(r, 10).collect()}
    assert {x["name"] for x in sm.draw_sample(r.drop("rating"), 10, stratify=True).collect()} == plain


def test_null_ratings_can_be_drawn(spark):
    r = _reviews(spark, 30).withColumn("rating", F.when(F.col("rating") != "1", F.col("rating")))
    drawn = sm.run_sampling(r, _no_log(spark), 10, 1, stratify=True).batches
    assert drawn.filter("rating IS NULL").count() == 2 and drawn.count() == 10


def test_repeated_ids_keep_the_size_exact(spark):
    r = _reviews(spark, 20).unionByName(_reviews(spark, 20)).withColumn("name", F.when(F.col("rating") == "1", "same").otherwise(F.col("name")))
    for n in (1, 7, 23):
        run = sm.run_sampling(r, _no_log(spark), n, 1)
        assert run.batches.count() == n
    assert run.summary().first()["n_duplicate_names"] > 0


def test_short_reviews_are_left_out_on_their_raw_length(spark):
    rows = [("a", "1", "5", None), ("a", "2", "5", "abc"), ("a", "3", "5", " b  ")]
    r = spark.createDataFrame(rows, schemas.REVIEWS)
    assert {x["name"] for x in sm.filter_length(r, 4).collect()} == {"3"}
    assert sm.filter_length(r, 0).count() == 3


def test_shuffled_cuts_give_the_same_sample(spark, monkeypatch):
    r, log = _reviews(spark, 300), sm.run_sampling(_reviews(spark, 300), _no_log(spark), 10, 2).log_rows()
    want = {tuple(x) for x in sm.stratified_pick(r, 50, log=log).collect()}
    monkeypatch.setattr(sm, "fits_broadcast", lambda df: False)
    assert {tuple(x) for x in sm.stratified_pick(r, 50, log=log).collect()} == want


def test_slotted_positions_equal_plain_ones(spark):
    df = _reviews(spark, 400).unionByName(_reviews(spark, 50, app="b")).withColumn("k", sm.hash_key("x", 1))
    slot = numbering.hash_slot("k", 1)
    plain = numbering.number_rows(df, ["app"], ["k"], slot, "p", bound=1000)
    slotted = numbering.number_rows(df, ["app"], ["k"], slot, "p", bound=None)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, slotted.collect()))


def test_arguments(spark):
    for bad in (0, -1, 2.5):
        with pytest.raises(ValueError):
            sm.run_sampling(_reviews(spark, 3), _no_log(spark), bad, 1)


def test_gold_set(spark):
    run = sm.run_sampling(_reviews(spark, 100), _no_log(spark), 30, 2)
    gold = sm.gold_set(run.batches, 12)
    first = {r["name"] for r in run.batches.filter("batch_id = 0").collect()}
    assert gold.count() == 12 and {r["name"] for r in gold.collect()} <= first


def test_one_plan_for_any_size(spark):
    r = _reviews(spark, 50)

    def steps(n):
        plan = sm.stratified_pick(r, n)._jdf.queryExecution().executedPlan().toString()
        return [x for x in ("WindowGroupLimit", "Window ", "SortMergeJoin", "BroadcastHashJoin", "Exchange") if x in plan]

    assert steps(250) == steps(2_000) == steps(2_000_000)
