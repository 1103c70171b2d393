import pytest

from themeloom.functions import bands
from themeloom.operators import numbering, saturation as st
from pyspark.sql import functions as F

SCHEMA = "app string, batch_id long, theme string, code string, quote string"


def _codings(spark, per_batch):
    rows = [("a", b, "t", c, "q") for b, codes in per_batch.items() for c in codes]
    return spark.createDataFrame(rows, SCHEMA)


def _entries(spark, counts):
    return spark.createDataFrame([("a", b, n) for b, n in counts.items()], "app string, batch_id long, n_entries long")


def _report(spark, per_batch, counts=None):
    df = st.saturation_report(_codings(spark, per_batch), _entries(spark, counts or {0: 10}))
    return {r["batch_id"]: r.asDict() for r in df.collect()}


def test_new_cumulative_and_rolling(spark):
    r = _report(spark, {0: "abc", 2: "cd", 3: "dd", 7: "xyz"}, {0: 10, 2: 0, 3: 4})
    assert [r[b]["n_new"] for b in (0, 2, 3, 7)] == [3, 1, 0, 3]
    assert [r[b]["n_codes_total"] for b in (0, 2, 3, 7)] == [3, 4, 4, 7]
    assert [r[b]["new_rate"] for b in (0, 2, 3, 7)] == [30.0, 0.0, 0.0, 0.0]
    assert [r[b]["rolling_mean"] for b in (0, 2)] == [None, None]
    assert r[3]["rolling_mean"] == pytest.approx(4 / 3) and r[7]["rolling_mean"] == pytest.approx(4 / 3)
    assert r[0]["status"] == "insufficient" and r[3]["status"] == "near"
    assert [r[b]["all_last3_le2"] for b in (0, 2, 3, 7)] == [False, False, False, False]


def test_stop_rule(spark):
    r = _report(spark, {0: "ab", 1: "cd", 2: "ef", 3: "ghi"})
    assert [r[b]["all_last3_le2"] for b in range(4)] == [False, False, True, False]


def test_two_themes_are_one_batch(spark):
    c = spark.createDataFrame([("a", 0, "t", "x", "q"), ("a", 0, "u", "y", "q"), ("a", 0, "u", " x ", "p")], SCHEMA)
    assert [tuple(r) for r in st.new_codes(c).collect()] == [("a", 0, 2)]


def test_batch_without_valid_rows_counts(spark):
    coded = spark.createDataFrame([("a", 0), ("a", 1)], "app string, batch_id long")
    assert sorted(map(tuple, st.new_codes(_codings(spark, {0: "x"}), coded).collect())) == [("a", 0, 1), ("a", 1, 0)]


@pytest.mark.parametrize("mean,want", [(5.0, "far"), (4.99, "trending"), (3.0, "trending"), (2.9, "near"), (None, "insufficient")])
def test_band_edges(spark, mean, want):
    df = spark.createDataFrame([(mean,)], "m double")
    assert df.select(bands.saturation_status(F.col("m")).alias("s")).first()["s"] == want


def test_slots_do_not_change_the_report(spark, monkeypatch):
    data = {b: [f"c{b}_{i}" for i in range((b * 7) % 5)] + ["same"] for b in range(0, 40, 3)}
    want = _report(spark, data)
    monkeypatch.setattr(numbering, "BATCHES_PER_SLOT", 4)
    assert _report(spark, data) == want


def test_final_status_is_that_of_the_last_batch(spark):
    df = st.saturation_report(_codings(spark, {0: "ab", 1: "cd", 2: "ef"}), _entries(spark, {0: 1}))
    last = st.final_status(df).first()
    assert (last["batch_id"], last["status"], last["n_codes_total"]) == (2, "near", 6)
