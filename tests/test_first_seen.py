"""The kept first-seen table against the report over all codings, after arrivals in any order."""

import random

from themeloom.operators import first_seen as fs
from themeloom.operators import saturation as st

SCHEMA = "app string, batch_id long, theme string, code string, quote string"


def _codings(spark, content):
    return spark.createDataFrame([(a, b, "t", c, "q") for (a, b), codes in content.items() for c in codes], SCHEMA)


def _batches(spark, keys):
    return spark.createDataFrame(list(keys), "app string, batch_id long")


def _sorted(df):
    return sorted(map(tuple, df.collect()))


def test_any_order_of_arrivals_and_corrections(spark, tmp_path):
    r = random.Random(3)
    state, path = {}, str(tmp_path / "log")
    log = fs.empty_log(spark)
    keys = [(a, b) for a in "xy" for b in range(6)]
    r.shuffle(keys)
    waves = [keys[:5], keys[5:], r.sample(keys, 4), keys[:2]]  # the last two correct batches that are there
    for n, wave in enumerate(waves, 1):
        wave = {k: [r.choice(["a", "b ", " b", "c", "d", "e", "f", "  "]) for _ in range(r.randrange(4))] for k in wave}
        state |= wave
        fs.append_arrival(fs.arrival_rows(log, _codings(spark, wave), n, _batches(spark, wave)), path)
        log = fs.read_first_seen_log(spark, path)
        want = _sorted(st.new_codes(_codings(spark, state), _batches(spark, state)))
        assert _sorted(fs.new_codes(log)) == want
    assert _sorted(fs.new_codes(fs.compacted(log, len(waves)))) == want


def test_retry_replaces_its_own_rows_and_touches_its_own_codes(spark, tmp_path):
    path = str(tmp_path / "log")
    fs.append_arrival(fs.arrival_rows(fs.empty_log(spark), _codings(spark, {("x", 3): "abc", ("x", 5): "d"}), 1), path)
    for content in ({("x", 1): "ad"}, {("x", 1): "a"}):  # the second is a retry with other rows
        rows = fs.arrival_rows(fs.read_first_seen_log(spark, path), _codings(spark, content), 2)
        fs.append_arrival(rows, path)
    log = fs.read_first_seen_log(spark, path)
    assert _sorted(fs.first_seen(log)) == [("x", "a", 1), ("x", "b", 3), ("x", "c", 3), ("x", "d", 5)]
    assert _sorted(log.filter("arrival = 2 AND kind = 'first'").select("code")) == [("a",)]


def test_a_code_that_leaves_all_batches_and_rows_without_batch(spark):
    log = fs.arrival_rows(fs.empty_log(spark), _codings(spark, {("x", 1): "ab", ("x", None): "z"}), 1)
    log = log.unionByName(fs.arrival_rows(log, _codings(spark, {("x", 1): "b"}), 2))
    assert _sorted(fs.first_seen(log)) == [("x", "b", 1)]
    same = fs.arrival_rows(log, _codings(spark, {("x", 1): "b"}), 3)
    assert same.count() == 0 and fs.arrival_rows(log, _codings(spark, {}), 3).count() == 0


def test_an_arrival_reads_its_codings_twice(spark):
    """Once for its batches and once for its codes, however many uses these have."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    log = fs.arrival_rows(fs.empty_log(spark), _codings(spark, {("x", 1): "ab", ("x", 2): "b"}), 1)
    codings = _codings(spark, {("x", 1): "bcd", ("x", 3): "a"}).mapInArrow(counted, SCHEMA)
    log = log.unionByName(fs.arrival_rows(log, codings, 2))
    assert _sorted(fs.first_seen(log)) == [("x", "a", 3), ("x", "b", 1), ("x", "c", 1), ("x", "d", 1)]
    assert seen.value == 2 * 4
