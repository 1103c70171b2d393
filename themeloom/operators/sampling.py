"""Exact-size, repeatable sampling with memory, and the batches cut from a sample.

Rows are picked in the order of ``md5(name|seed)``. A first narrow pass counts rows per stratum and
leading hash digits; from these counts follow the quotas and, per stratum, the digits at which the
quota is reached. The second pass then drops every row beyond that cut while scanning, so review
text is shuffled only for rows that are drawn or share the cut slot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom import schemas
from themeloom.functions import text
from themeloom.operators.numbering import SLOT_DIGITS, hash_slot, number_rows
from themeloom.session import fits_broadcast, materialise


def require_positive(name: str, value: int) -> None:
    if not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")


def hash_key(salt: str, seed: int, name: str = "name") -> Column:
    """Random-looking but repeatable order key; each use has a salt of its own."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(name), F.lit("")), F.lit(f"{salt}{seed}")))


def filter_length(reviews: DataFrame, min_len: int) -> DataFrame:
    return reviews.filter(text.long_enough("review", min_len)) if min_len > 0 else reviews


def exclude_logged(reviews: DataFrame, log: DataFrame) -> DataFrame:
    """Reviews whose id was never sampled before."""
    return reviews.join(log.select("app", "name"), ["app", "name"], "left_anti")


def unused_reviews(available: DataFrame, sample: DataFrame) -> DataFrame:
    """Available reviews whose id is not in the sample."""
    return available.join(sample.select("app", "name"), ["app", "name"], "left_anti")


# --- quotas -------------------------------------------------------------------------------------

def _rating_order(rating: str = "rating") -> list[Column]:
    """Numbers by value, then other texts, NULL last."""
    return [F.col(rating).try_cast("double").asc_nulls_last(), F.col(rating).asc_nulls_last()]


def stratum_quotas(strata: DataFrame, n_total: int) -> DataFrame:
    """Quota per (app, rating) from ``n_rows`` per stratum.

    Half-even share of each stratum, the last one takes what rounding left, sizes cap the quota, and
    a shortfall goes to strata with rows to spare in their order. Runs on one row per stratum.
    """
    by_app = Window.partitionBy("app")
    order = by_app.orderBy(*_rating_order())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    t = strata.withColumn("_total", F.sum("n_rows").over(by_app)).withColumn(
        "_n", F.least(F.lit(n_total).cast("long"), F.col("_total"))
    )
    t = t.withColumn("_share", F.bround((F.col("_n") * F.col("n_rows")).cast("double") / F.col("_total")).cast("long"))
    t = t.withColumn("_is_last", F.row_number().over(order) == F.count(F.lit(1)).over(by_app))
    t = t.withColumn("_given", F.coalesce(F.sum("_share").over(earlier), zero))
    t = t.withColumn(
        "_first",
        F.least(F.when(F.col("_is_last"), F.col("_n") - F.col("_given")).otherwise(F.col("_share")), F.col("n_rows")),
    )
    t = t.withColumn("_spare", F.col("n_rows") - F.col("_first"))
    t = t.withColumn("_missing", F.col("_n") - F.sum("_first").over(by_app))
    t = t.withColumn("_spare_before", F.coalesce(F.sum("_spare").over(earlier), zero))
    extra = F.greatest(zero, F.least(F.col("_spare"), F.col("_missing") - F.col("_spare_before")))
    return t.withColumn("quota", F.greatest(zero, F.col("_first") + extra)).drop(
        "_total", "_n", "_share", "_is_last", "_given", "_first", "_spare", "_missing", "_spare_before"
    )


# --- drawing ------------------------------------------------------------------------------------

def _slot_counts(keyed: DataFrame) -> DataFrame:
    """One row per stratum: its size and the counts of its at most 4,096 hash slots."""
    per_slot = keyed.groupBy("app", "_stratum", "_slot").agg(F.count(F.lit(1)).alias("n"))
    return per_slot.groupBy("app", "_stratum").agg(
        F.sum("n").alias("n_rows"), F.array_sort(F.collect_list(F.struct("_slot", "n"))).alias("_slots")
    )


def _cut(quotas: DataFrame) -> DataFrame:
    """The slot in which each stratum reaches its quota, and how many rows of it are still needed."""
    start = F.struct(
        F.lit(None).cast("string").alias("slot"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("seen")
    )

    def step(acc, s):
        seen = acc["seen"] + s["n"]
        reached = acc["slot"].isNull() & (seen >= F.col("quota"))
        return F.struct(
            F.when(reached, s["_slot"]).otherwise(acc["slot"]).alias("slot"),
            F.when(reached, acc["seen"]).otherwise(acc["before"]).alias("before"),
            seen.alias("seen"),
        )

    found = quotas.filter("quota > 0").withColumn("_c", F.aggregate("_slots", start, step))
    return found.select(
        "app", "_stratum", "_slots",
        F.col("_c.slot").alias("_cut_slot"), (F.col("quota") - F.col("_c.before")).alias("_left"),
    )


def _finer(counted: DataFrame, cuts: DataFrame) -> DataFrame:
    """``cuts`` with ``_cut_inner``: the next digits at which the quota is reached within the cut slot.

    Of a slot of a large stratum only the part up to these digits is needed, so the rows that are ranked, with their
    texts, stay near the quota, whatever the size of the stratum.
    """
    within = cuts.select(F.col("app").alias("_a"), F.col("_stratum").alias("_s"), "_cut_slot")
    same = (F.col("app") == F.col("_a")) & F.col("_stratum").eqNullSafe(F.col("_s")) & (F.col("_slot") == F.col("_cut_slot"))
    inner = _slot_counts(counted.join(within, same).select("app", "_stratum", F.col("_inner").alias("_slot")))
    quota = cuts.select(F.col("app").alias("_a"), F.col("_stratum").alias("_s"), F.col("_left").alias("quota"))
    found = _cut(inner.join(quota, (F.col("app") == F.col("_a")) & F.col("_stratum").eqNullSafe(F.col("_s"))).select(*inner.columns, "quota"))
    found = found.select(F.col("app").alias("_a"), F.col("_stratum").alias("_s"), F.col("_cut_slot").alias("_cut_inner"))
    return cuts.join(found, (F.col("app") == F.col("_a")) & F.col("_stratum").eqNullSafe(F.col("_s"))).drop("_a", "_s")


def _draw(reviews: DataFrame, log: DataFrame | None, n_total: int, seed: int, stratum: Column) -> DataFrame:
    keyed = reviews.withColumn("pick_key", hash_key("", seed)).withColumn("_slot", hash_slot("pick_key"))
    keyed = keyed.withColumn("_inner", F.substring("pick_key", SLOT_DIGITS + 1, SLOT_DIGITS))
    keyed = keyed.withColumn("_stratum", stratum)
    counted = keyed.select("app", "name", "_stratum", "_slot", "_inner")
    if log is not None:
        log = log.select("app", "name")
        counted = counted.join(log, ["app", "name"], "left_anti")
    strata = _slot_counts(counted).withColumnRenamed("_stratum", "rating")
    cuts = materialise(_cut(stratum_quotas(strata, n_total).withColumnRenamed("rating", "_stratum")))
    cuts = materialise(_finer(counted, cuts))

    r, c = keyed.alias("r"), cuts.alias("c")
    same = (F.col("r.app") == F.col("c.app")) & F.col("r._stratum").eqNullSafe(F.col("c._stratum"))
    if fits_broadcast(cuts):
        c = F.broadcast(cuts.drop("_slots")).alias("c")
        near = r.join(c, same & (F.col("r._slot") <= F.col("c._cut_slot")))
    else:
        kept = F.explode(F.filter("_slots", lambda s: s["_slot"] <= F.col("_cut_slot")))
        c = cuts.select("app", "_stratum", "_cut_slot", "_cut_inner", "_left", kept.alias("_s")).withColumn("_slot", F.col("_s._slot"))
        near = r.join(c.alias("c"), same & (F.col("r._slot") == F.col("c._slot")))
    near = near.select("r.*", "c._cut_slot", "c._cut_inner", "c._left")
    near = near.filter((F.col("_slot") < F.col("_cut_slot")) | (F.col("_inner") <= F.col("_cut_inner")))
    if log is not None:
        # An anti join would be pushed below the cut and shuffle every review; an outer join stays
        # above it, so only survivors are shuffled.
        seen = log.distinct().withColumn("_seen", F.lit(True))
        near = near.join(seen, ["app", "name"], "left").filter(F.col("_seen").isNull()).drop("_seen")

    tie = [F.col("pick_key"), F.col("name"), F.col("rating"), F.xxhash64("review")] if "rating" in reviews.columns else [
        F.col("pick_key"), F.col("name"), F.xxhash64("review")]
    in_slot = Window.partitionBy("app", "_stratum", "_slot").orderBy(*tie)
    ranked = near.withColumn("_rank", F.row_number().over(in_slot))
    needed = (F.col("_slot") < F.col("_cut_slot")) | (F.col("_rank") <= F.col("_left"))
    return ranked.filter(needed).select(*reviews.columns, "pick_key")


def simple_sample(reviews: DataFrame, n_total: int, seed: int = 42, log: DataFrame | None = None) -> DataFrame:
    """``min(available, n_total)`` reviews per app, in no particular order."""
    return _draw(reviews, log, n_total, seed, F.lit("all"))


def stratified_pick(reviews: DataFrame, n_total: int, seed: int = 42, log: DataFrame | None = None) -> DataFrame:
    """The first ``quota`` reviews of every stratum. When rounding leaves the last quota negative it
    counts as 0, so an app may have a few rows too many here; numbering keeps the first ``n_total``."""
    return _draw(reviews, log, n_total, seed, F.col("rating").cast("string"))


def draw_sample(
    reviews: DataFrame, n_total: int, seed: int = 42, stratify: bool = False, log: DataFrame | None = None
) -> DataFrame:
    """Sample per app with its order: ``position`` 1..n by a second, differently salted key."""
    by_rating = stratify and "rating" in reviews.columns
    picked = (stratified_pick if by_rating else simple_sample)(reviews, n_total, seed, log)
    picked = picked.withColumn("shuffle_key", hash_key("shuffle", seed))
    order = ["shuffle_key", "name", F.xxhash64("review")]
    # rounding at most doubles a share, hence the factor
    numbered = number_rows(picked, ["app"], order, hash_slot("shuffle_key"), "position", bound=2 * n_total)
    return numbered.filter(F.col("position") <= n_total).drop("pick_key", "shuffle_key")


def assign_batches(sample: DataFrame, log: DataFrame, batch_size: int) -> DataFrame:
    """Global sequence and batch number, both going on from the highest ones in the log."""
    require_positive("batch_size", batch_size)
    last = log.groupBy("app").agg(F.max("global_seq").alias("_seq"), F.max("batch_id").alias("_batch"))
    norm = text.normalise("review")
    return (
        sample.join(last, "app", "left")
        .withColumn("global_seq", F.coalesce("_seq", F.lit(0)) + F.col("position"))
        .withColumn("batch_id", F.coalesce(F.col("_batch") + 1, F.lit(0)) + F.floor((F.col("position") - 1) / batch_size))
        .withColumn("review_norm", norm)
        .withColumn("rating", F.col("rating") if "rating" in sample.columns else F.lit(None).cast("string"))
        .withColumn("entry", text.entry("name", "rating", "review_norm"))
        .select(
            "app", F.col("batch_id").cast("long").alias("batch_id"), F.col("global_seq").cast("long").alias("global_seq"),
            "name", "rating", "review_norm", "entry",
        )
    )


# --- one whole run ------------------------------------------------------------------------------

@dataclass(frozen=True)
class SamplingRun:
    """What a run yields. ``batches`` is stored once; everything else is derived from it."""

    batches: DataFrame
    log: DataFrame
    n_total: int
    batch_size: int
    reviews: DataFrame
    min_len: int
    run_id: str

    def log_rows(self) -> DataFrame:
        rows = self.batches.withColumn("run_id", F.lit(self.run_id))
        return rows.select(*schemas.SAMPLING_LOG.fieldNames())

    def available(self) -> DataFrame:
        return exclude_logged(filter_length(self.reviews, self.min_len), self.log)

    def unused(self) -> DataFrame:
        # one anti join against old and new ids together instead of two
        seen = self.log.select("app", "name").unionByName(self.batches.select("app", "name"))
        return unused_reviews(filter_length(self.reviews, self.min_len), seen)

    def summary(self) -> DataFrame:
        return run_summary(
            self.reviews, self.log, self.batches, self.min_len, self.batch_size, self.n_total // self.batch_size
        )

    def ratings(self) -> DataFrame:
        return rating_distribution(self.batches)


def run_sampling(
    reviews: DataFrame, log: DataFrame, batch_size: int, n_batches: int, seed: int = 42, min_len: int = 0,
    stratify: bool = False, run_id: str = "run", fail_on_empty: bool = False,
) -> SamplingRun:
    """Filter, exclude, draw, number and cut into batches for every app at once."""
    require_positive("batch_size", batch_size)
    require_positive("n_batches", n_batches)
    n_total = batch_size * n_batches
    pool = filter_length(reviews, min_len)
    sample = draw_sample(pool, n_total, seed, stratify, log)
    batches = materialise(assign_batches(sample, log, batch_size))
    if fail_on_empty and batches.isEmpty():
        raise ValueError("no reviews left: all were sampled before, or min_len is too strict")
    return SamplingRun(batches, log, n_total, batch_size, reviews, min_len, run_id)


def run_summary(
    reviews: DataFrame, log: DataFrame, batches: DataFrame, min_len: int, batch_size: int, n_batches: int
) -> DataFrame:
    """One row per app. Rows are counted per id first, which melts repeated ids before any join."""
    requested = batch_size * n_batches
    long_row = text.long_enough("review", min_len).cast("long")
    names = reviews.groupBy("app", "name").agg(F.count(F.lit(1)).alias("n"), F.sum(long_row).alias("n_long"))
    logged = log.select("app", "name").distinct().withColumn("_logged", F.lit(True))
    drawn = batches.select("app", "name").distinct().withColumn("_drawn", F.lit(True))
    flagged = names.join(logged, ["app", "name"], "left").join(drawn, ["app", "name"], "left")
    old, new = F.col("_logged").isNotNull(), F.col("_drawn").isNotNull()
    zero = F.lit(0)
    pool = flagged.groupBy("app").agg(
        F.sum("n").alias("n_read"),
        F.sum(F.col("n") - F.col("n_long")).alias("n_too_short"),
        F.sum(F.when(old, F.col("n_long")).otherwise(zero)).alias("n_excluded"),
        F.sum(F.when(~old, F.col("n_long")).otherwise(zero)).alias("n_available"),
        F.sum(F.when(~old & ~new, F.col("n_long")).otherwise(zero)).alias("n_unused"),
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("n_duplicate_names"),
    )
    drawn_stats = batches.groupBy("app").agg(
        F.count(F.lit(1)).alias("_actual"), F.min("global_seq").alias("first_seq"), F.max("global_seq").alias("last_seq"),
        F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"),
    )
    actual = F.coalesce("_actual", zero)
    n_made = F.coalesce(F.col("last_batch") - F.col("first_batch") + 1, zero)
    return pool.join(drawn_stats, "app", "left").select(
        "app", "n_read", "n_too_short", "n_excluded", "n_available",
        F.lit(requested).cast("long").alias("n_requested"), actual.cast("long").alias("n_actual"),
        n_made.cast("long").alias("n_batches"),
        F.when(actual > 0, actual - (n_made - 1) * batch_size).otherwise(zero).cast("long").alias("last_batch_size"),
        "n_unused", "first_seq", "last_seq", "first_batch", "last_batch", "n_duplicate_names",
        (F.col("n_available") < requested).alias("is_short"), (F.col("n_available") == 0).alias("is_empty"),
    )


def rating_distribution(batches: DataFrame) -> DataFrame:
    return batches.groupBy("app", "rating").agg(F.count(F.lit(1)).alias("n")).orderBy("app", *_rating_order())


def gold_set(batches: DataFrame, size: int = 15, seed: int = 42) -> DataFrame:
    """Fixed draw of ``size`` reviews from an app's first batch, to be coded twice."""
    first = batches.filter(F.col("batch_id") == 0).withColumn("_key", hash_key("gold", seed))
    w = Window.partitionBy("app").orderBy("_key", "name")
    return (
        first.withColumn("gold_rank", F.row_number().over(w)).filter(F.col("gold_rank") <= size)
        .select("app", "name", "rating", "review_norm", F.col("gold_rank").cast("long").alias("gold_rank"))
    )
