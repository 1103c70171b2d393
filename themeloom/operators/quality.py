"""Evidence for reviewing a coding: verbatim quotes, coverage, drift, overlap, size and agreement."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.functions import bands, fixed, text
from themeloom.operators.numbering import number_rows
from themeloom.operators.overlaps import pairs_over
from themeloom.operators.phrases import find_in_batches
from themeloom.session import materialise

_BATCH = ["app", "batch_id"]


# --- verbatim and coverage ----------------------------------------------------------------------

def quote_sources(quotes: DataFrame, reviews: DataFrame) -> DataFrame:
    """(app, batch_id, name, quote): reviews that contain a quote of their own batch word for word.

    ``reviews`` holds ``app, batch_id, name, review_norm``.
    """
    phrases = quotes.select(*_BATCH, F.col("quote").alias("phrase"))
    return find_in_batches(reviews, phrases, _BATCH).withColumnRenamed("phrase", "quote")


def _of_batch(found: bool):
    def run(quotes: pa.Table, known: pa.Table) -> pa.Table:
        hit = pc.is_in(quotes.column("_q"), value_set=pa.chunked_array([x.flatten() for x in known.column("_known").chunks], pa.binary()))
        if any(quotes.column(c).null_count for c in _BATCH):  # rows without a batch have no source, as in a join
            hit = pc.and_(hit, pa.scalar(False))
        return quotes.drop_columns(["_q"]).filter(hit if found else pc.invert(hit))

    return run


def _by_sources(quotes: DataFrame, sources: DataFrame, found: bool) -> DataFrame:
    """The rows of ``quotes`` that have sources, or those that have none.

    They meet the 128-bit hashes of the quotes found batch by batch, as in the search: quotes that lie there for it are not moved again,
    and no text of a quote comes back from it.
    """
    q = F.unhex(F.md5("quote"))
    known = sources.groupBy(*_BATCH).agg(F.collect_set(q).alias("_known"))
    return quotes.withColumn("_q", q).groupBy(*_BATCH).cogroup(known.groupBy(*_BATCH)).applyInArrow(_of_batch(found), quotes.schema)


def verbatim_quotes(quotes: DataFrame, sources: DataFrame) -> DataFrame:
    return _by_sources(quotes, sources, True)


def altered_quotes(quotes: DataFrame, sources: DataFrame) -> DataFrame:
    """Quotes that no review of their batch contains."""
    return _by_sources(quotes, sources, False)


def uncoded_reviews(reviews: DataFrame, sources: DataFrame, out_of_scope: DataFrame | None = None) -> DataFrame:
    """In-scope reviews without any coded quote. ``sources`` name reviews by batch or, without ``batch_id``, by name alone."""
    rows = reviews.select(*_BATCH, "name")
    if out_of_scope is not None:
        rows = rows.join(out_of_scope.select("app", "name"), ["app", "name"], "left_anti")
    key = [c for c in (*_BATCH, "name") if c in sources.columns]
    return rows.join(sources.select(*key).distinct(), key, "left_anti")


def codebook_reuse(codings: DataFrame, codebook: DataFrame) -> DataFrame:
    """Per batch: distinct codes used, how many the codebook has, how many it lacks."""
    used = codings.select("app", "batch_id", "code").distinct()
    known = codebook.select("app", "code").distinct().withColumn("_known", F.lit(1))
    return used.join(known, ["app", "code"], "left").groupBy("app", "batch_id").agg(
        F.count(F.lit(1)).alias("n_codes"), F.count("_known").alias("n_known"),
        (F.count(F.lit(1)) - F.count("_known")).alias("n_new"),
        bands.share(F.count("_known"), F.count(F.lit(1))).alias("reuse_share"),
    )


def codes_outside_codebook(codings: DataFrame, codebook: DataFrame) -> DataFrame:
    """Codes the codebook does not have, with their number of rows: violations in the deductive stage."""
    used = codings.groupBy("app", "code").agg(F.count(F.lit(1)).alias("n_rows"))
    return used.join(codebook.select("app", "code"), ["app", "code"], "left_anti")


# --- summaries ----------------------------------------------------------------------------------

def _typical(codings: DataFrame, group: list[str], k: int) -> DataFrame:
    """The k shortest distinct quotes of a group with their rank. The rank bound is a literal, so each
    task keeps k rows per group before anything is shuffled for the ranking."""
    w = Window.partitionBy(*group).orderBy(F.length("quote"), "quote")
    return codings.select(*group, "quote").distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def coding_summary(codings: DataFrame, k: int = 2) -> DataFrame:
    """Per theme and code: quote count and up to k representative quotes."""
    group = ["app", "theme", "code"]
    counts = codings.groupBy(*group).agg(F.count(F.lit(1)).alias("n_quotes"))
    best = _typical(codings, group, k).groupBy(*group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "quote"))), lambda q: q["quote"]), " | ")
        .alias("samples")
    )
    return counts.join(best, group)


def theme_rollup(codings: DataFrame) -> DataFrame:
    """Quotes per (theme, code), per theme and in all; NULLs mark the roll-up levels."""
    per_code = codings.groupBy("app", "theme", "code").agg(F.count(F.lit(1)).alias("n"))
    return per_code.rollup("app", "theme", "code").agg(F.sum("n").alias("n_quotes"), F.grouping_id().cast("int").alias("level"))


def theme_shape(codings: DataFrame) -> DataFrame:
    """Per theme: codes and quotes, the expected 3 to 8 codes, and whether the theme name is itself
    used as a code."""
    per_code = codings.groupBy("app", "theme", "code").agg(F.count(F.lit(1)).alias("n"))
    n_codes = F.count(F.lit(1))
    return per_code.groupBy("app", "theme").agg(
        n_codes.alias("n_codes"), F.sum("n").alias("n_quotes"),
        n_codes.between(fixed.THEME_CODES_MIN, fixed.THEME_CODES_MAX).alias("codes_in_range"),
        F.max(F.coalesce(F.col("code") == F.col("theme"), F.lit(False))).alias("theme_used_as_code"),
    )


def thin_codes(codings: DataFrame) -> DataFrame:
    counts = codings.groupBy("app", "code").agg(F.count(F.lit(1)).alias("n_quotes"))
    return counts.filter(F.col("n_quotes") < fixed.THIN_CODE_QUOTES)


def scope_rate(flags: DataFrame) -> DataFrame:
    """Out-of-scope share per batch from ``app, batch_id, out_of_scope``; warns above one quarter."""
    out = F.sum(F.col("out_of_scope").cast("long"))
    total = F.count("out_of_scope")
    return flags.groupBy(*_BATCH).agg(
        total.alias("n_judged"), out.alias("n_out_of_scope"), bands.share(out, total).alias("out_share"),
        (out * 100 > total * round(fixed.OUT_OF_SCOPE_WARNING * 100)).alias("warn"),
    )


def top_codes(codings: DataFrame, k: int = 5) -> DataFrame:
    """The k most used codes of each batch; ties by code."""
    counts = codings.groupBy(*_BATCH, "code").agg(F.count(F.lit(1)).alias("n_quotes"))
    w = Window.partitionBy(*_BATCH).orderBy(F.desc("n_quotes"), "code")
    ranked = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def typical_quotes(codings: DataFrame, k: int = 2) -> DataFrame:
    return _typical(codings, ["app", "code"], k).withColumn("rank", F.col("rank").cast("long"))


def code_trend(codings: DataFrame, batch_ordinals: DataFrame) -> DataFrame:
    """Quotes per code and batch, and the change from the coded batch before (0 quotes if unused).

    The previous batch is found by an equi join on ordinal - 1, so no code is gathered in one task.
    """
    per_batch = codings.groupBy("app", "batch_id", "code").agg(F.count(F.lit(1)).alias("n_quotes"))
    here = per_batch.join(batch_ordinals.select("app", "batch_id", "ordinal"), ["app", "batch_id"])
    before = here.select("app", "code", (F.col("ordinal") + 1).alias("ordinal"), F.col("n_quotes").alias("_prev"))
    change = F.when(F.col("ordinal") > 1, F.col("n_quotes") - F.coalesce("_prev", F.lit(0)))
    return here.join(before, ["app", "code", "ordinal"], "left").select(
        "app", "batch_id", "code", "n_quotes", change.alias("change")
    )


# --- consistency --------------------------------------------------------------------------------

def gold_agreement(assignments: DataFrame) -> DataFrame:
    """Agreement of first and repeated coding per app from ``app, name, run, code``.

    Headline is the share of reviews with exactly the same codes; mean Jaccard stands next to it.
    Code sets are compared by their counts, never collected.
    """
    def has(run: str) -> Column:
        return F.max(F.when(F.col("run") == run, 1).otherwise(0))

    per_code = assignments.groupBy("app", "name", "code").agg(has("first").alias("a"), has("repeat").alias("b"))
    per_review = per_code.groupBy("app", "name").agg(
        F.sum("a").alias("na"), F.sum("b").alias("nb"), F.sum(F.col("a") * F.col("b")).alias("nab")
    )
    same = F.sum(F.when((F.col("na") == F.col("nab")) & (F.col("nb") == F.col("nab")), 1).otherwise(0))
    jaccard = F.col("nab") / (F.col("na") + F.col("nb") - F.col("nab"))
    total = F.count(F.lit(1))
    # decimals add up to the same value in any order
    mean_jaccard = F.sum(jaccard.cast("decimal(18,12)")).cast("double") / total
    return per_review.groupBy("app").agg(
        total.alias("n_reviews"), same.alias("n_same"), bands.share(same, total).alias("agreement"),
        F.round(mean_jaccard, 9).alias("mean_jaccard"), bands.gold_band(same, total).alias("band"),
    )


def drifting_quotes(codings: DataFrame) -> DataFrame:
    """Quotes whose code set is not the same in all batches they occur in.

    All sets are equal exactly when every code of the quote occurs in every batch of the quote, that
    is when the number of (batch, code) pairs is batches times codes; so counts are enough.
    """
    hashed = codings.withColumn("_quote", F.unhex(F.md5("quote")))  # counted by a 128-bit hash; texts come back for the few that drift
    triples = hashed.select("app", "_quote", "batch_id", "code").distinct()
    per_code = triples.groupBy("app", "_quote", "code").agg(F.count(F.lit(1)).alias("n"))
    codes = per_code.groupBy("app", "_quote").agg(F.count(F.lit(1)).alias("n_codes"), F.sum("n").alias("n_pairs")).filter("n_codes > 1")
    per_batch = triples.groupBy("app", "_quote", "batch_id").agg(F.lit(1).alias("_one"))
    batches = per_batch.groupBy("app", "_quote").agg(F.count(F.lit(1)).alias("n_batches"))
    drifting = codes.join(batches, ["app", "_quote"]).filter(F.col("n_pairs") != F.col("n_codes") * F.col("n_batches"))
    named = hashed.select("app", "_quote", "quote").join(drifting, ["app", "_quote"])
    return named.select("app", "quote", "n_batches", "n_codes", "n_pairs").distinct()


def overlapping_codes(codings: DataFrame, min_jaccard: float = 0.0) -> DataFrame:
    """Code pairs that share quotes, with the Jaccard index of their quote sets.

    Quotes that carry the same codes are counted together first, so pairs are formed once per
    distinct code set, which the size of the codebook bounds, and not once per quote.
    """
    distinct = codings.select("app", "code", "quote").distinct()
    sizes = distinct.groupBy("app", "code").agg(F.count(F.lit(1)).alias("n"))
    code_sets = distinct.groupBy("app", "quote").agg(F.array_sort(F.collect_list("code")).alias("codes"))
    code_sets = code_sets.filter(F.size("codes") > 1).groupBy("app", "codes").agg(F.count(F.lit(1)).alias("w"))
    first = code_sets.select("app", "w", "codes", F.posexplode("codes").alias("_i", "code_a"))
    later = F.slice("codes", F.col("_i") + 2, F.size("codes"))
    pairs = first.select("app", "w", "code_a", F.explode(later).alias("code_b"))
    shared = pairs.groupBy("app", "code_a", "code_b").agg(F.sum("w").alias("n_shared"))
    a = sizes.select("app", F.col("code").alias("code_a"), F.col("n").alias("n_a"))
    b = sizes.select("app", F.col("code").alias("code_b"), F.col("n").alias("n_b"))
    jaccard = F.col("n_shared") / (F.col("n_a") + F.col("n_b") - F.col("n_shared"))
    return shared.join(a, ["app", "code_a"]).join(b, ["app", "code_b"]).select(
        "app", "code_a", "code_b", "n_a", "n_b", "n_shared", jaccard.alias("jaccard")
    ).filter(F.col("jaccard") >= min_jaccard)


def similar_codes(codings: DataFrame, part: int = 1, whole: int = 2) -> DataFrame:
    """Code pairs whose quote sets have a Jaccard index of ``part / whole`` or more, a positive share: merge candidates.

    All pairs are counted exactly, block by block, and only similar ones leave a task (``operators/overlaps.py``).
    """
    if not 0 < part <= whole:
        raise ValueError("the share must be positive and at most 1")
    pairs = pairs_over(codings, part, whole)
    return pairs.withColumn("jaccard", F.col("n_shared") / (F.col("n_a") + F.col("n_b") - F.col("n_shared")))


def similar_candidates(sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs of ``sets`` (``app, code, _q``) that share a quote of their prefixes and fit in size: ``app, code_a, code_b, n_a, n_b``.

    Quotes are put in one order, rare ones first. Two sets that are similar enough share one of the first
    n - ceil(n * part / whole) + 1 quotes of each (Chaudhuri et al., A primitive operator for similarity joins, 2006). This pays
    for high shares only: at low ones nearly all quotes are in the prefix, so ``similar_codes`` counts pairs in blocks instead.
    """
    sizes = sets.groupBy("app", "code").agg(F.count(F.lit(1)).alias("n"))
    carried = sets.groupBy("app", "_q").agg(F.count(F.lit(1)).alias("_codes"))
    # ordered by the number of codes of a quote, then by its hash; the slot is the beginning of that order
    order = F.concat(F.lpad(F.col("_codes").cast("string"), 12, "0"), F.hex("_q"))
    keyed = sets.join(carried, ["app", "_q"]).select("app", "code", "_q", "_codes", order.alias("_order"))
    placed = number_rows(keyed, ["app", "code"], ["_order"], F.substring("_order", 1, 14), "_place")
    prefix = F.col("n") - F.ceil(F.col("n") * part / whole) + 1
    kept = placed.join(sizes, ["app", "code"]).filter((F.col("_place") <= prefix) & (F.col("_codes") > 1))

    def side(x: str) -> DataFrame:
        return kept.select("app", "_q", F.col("code").alias(f"code_{x}"), F.col("n").alias(f"n_{x}"))

    fits = (F.col("n_a") * part <= F.col("n_b") * whole) & (F.col("n_b") * part <= F.col("n_a") * whole)
    both = side("a").join(side("b"), ["app", "_q"]).filter((F.col("code_a") < F.col("code_b")) & fits)
    return both.select("app", "code_a", "code_b", "n_a", "n_b").distinct()


# --- size of the codebook -----------------------------------------------------------------------

def codebook_size(codings: DataFrame) -> DataFrame:
    """Observed batches, codes and themes per app, each by its own two-step count over the distinct combinations, which are
    worked out once."""
    combinations = materialise(codings.select("app", "batch_id", "code", "theme").distinct())

    def n(column: str, out: str) -> DataFrame:
        return combinations.select("app", column).distinct().groupBy("app").agg(F.count(column).alias(out))

    return n("batch_id", "n_batches").join(n("code", "n_codes"), "app").join(n("theme", "n_themes"), "app").withColumn(
        "bloated", (F.col("n_batches") > fixed.BLOAT_BATCHES) & (F.col("n_codes") > fixed.BLOAT_CODES)
    )


def against_expectations(sizes: DataFrame, expectations: DataFrame) -> DataFrame:
    """Compare with the researcher's ``app, measure, low, high``; sizes carry one column per measure."""
    measures = [c for c in sizes.columns if c not in ("app", "bloated")]
    long = sizes.unpivot(["app", "bloated"], measures, "measure", "observed")
    return long.join(expectations, ["app", "measure"]).select(
        "app", "measure", F.col("observed").cast("double").alias("observed"), "low", "high",
        F.col("observed").between(F.col("low"), F.col("high")).alias("as_expected"), "bloated",
    )


def codebook_completeness(codebook: DataFrame, codings: DataFrame) -> DataFrame:
    """Per code: definition, paired include and exclude rules, three samples, samples real quotes."""
    samples = codebook.select("app", "code", F.explode("samples").alias("quote"))
    real = codings.select("app", "code", "quote").distinct()
    unreal = samples.join(real, ["app", "code", "quote"], "left_anti").groupBy("app", "code").agg(
        F.count(F.lit(1)).alias("n_unreal")
    )
    def filled(c: str) -> Column:
        return F.coalesce(F.size(c) > 0, F.lit(False))

    n_samples = F.when(F.col("samples").isNull(), 0).otherwise(F.size("samples"))
    return codebook.join(unreal, ["app", "code"], "left").select(
        "app", "theme", "code",
        (text.strip_blank(F.coalesce("definition", F.lit(""))) != "").alias("has_definition"),
        (filled("include") & filled("exclude")).alias("has_both_rules"),
        n_samples.cast("long").alias("n_samples"), (n_samples >= fixed.MIN_SAMPLES).alias("enough_samples"),
        F.coalesce("n_unreal", F.lit(0)).cast("long").alias("n_unreal_samples"),
    )
