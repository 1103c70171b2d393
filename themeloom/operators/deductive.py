"""Applying a finished dictionary to new reviews, and what it leaves uncovered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from themeloom.functions import bands, fixed
from themeloom.operators.numbering import islands, rolling
from themeloom.operators.phrases import AUTOMATON_CHARS, find_phrases


def match_dictionary(reviews: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(app, name, code, term) for every term a review contains; a review may get several codes.

    ``reviews`` holds ``app, name, review_norm``, ``dictionary`` ``app, code, term``.
    """
    terms = dictionary.select("app", "code", F.col("term").alias("phrase"))
    found = find_phrases(reviews, terms, ["app"], carry="code", automaton_chars=AUTOMATON_CHARS)
    return found.select("app", "name", "code", F.col("phrase").alias("term"))


def code_reviews(reviews: DataFrame, matches: DataFrame) -> DataFrame:
    """Codes per review; reviews without a match get the fallback code."""
    codes = matches.select("app", "name", "code").distinct()
    keep = [c for c in ("app", "batch_id", "name") if c in reviews.columns]
    return reviews.select(*keep).join(codes, ["app", "name"], "left").withColumn(
        "code", F.coalesce("code", F.lit(fixed.OTHER_CODE))
    )


def uncovered_reviews(reviews: DataFrame, matches: DataFrame) -> DataFrame:
    return reviews.join(matches.select("app", "name").distinct(), ["app", "name"], "left_anti")


def gap_rate(reviews: DataFrame, matches: DataFrame) -> DataFrame:
    """Unmatched share per batch and what it calls for."""
    hit = matches.select("app", "name").distinct().withColumn("_hit", F.lit(1))
    rows = reviews.select("app", "batch_id", "name").join(hit, ["app", "name"], "left")
    total, gaps = F.count(F.lit(1)), F.count(F.lit(1)) - F.count("_hit")
    return rows.groupBy("app", "batch_id").agg(
        total.alias("n_reviews"), gaps.alias("n_unmatched"), bands.share(gaps, total).alias("gap_share"),
        bands.gap_band(gaps, total).alias("band"),
    )


def deductive_summary(coded: DataFrame, gap_label: DataFrame | None = None) -> DataFrame:
    """Reviews per matched code, and per label of the gap for unmatched ones (``app, name, label``)."""
    is_gap = F.col("code") == fixed.OTHER_CODE
    rows = coded.withColumn("label", F.col("code"))
    if gap_label is not None:
        rows = coded.join(gap_label.select("app", "name", "label"), ["app", "name"], "left").withColumn(
            "label", F.when(is_gap, F.coalesce("label", F.lit(fixed.OTHER_CODE))).otherwise(F.col("code"))
        )
    return rows.groupBy("app", (~is_gap).alias("matched"), "label").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.min(F.struct(F.length("name"), "name"))["name"].alias("example")
    )


def deductive_quotes(matches: DataFrame, uncovered: DataFrame, k: int = 2) -> DataFrame:
    """Per batch and code: quotes and up to k representative ones; the same for each label of the gap.

    ``matches`` holds ``app, batch_id, name, code, term`` (the term found is the quote), ``uncovered`` ``app, batch_id, name,
    label, review_norm`` (the review is the quote). Each task keeps k quotes of a group before anything is shuffled.
    """
    group = ["app", "batch_id", "matched", "label"]
    rows = matches.select("app", "batch_id", F.lit(True).alias("matched"), F.col("code").alias("label"), F.col("term").alias("quote")).unionByName(
        uncovered.select("app", "batch_id", F.lit(False).alias("matched"), "label", F.col("review_norm").alias("quote"))
    )
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n_quotes"))
    w = Window.partitionBy(*group).orderBy(F.length("quote"), "quote")
    best = rows.distinct().withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).groupBy(*group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "quote"))), lambda q: q["quote"]), " | ").alias("quotes")
    )
    return counts.join(best, group)


def recurring_gaps(gaps: DataFrame, batch_ordinals: DataFrame) -> DataFrame:
    """Batches in which a gap label completes (or goes on with) a run of three batches.

    ``gaps`` holds ``app, batch_id, label``; three consecutive ordinals with the label are three copies
    that meet in one (label, ordinal) group, so no window over all batches of a label is needed.
    """
    seen = gaps.select("app", "batch_id", "label").distinct()
    at = seen.join(batch_ordinals.select("app", "batch_id", "ordinal"), ["app", "batch_id"])
    runs = rolling(at.select("app", "label", "ordinal"), ["app", "label"], "ordinal", fixed.GAP_RUN, [F.count(F.lit(1)).alias("n")])
    full = runs.filter(F.col("n") == fixed.GAP_RUN)
    return full.join(batch_ordinals.select("app", "batch_id", "ordinal"), ["app", "ordinal"]).select("app", "label", "batch_id")


def gap_islands(gaps: DataFrame, batch_ordinals: DataFrame, least: int = fixed.GAP_RUN) -> DataFrame:
    """Stretches of ``least`` or more consecutive batches with the same gap label: ``app, label, first_batch, last_batch, n_batches``.

    ``gaps`` holds ``app, batch_id, label``; ``batch_ordinals`` counts the batches of an app from 1.
    """
    ordinals = batch_ordinals.select("app", "batch_id", "ordinal")
    at = gaps.select("app", "batch_id", "label").distinct().join(ordinals, ["app", "batch_id"])
    long = islands(at, ["app", "label"], "ordinal").filter(F.col("length") >= least)
    first = ordinals.select("app", F.col("ordinal").alias("start"), F.col("batch_id").alias("first_batch"))
    last = ordinals.select("app", F.col("ordinal").alias("stop"), F.col("batch_id").alias("last_batch"))
    named = long.join(first, ["app", "start"]).join(last, ["app", "stop"])
    return named.select("app", "label", "first_batch", "last_batch", F.col("length").alias("n_batches"))
