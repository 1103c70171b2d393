"""New codes batch by batch, cumulative codes, rolling mean and saturation status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.functions import bands, fixed, text
from themeloom.operators.numbering import batch_slot, rolling, running_totals
from themeloom.session import materialise

_WIDTH = fixed.SATURATION_WINDOW


def new_codes(codings: DataFrame, coded_batches: DataFrame | None = None) -> DataFrame:
    """Codes per batch that no earlier batch had: count codes by the batch they were first seen in.

    ``coded_batches`` adds batches that have a file but no valid row. Each distinct batch gives one
    row, however many theme files it has.
    """
    codings = codings.filter("batch_id IS NOT NULL")  # what names no batch has no place in the order
    code = text.strip_blank("code")
    named = codings.select("app", "batch_id", code.alias("code")).filter(F.col("code") != "")
    first_seen = named.groupBy("app", "code").agg(F.min("batch_id").alias("batch_id"))
    per_first = first_seen.groupBy("app", "batch_id").agg(F.count(F.lit(1)).alias("n_new"))
    batches = codings.select("app", "batch_id")
    if coded_batches is not None:
        batches = batches.unionByName(coded_batches.select("app", "batch_id").filter("batch_id IS NOT NULL"))
    return batches.distinct().join(per_first, ["app", "batch_id"], "left").select(
        "app", "batch_id", F.coalesce("n_new", F.lit(0)).cast("long").alias("n_new")
    )


def with_entries(per_batch: DataFrame, entry_counts: DataFrame) -> DataFrame:
    """Attach the number of entries of each batch, 0 when the batch text is missing."""
    return per_batch.join(entry_counts.select("app", "batch_id", "n_entries"), ["app", "batch_id"], "left").withColumn(
        "n_entries", F.coalesce("n_entries", F.lit(0)).cast("long")
    )


def with_new_rate(per_batch: DataFrame) -> DataFrame:
    rate = F.when(F.col("n_entries") > 0, F.col("n_new") * F.lit(100.0) / F.col("n_entries")).otherwise(F.lit(0.0))
    return per_batch.withColumn("new_rate", rate)


def with_totals(per_batch: DataFrame) -> DataFrame:
    """Ordinal of the batch among coded batches and codes seen so far."""
    stored = materialise(per_batch)
    return running_totals(stored, ["app"], ["batch_id"], batch_slot(), "ordinal", {"n_codes_total": "n_new"})


def with_rolling(totals: DataFrame) -> DataFrame:
    """Mean of new codes over the last three coded batches, its band, and the stop rule."""
    last = rolling(
        totals.select("app", "ordinal", "n_new"), ["app"], "ordinal", _WIDTH,
        [F.sum("n_new").alias("_sum"), F.max("n_new").alias("_max")],
    )
    full = F.col("ordinal") >= _WIDTH
    return (
        totals.join(last, ["app", "ordinal"])
        .withColumn("rolling_mean", F.when(full, F.col("_sum").cast("double") / _WIDTH))
        .withColumn("status", bands.saturation_status(F.col("rolling_mean")))
        .withColumn("all_last3_le2", full & (F.col("_max") <= fixed.STOP_RULE_NEW_CODES))
        .drop("_sum", "_max")
    )


def saturation_report(
    codings: DataFrame, entry_counts: DataFrame, coded_batches: DataFrame | None = None, fail_on_empty: bool = False
) -> DataFrame:
    """One row per app and coded batch, all numeric; sort by batch for display. ``fail_on_empty`` makes no coded batch an error."""
    if fail_on_empty and codings.filter("batch_id IS NOT NULL").isEmpty() and (coded_batches is None or coded_batches.isEmpty()):
        raise ValueError("there is no coded batch")
    per_batch = with_new_rate(with_entries(new_codes(codings, coded_batches), entry_counts))
    return with_rolling(with_totals(per_batch)).select(
        "app", "batch_id", "ordinal", "n_codes_total", "n_new", "n_entries", "new_rate", "rolling_mean", "status",
        "all_last3_le2",
    )


def final_status(report: DataFrame) -> DataFrame:
    """The verdict per app, taken from its last coded batch."""
    last = F.max_by(F.struct("batch_id", "rolling_mean", "status", "all_last3_le2", "n_codes_total"), "batch_id")
    return report.groupBy("app").agg(last.alias("l")).select("app", "l.*")
