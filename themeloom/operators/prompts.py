"""Batch texts and prompts for all apps, stages and batches at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.functions import fixed, text

_LAYERS = (1, 2, 3, 4)


def batch_texts(batches: DataFrame) -> DataFrame:
    """One text per batch, entries in sequence order with a blank line between. A batch holds at most
    ``batch_size`` entries by construction."""
    entries = F.array_sort(F.collect_list(F.struct("global_seq", "entry")))
    return batches.groupBy("app", "batch_id").agg(
        F.array_join(F.transform(entries, lambda e: e["entry"]), "\n\n").alias("batch_text"),
        F.count(F.lit(1)).alias("n_entries"),
    )


def unused_lines(unused: DataFrame) -> DataFrame:
    """Unused pool as entries, one row each; the pool is never joined into one text."""
    norm = text.normalise("review")
    return unused.select("app", "name", text.entry("name", "rating", norm).alias("entry"))


def layer_status(layers: DataFrame) -> DataFrame:
    return layers.select(
        "app", "stage", "layer", text.is_placeholder("content").alias("is_placeholder"),
        F.length(F.coalesce("content", F.lit(""))).cast("long").alias("n_chars"),
    )


def missing_layers(apps: DataFrame, layers: DataFrame, stages: tuple[str, ...] = fixed.STAGES) -> DataFrame:
    """Layers an app lacks for a stage: the full grid minus what is there."""
    stage = F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage")
    grid = apps.select("app").distinct().select("app", stage).select(
        "*", F.explode(F.array(*[F.lit(i) for i in _LAYERS])).alias("layer")
    )
    present = layers.filter(F.col("content").isNotNull()).select("app", "stage", "layer")
    return grid.join(present, ["app", "stage", "layer"], "left_anti")


def missing_batches(wanted: DataFrame, batches: DataFrame) -> DataFrame:
    """Batches asked for that have no text."""
    return wanted.join(batches.select("app", "batch_id").distinct(), ["app", "batch_id"], "left_anti")


def _section(title: Column | str, body: Column) -> Column:
    head = F.lit(title) if isinstance(title, str) else title
    rule = F.lit(fixed.PROMPT_RULE + "\n")
    return F.concat(rule, head, F.lit("\n"), rule, body)


def prompt_text(layers: list[Column], batch_text: Column, batch_id: Column) -> Column:
    gap = F.lit("\n\n")
    parts = [F.concat(_section(t, text.strip_blank(c)), gap) for t, c in zip(fixed.PROMPT_TITLES, layers, strict=True)]
    before, after = fixed.PROMPT_BATCH_TITLE.split("{batch_id}")
    title = F.concat(F.lit(before), batch_id.cast("string"), F.lit(after))
    parts.append(F.concat(_section(title, text.strip_blank(batch_text)), gap))
    parts.append(_section(fixed.PROMPT_START_TITLE, F.lit(fixed.PROMPT_START_TEXT)))
    return F.concat(*parts)


def build_prompts(layers: DataFrame, texts: DataFrame) -> DataFrame:
    """Prompts of every batch and stage whose four layers are all there."""
    one = [F.max(F.when(F.col("layer") == i, F.col("content"))).alias(f"layer_{i}") for i in _LAYERS]
    full = layers.groupBy("app", "stage").agg(*one).dropna(subset=[f"layer_{i}" for i in _LAYERS])
    prompt = prompt_text([F.col(f"layer_{i}") for i in _LAYERS], F.col("batch_text"), F.col("batch_id"))
    return texts.join(full, "app").select(
        "app", "stage", "batch_id", prompt.alias("prompt"), F.length(prompt).cast("long").alias("n_chars")
    )


def prompt_sizes(prompts: DataFrame, batches: DataFrame, budget: int) -> DataFrame:
    """Prompt length against a budget, and how many entries of that batch's mean length would fit."""
    entries = batches.groupBy("app", "batch_id").agg(
        F.count(F.lit(1)).alias("n_entries"), F.sum(F.length("entry")).alias("_chars")
    )
    fits = F.floor(F.lit(budget).cast("long") * F.col("n_entries") / F.col("_chars"))
    return prompts.select("app", "stage", "batch_id", "n_chars").join(entries, ["app", "batch_id"]).select(
        "app", "stage", "batch_id", "n_chars", "n_entries", (F.col("n_chars") > budget).alias("over_budget"),
        F.when(F.col("_chars") > 0, fits).cast("long").alias("suggested_batch_size"),
    )
