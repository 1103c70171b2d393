"""Codebook evolution: decisions, canonical codes, upserts and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from themeloom import schemas
from themeloom.operators.numbering import batch_slot
from themeloom.session import materialise


# --- decisions ----------------------------------------------------------------------------------

def code_events(decisions: DataFrame) -> DataFrame:
    """One event per code of a decision: sources stop being active, targets become active. ``target``
    is the successor of a merged or renamed source; ``n_targets`` tells splits and deletions apart."""
    base = decisions.withColumn("_n", F.when(F.col("target_codes").isNull(), 0).otherwise(F.size("target_codes")))
    sources = base.select(
        "app", F.explode("source_codes").alias("code"), "batch_id", "seq", F.lit(False).alias("active"), "type",
        F.when(F.col("_n") == 1, F.get("target_codes", F.lit(0))).alias("target"), F.col("_n").alias("n_targets"),
    )
    targets = base.select(
        "app", F.explode("target_codes").alias("code"), "batch_id", "seq", F.lit(True).alias("active"), "type",
        F.lit(None).cast("string").alias("target"), F.lit(0).alias("n_targets"),
    )
    return sources.unionByName(targets)


def _latest(events: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Last event per key; within one decision the target role wins. ``max_by`` combines before the
    shuffle, a window would sort all events of a key."""
    order = F.struct("batch_id", "seq", "active")
    return events.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_e")).select(*keys, "_e.*")


def revived_codes(codings: DataFrame, decisions: DataFrame) -> DataFrame:
    """Codes used in a batch after a decision retired them, unless a later decision brought them back.

    Codings are counted per (code, batch) before the join, and each code's decisions become intervals
    of batches, so a code meets each decision at most once.
    """
    events = code_events(decisions)
    w = Window.partitionBy("app", "code").orderBy("batch_id", "seq", "active")
    spans = events.withColumn("_until", F.lead("batch_id").over(w)).filter(~F.col("active"))
    spans = spans.select("app", "code", F.col("batch_id").alias("retired_in"), "type", "_until")
    used = codings.groupBy("app", "batch_id", "code").agg(F.count(F.lit(1)).alias("n_quotes"))
    after = (F.col("batch_id") > F.col("retired_in")) & (F.col("_until").isNull() | (F.col("batch_id") <= F.col("_until")))
    return used.join(spans, ["app", "code"]).filter(after).select(
        "app", "batch_id", "code", "n_quotes", "retired_in", "type"
    )


def canonical_map(decisions: DataFrame) -> DataFrame:
    """(app, code, canonical, status) for every code whose last decision retired it.

    Chains are followed by pointer jumping: each round doubles the length of chain that is resolved,
    so log2(chain) small joins do. ``status`` is mapped, deleted or split (must be recoded); only
    mapped codes get a new name. A circle cannot arise: a decision makes its target active, so each
    code of a chain was retired later than the one before it.
    """
    last = _latest(code_events(decisions), ["app", "code"], ["active", "target", "n_targets"])
    last = materialise(last.filter(~F.col("active")).select("app", "code", "target", "n_targets"))
    ends = last.filter(F.col("target").isNull()).select(
        "app", "code", F.lit(None).cast("string").alias("canonical"),
        F.when(F.col("n_targets") > 1, "split").otherwise("deleted").alias("status"),
    )
    hops = last.filter(F.col("target").isNotNull()).select("app", "code", "target")
    while True:
        onward = hops.select("app", F.col("code").alias("target"), F.col("target").alias("_next"))
        if hops.join(onward, ["app", "target"], "left_semi").isEmpty():
            break
        step = hops.join(onward, ["app", "target"], "left")
        hops = materialise(step.select("app", "code", F.coalesce("_next", "target").alias("target")))
    stop = ends.select("app", F.col("code").alias("target"), F.col("status").alias("_stop"))
    chained = hops.join(stop, ["app", "target"], "left").select(
        "app", "code", F.when(F.col("_stop").isNull(), F.col("target")).alias("canonical"),
        F.coalesce("_stop", F.lit("mapped")).alias("status"),
    )
    return chained.unionByName(ends)


def canonicalise(codings: DataFrame, code_map: DataFrame) -> DataFrame:
    """Codings with their canonical code. Codes that were split or deleted keep their name and
    carry the status, for a person to recode."""
    renamed = code_map.select("app", "code", "canonical", "status")
    return codings.join(renamed, ["app", "code"], "left").withColumn(
        "canonical", F.coalesce("canonical", "code")
    ).withColumn("status", F.coalesce("status", F.lit("kept")))


# --- codebook table -----------------------------------------------------------------------------

def upsert_codebook(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply changes ``app, code, batch_id, seq, deleted`` + codebook columns; the last one wins, a
    tombstone removes the code. ``current`` has the same columns."""
    rows = current.unionByName(changes, allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in ("app", "code")]
    last = F.max_by(F.struct(*rest), F.struct("batch_id", "seq"))
    return rows.groupBy("app", "code").agg(last.alias("_r")).select("app", "code", "_r.*").filter(
        ~F.coalesce("deleted", F.lit(False))
    ).drop("deleted")


def read_change_log(documents: DataFrame, column: str = "json") -> DataFrame:
    """Changes of log documents ``app, json``, one row each. A document is the file with its ``batches``
    list or a single batch record."""
    whole = T.StructType([T.StructField("batches", T.ArrayType(schemas.CHANGE_LOG))] + schemas.CHANGE_LOG.fields)
    parsed = documents.select("app", F.from_json(column, whole).alias("d"))
    single = F.array(F.struct(*[F.col(f"d.{f}").alias(f) for f in schemas.CHANGE_LOG.fieldNames()]))
    batches = parsed.select("app", F.explode(F.coalesce("d.batches", single)).alias("b"))
    return batches.select(
        "app", F.col("b.batch_id").cast("long").alias("batch_id"), F.col("b.timestamp").alias("timestamp"),
        F.col("b.codebook_version").alias("codebook_version"), F.posexplode("b.changes").alias("seq", "c"),
    ).select("app", "batch_id", "timestamp", "codebook_version", "seq", "c.*")


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("app", "batch_id", "type").agg(
        F.count(F.lit(1)).alias("n_changes"), F.sum(F.coalesce("codes_count", F.lit(0))).cast("long").alias("n_initial_codes")
    )


def change_matrix(changes: DataFrame) -> DataFrame:
    """Changes per batch with one column per kind."""
    kinds = ["initial", "add", "merge", "split", "rename", "delete"]
    counts = [F.count(F.when(F.col("type") == k, 1)).alias(f"n_{k}") for k in kinds]
    return changes.groupBy("app", "batch_id").agg(*counts)


def codebook_as_of(codings: DataFrame, decisions: DataFrame, batch_id: int) -> DataFrame:
    """Codes active after a batch: first uses up to then, and the last decision on each code."""
    first = codings.groupBy("app", "code").agg(F.min("batch_id").alias("batch_id"))
    uses = first.withColumn("seq", F.lit(-1)).withColumn("active", F.lit(True))
    made = code_events(decisions).select("app", "code", "batch_id", "seq", "active")
    events = uses.unionByName(made).filter(F.col("batch_id") <= batch_id)
    last = _latest(events, ["app", "code"], ["active", F.col("batch_id").alias("since_batch")])
    return last.filter("active").select("app", "code", "since_batch")


def _states(codings: DataFrame, decisions: DataFrame) -> DataFrame:
    """``app, code, batch_id, active``: the state of a code from each batch on in which a use or a decision set it."""
    first = codings.groupBy("app", "code").agg(F.min("batch_id").alias("batch_id"))
    uses = first.withColumn("seq", F.lit(-1)).withColumn("active", F.lit(True))
    made = code_events(decisions).select("app", "code", "batch_id", "seq", "active")
    return _latest(uses.unionByName(made).filter("batch_id IS NOT NULL"), ["app", "code", "batch_id"], ["active"])


def codebook_versions(codings: DataFrame, decisions: DataFrame) -> DataFrame:
    """The codebook of every batch at once: ``app, code, since_batch, until_batch`` for each time that a code is active.

    Batch b has the codes with ``since_batch <= b`` and ``until_batch`` NULL or later; ``since_batch`` is that of ``codebook_as_of``. The event
    that ends a time is looked for within a range of batches and then among the first events of later ranges.
    """
    states = _states(codings, decisions).withColumn("_slot", batch_slot())
    here = Window.partitionBy("app", "code", "_slot").orderBy("batch_id")
    later = Window.partitionBy("app", "code").orderBy("_slot")
    firsts = states.groupBy("app", "code", "_slot").agg(F.min("batch_id").alias("_first"))
    firsts = firsts.select("app", "code", "_slot", F.lead("_first").over(later).alias("_next"))
    within = states.withColumn("_until", F.lead("batch_id").over(here))
    both = within.join(firsts, ["app", "code", "_slot"]).filter("active")
    return both.select("app", "code", F.col("batch_id").alias("since_batch"), F.coalesce("_until", "_next").alias("until_batch"))


def codings_as_of(codings: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every (app, batch, code) that was used, with its rows and the state that the last event up to that batch left the code in:
    ``app, batch_id, code, n_quotes, active, since_batch``.

    Uses and events are put into one table, ordered by batch, and the last event runs along it, range by range of batches; a
    range begins with the last event of the ranges before.
    """
    uses = codings.filter("batch_id IS NOT NULL").groupBy("app", "code", "batch_id").agg(F.count(F.lit(1)).alias("n_quotes"))
    event = F.struct("batch_id", "active")
    none = F.lit(None).cast("struct<batch_id:bigint,active:boolean>")
    events = _states(codings, decisions).select("app", "code", "batch_id", F.lit(None).cast("bigint").alias("n_quotes"), event.alias("_event"))
    rows = uses.withColumn("_event", none).unionByName(events).withColumn("_slot", batch_slot())
    # of a batch the event comes before the use
    run = Window.partitionBy("app", "code", "_slot").orderBy("batch_id", F.col("n_quotes").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("app", "code").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    lasts = rows.groupBy("app", "code", "_slot").agg(F.max("_event").alias("_last"))
    carried = lasts.select("app", "code", "_slot", F.last("_last", ignorenulls=True).over(before).alias("_from"))
    known = rows.withColumn("_now", F.last("_event", ignorenulls=True).over(run)).filter("n_quotes IS NOT NULL")
    state = F.coalesce("_now", "_from")
    joined = known.join(carried, ["app", "code", "_slot"])
    return joined.select("app", "batch_id", "code", "n_quotes", state["active"].alias("active"), state["batch_id"].alias("since_batch"))
