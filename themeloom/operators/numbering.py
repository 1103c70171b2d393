"""Positions, running totals and rolling windows that do not put a whole group into one task.

A window over ``partition by app`` alone would sort one app in one task, and one app may hold most
of the rows. Here a group is cut into ordered slots: totals per slot are small, are summed up over
the slots, and the fine order is worked out slot by slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.session import materialise

# A group known to hold no more rows than this is numbered by one plain window.
WINDOW_ROWS = 1_000_000
# Consecutive batches per slot.
BATCHES_PER_SLOT = 10_000


def batch_slot(batch_id="batch_id") -> Column:
    return F.floor(F.col(batch_id) / BATCHES_PER_SLOT)


#: Hex digits of a hash slot.
SLOT_DIGITS = 3


def hash_slot(key: str, digits: int = SLOT_DIGITS) -> Column:
    """Leading hex digits of a hash: ordered like the hash and evenly filled."""
    return F.substring(key, 1, digits)


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], slot: Column,
    position: str, bound: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in its group.

    ``slot`` must not decrease along ``order``. ``bound`` is a proven upper limit of rows per group;
    with it small the plain window is the cheaper plan, and the result is the same.
    """
    if bound is not None and bound <= WINDOW_ROWS:
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(position, F.row_number().over(w).cast("long"))
    return _by_slot(materialise(df), group, order, slot, position, {})


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], slot: Column,
    position: str, totals: dict[str, str],
) -> DataFrame:
    """Position and running sums (``{output: summed column}``). ``df`` is read twice: pass a table
    or a materialised result."""
    return _by_slot(df, group, order, slot, position, totals)


def _by_slot(df, group, order, slot, position, totals) -> DataFrame:
    slotted = df.withColumn("_slot", slot)
    per_slot = slotted.groupBy(*group, "_slot").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{o}") for o, c in totals.items()]
    )
    earlier = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slot.select(
        *group, "_slot",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.coalesce(F.sum(f"_sum_{o}").over(earlier), F.lit(0)).alias(f"_before_{o}") for o in totals],
    )
    within = Window.partitionBy(*group, "_slot").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    ranked = slotted.select(
        "*", F.row_number().over(within).alias("_rank"),
        *[F.sum(c).over(upto).alias(f"_upto_{o}") for o, c in totals.items()],
    )
    return ranked.join(offsets, [*group, "_slot"]).select(
        *[F.col(c) for c in df.columns],
        (F.col("_rank") + F.col("_rows_before")).cast("long").alias(position),
        *[(F.col(f"_upto_{o}") + F.col(f"_before_{o}")).cast("long").alias(o) for o in totals],
    )


def rolling(df: DataFrame, group: Sequence[str], ordinal: str, width: int, aggs: Sequence[Column]) -> DataFrame:
    """Aggregates over the last ``width`` ordinals, one row per (group, ordinal) that saw any row.

    Each row is sent to the ``width`` windows it belongs to, so the work is a plain aggregation on
    (group, ordinal) that combines before the shuffle and has no hot group.
    """
    ahead = F.explode(F.sequence(F.col(ordinal), F.col(ordinal) + F.lit(width - 1)))
    return df.withColumn(ordinal, ahead).groupBy(*group, ordinal).agg(*aggs)


def islands(df: DataFrame, group: Sequence[str], ordinal: str, per_slot: int = BATCHES_PER_SLOT) -> DataFrame:
    """Runs of consecutive ordinals per group: ``group, start, stop, length``.

    Runs are found slot by slot. Those that touch neither end of their slot are whole; the others, two at most in a slot, are joined in a
    second step over the slots, so no window sees all ordinals of a group.
    """
    slot = F.floor((F.col(ordinal) - 1) / per_slot)
    rows = df.select(*group, F.col(ordinal).cast("long").alias("_at"), slot.alias("_slot")).distinct()
    w = Window.partitionBy(*group, "_slot").orderBy("_at")
    pieces = rows.withColumn("_run", F.col("_at") - F.row_number().over(w)).groupBy(*group, "_slot", "_run").agg(
        F.min("_at").alias("start"), F.max("_at").alias("stop")
    )
    at_edge = ((F.col("start") - 1) % per_slot == 0) | (F.col("stop") % per_slot == 0)
    by = Window.partitionBy(*group).orderBy("start")
    opens = F.when(F.lag("stop").over(by) == F.col("start") - 1, 0).otherwise(1)
    edges = pieces.filter(at_edge).withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(by))
    joined = edges.groupBy(*group, "_island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    both = pieces.filter(~at_edge).select(*group, "start", "stop").unionByName(joined.select(*group, "start", "stop"))
    return both.withColumn("length", F.col("stop") - F.col("start") + 1)
