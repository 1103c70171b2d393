"""Mixing sources to target weights by Pfair scheduling.

The documents of each source, in the order of a hash of doc_id, are cut into blocks of ``block`` documents. Each source has a
target: the slots are shared in proportion to the weights, exactly and over the whole run; once a source's blocks are used up,
the others share the slots in proportion to theirs. With ``T(v)`` = sum over sources of min(weight * v, blocks), block i of a
source of weight w is released at slot floor(T(i / w)) and due by slot ceil(T((i + 1) / w)); each slot takes the released
block that is due first (ties: the source that sorts first). So at each slot no source is a whole block away from its target,
also after others ran out; no document is dropped or repeated.

The order depends on the sources' counts and weights only. The driver works it out with two heaps in exact integers, in
time blocks * log(sources), from a row for each source, of which there may be any number; the documents are numbered and
joined to it with DataFrame functions. Weights default to the square root of a source's documents. A null source is a source
of its own and sorts first. Rows that repeat a doc_id are told apart by text; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from fractions import Fraction
from math import isfinite, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Documents of a block. The cycle serves the SQL twin only.
BLOCK, CYCLE = 16, 400
#: Blocks whose slots are broadcast; more are joined by a shuffle.
SENT = 1_000_000
#: Documents are numbered within hash slots; a slot holds about this many rows.
SLOT_ROWS = 2000
HEX = 6


def _numbered(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``docs`` with ``rank``, their number within the source from 0, in the order of ``_key``.

    Rows are numbered within (source, leading digits of the key), so a large source is many small windows; the rows before
    a slot come from running sums over the slots.
    """
    digits = F.least(F.lit(HEX), F.ceil(F.log(16.0, F.greatest(F.col("docs") / SLOT_ROWS, F.lit(1.0))))).cast("int")
    # one row for each source
    cut = docs.join(F.broadcast(counts.select("_source", "_index", digits.alias("digits"))), "_source")
    cut = cut.withColumn("_slot", F.substring("_key", F.lit(1), F.col("digits"))).drop("digits")
    # slots of a source number about its documents / SLOT_ROWS; their sizes are summed up in two steps
    sizes = cut.groupBy("_source", "_slot").agg(F.count("*").alias("n")).withColumn("_lead", F.substring("_slot", 1, 2))
    leads = sizes.groupBy("_source", "_lead").agg(F.sum("n").alias("n"))
    over = Window.partitionBy("_source").orderBy("_lead").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows at most
    leads = leads.select("_source", "_lead", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("lead_before"))
    before = Window.partitionBy("_source", "_lead").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(leads, ["_source", "_lead"])
    sizes = sizes.select("_source", "_slot", (F.col("lead_before") + F.col("before")).alias("before"))
    within = Window.partitionBy("_source", "_slot").orderBy("_key", "_tie")
    ranked = cut.withColumn("_row", F.row_number().over(within))
    return ranked.join(sizes, ["_source", "_slot"]).withColumn("rank", F.col("before") + F.col("_row") - 1).drop("before", "_row", "_slot")


def order_of(weights: Sequence[float], blocks: Sequence[int]) -> np.ndarray:
    """For each slot the index of the source whose block it takes."""
    if not all(isfinite(w) and w > 0 for w in weights):
        raise ValueError("weights have to be positive")
    exact = [Fraction(w) for w in weights]
    scale = lcm(*[w.denominator for w in exact])
    w = [int(x * scale) for x in exact]
    # sources in the order in which their targets run out, the blocks of those before and the weights of those left
    ends = sorted(range(len(w)), key=lambda s: Fraction(blocks[s], w[s]))
    gone, left = [0], [sum(w)]
    for s in ends:
        gone.append(gone[-1] + blocks[s])
        left.append(left[-1] - w[s])
    past = [0] * len(w)  # sources whose targets had run out at the end of the last window looked at, for each source

    def window(s: int, i: int) -> tuple[int, int]:
        """Release and due slot of block ``i``."""
        release = (gone[past[s]] * w[s] + left[past[s]] * i) // w[s]
        while past[s] < len(ends) and blocks[ends[past[s]]] * w[s] <= (i + 1) * w[ends[past[s]]]:
            past[s] += 1
        return release, -(-(gone[past[s]] * w[s] + left[past[s]] * (i + 1)) // w[s])

    order, done = np.empty(sum(blocks), np.int32), [0] * len(w)
    waiting = [(release, s, due) for s in range(len(w)) if blocks[s] for release, due in [window(s, 0)]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []
    for slot in range(len(order)):
        while waiting and waiting[0][0] <= slot:
            _, s, due = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s))
        s = heapq.heappop(ready)[1]
        order[slot] = s
        done[s] += 1
        if done[s] < blocks[s]:
            release, due = window(s, done[s])
            heapq.heappush(waiting, (release, s, due))
    return order


def _schedule(docs: DataFrame, order: np.ndarray) -> DataFrame:
    """_index of the source, block_no and slot of every block."""
    slot = np.argsort(order, kind="stable")
    index = order[slot]
    begin = np.flatnonzero(np.r_[True, index[1:] != index[:-1]]) if len(index) else np.zeros(0, int)
    block_no = np.arange(len(index)) - np.repeat(begin, np.diff(np.r_[begin, len(index)]))
    rows = pa.table({"_index": pa.array(index, pa.int32()), "block_no": pa.array(block_no, pa.int64()), "slot": pa.array(slot, pa.int64())})
    schedule = docs.sparkSession.createDataFrame(rows)
    return F.broadcast(schedule) if len(order) <= SENT else schedule


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, cycle: int = CYCLE) -> DataFrame:
    """``docs`` with ``block_no`` (within the source, from 0), ``slot`` (of the block in the mix, from 0) and
    ``place`` (of the document in its block, from 0); sorting by slot and place gives the mix.

    ``weights`` maps sources to positive weights; a source without one is an error. ``cycle`` has no effect: targets hold over
    the whole run.
    """
    docs = docs.drop("block_no", "slot", "place")
    tie = F.xxhash64("text") if "text" in docs.columns else F.lit(0)
    # a null source sorts first and equals itself; the order of documents is that of a hash, of equal ids that of the text
    work = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_source"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_key"), tie.alias("_tie"),
    )
    counts = work.groupBy("_source").agg(F.count("*").alias("docs"))
    if weights is None:
        weight = F.sqrt(F.col("docs").cast("double"))
    else:
        given = F.create_map(*[x for k, w in sorted(weights.items()) for x in (F.lit(k), F.lit(float(w)))])
        weight = F.coalesce(given[F.substring("_source", F.lit(2), F.length("_source"))], F.raise_error(F.lit("a source has no weight")).cast("double"))
    counts = counts.withColumn("weight", weight).withColumn("blocks", F.ceil(F.col("docs") / block).cast("long"))
    sources = sorted(counts.collect(), key=lambda r: r["_source"])  # a row for each source
    order = order_of([r["weight"] for r in sources], [r["blocks"] for r in sources])
    rows = [(r["_source"], r["docs"], k) for k, r in enumerate(sources)]
    counts = docs.sparkSession.createDataFrame(rows, "_source string, docs bigint, _index int")
    numbered = _numbered(work, counts).withColumn("block_no", F.floor(F.col("rank") / block).cast("long"))
    numbered = numbered.withColumn("place", (F.col("rank") % block).cast("int"))
    return numbered.join(_schedule(docs, order), ["_index", "block_no"]).select("_doc.*", "block_no", "slot", "place")


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, source and position of every document; text only breaks ties and is not moved."""
    narrow = docs.select("doc_id", "source", F.xxhash64("text").alias("text"))
    return mix(narrow).select("doc_id", "source", "block_no", "slot", "place")
