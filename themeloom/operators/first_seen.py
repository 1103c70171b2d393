"""First-seen codes kept across runs: an arrival of new or corrected batches touches its own codes only.

The state is one append-only log, ``kind, app, batch_id, code, present, arrival``, with a partition for each arrival, so a retried
arrival replaces its own rows and nothing else. Kinds of rows:

* ``batch``: a batch that was not known before;
* ``code``: a code that came into a batch (``present``) or left it when the batch was corrected;
* ``first``: the batch in which a touched code is first seen now, null if it has left all batches.

The content of a batch is that of its last arrival; batches may arrive in any order. The cost of an arrival is a scan of the log and
shuffles of the rows of its batches and codes. Rows without batch or code are left out; an arrival without rows changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.functions import text
from themeloom.session import materialise

LOG_SCHEMA = "kind string, app string, batch_id bigint, code string, present boolean, arrival bigint"


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOG_SCHEMA)


def arrival_rows(log: DataFrame, codings: DataFrame, arrival: int, batches: DataFrame | None = None) -> DataFrame:
    """Rows that one arrival adds to the log.

    ``codings`` has all codings of the batches that arrive. ``batches`` (``app, batch_id``) adds those that have none (any more).
    Rows of ``log`` from this arrival on are not looked at, so a retry gives the same rows.
    """
    before = log.filter(F.col("arrival") < arrival)
    codings = codings.filter("batch_id IS NOT NULL")
    arriving = codings.select("app", "batch_id")
    if batches is not None:
        arriving = arriving.unionByName(batches.filter("batch_id IS NOT NULL").select("app", "batch_id"))
    arriving = materialise(arriving.distinct())
    now = codings.select("app", "batch_id", text.strip_blank("code").alias("code")).filter("code <> ''")
    had = _present(before.filter("kind = 'code'").join(arriving, ["app", "batch_id"], "left_semi"))
    key = ["app", "batch_id", "code"]
    # both sides are read once and meet in one grouping, which combines before the shuffle
    both = now.select(*key, F.lit(True).alias("_now")).unionByName(had.select(*key, F.lit(False).alias("_now")))
    sides = both.groupBy(*key).agg(F.bool_or("_now").alias("present"), F.bool_and("_now").alias("_only_now"))
    changed = sides.filter("present = _only_now").drop("_only_now")
    changed = materialise(changed.withColumn("arrival", F.lit(arrival).cast("long")))

    touched = changed.select("app", "code").distinct()
    held = before.filter("kind = 'code'").select(*key, "present", "arrival").join(touched, ["app", "code"], "left_semi")
    least = _present(held.unionByName(changed)).groupBy("app", "code").agg(F.min("batch_id").alias("batch_id"))
    first = touched.join(least, ["app", "code"], "left")
    known = before.filter("kind = 'batch'").select("app", "batch_id")
    fresh = arriving.join(known, ["app", "batch_id"], "left_anti")
    return (
        _rows(changed, "code", arrival).unionByName(_rows(first, "first", arrival)).unionByName(_rows(fresh, "batch", arrival))
    )


def _present(codes: DataFrame) -> DataFrame:
    """Codes that are in their batch by the last word on them."""
    last = codes.groupBy("app", "batch_id", "code").agg(F.max_by("present", "arrival").alias("present"))
    return last.filter("present").drop("present")


def _rows(df: DataFrame, kind: str, arrival: int) -> DataFrame:
    code = F.col("code") if "code" in df.columns else F.lit(None).cast("string")
    present = F.col("present") if "present" in df.columns else F.lit(None).cast("boolean")
    return df.select(
        F.lit(kind).alias("kind"), "app", "batch_id", code.alias("code"), present.alias("present"), F.lit(arrival).cast("long").alias("arrival")
    )


def first_seen(log: DataFrame) -> DataFrame:
    """``app, code, batch_id``: the earliest batch that has each code."""
    last = log.filter("kind = 'first'").groupBy("app", "code").agg(F.max_by("batch_id", "arrival").alias("batch_id"))
    return last.filter("batch_id IS NOT NULL")


def new_codes(log: DataFrame) -> DataFrame:
    """Codes per batch that no earlier batch has, as ``saturation.new_codes`` gives them from all codings."""
    per_first = first_seen(log).groupBy("app", "batch_id").agg(F.count(F.lit(1)).alias("n_new"))
    batches = log.filter("kind = 'batch'").select("app", "batch_id").distinct()
    return batches.join(per_first, ["app", "batch_id"], "left").select(
        "app", "batch_id", F.coalesce("n_new", F.lit(0)).cast("long").alias("n_new")
    )


def compacted(log: DataFrame, arrival: int) -> DataFrame:
    """The state up to ``arrival`` without its history, as rows of that arrival, for a log in a new folder."""
    upto = log.filter(F.col("arrival") <= arrival)
    codes = _present(upto.filter("kind = 'code'")).withColumn("present", F.lit(True))
    batches = upto.filter("kind = 'batch'").select("app", "batch_id").distinct()
    return _rows(codes, "code", arrival).unionByName(_rows(first_seen(upto), "first", arrival)).unionByName(_rows(batches, "batch", arrival))


def read_first_seen_log(spark: SparkSession, path: str) -> DataFrame:
    """The log at ``path``, which ``append_arrival`` has begun."""
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def append_arrival(rows: DataFrame, path: str) -> None:
    """Add the rows of an arrival; those of the same arrival are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("arrival").parquet(path)
