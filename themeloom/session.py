"""Session helpers: building a session, cutting lineage, checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Largest table that may be broadcast, in rows, after its rows have been counted.
BROADCAST_ROWS = 200_000


def build_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("themeloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; executors of a cluster would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="themeloom-")


def materialise(df: DataFrame) -> DataFrame:
    """Write a small intermediate result to reliable storage and go on from there.

    Used where several consumers share a result that is much smaller than its input. A reliable
    checkpoint survives the loss of executors.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def fits_broadcast(stored: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when a stored table has at most ``max_rows`` rows. Only for tables that are materialised, where counting is cheap;
    other joins carry no hint and leave the choice to adaptive execution, which knows the bytes."""
    return stored.count() <= max_rows


def has_few_splits(df: DataFrame) -> bool:
    return df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism


def spread(df: DataFrame, key: str, few_splits: bool | None = None) -> DataFrame:
    """Spread a table read from fewer splits than there are cores, such as one small file. Tables of
    many splits stay as they are, so no large table is shuffled for this."""
    if has_few_splits(df) if few_splits is None else few_splits:
        return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)
    return df
