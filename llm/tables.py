"""Readers of the given tables and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from themeloom.session import shared_folder


#: Rows of a batch that tasks hand to Python. Texts are long, and a batch lies in the memory of both sides.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size to ``BATCH_ROWS``; for jobs over whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage and survives lost executors.

    The folder is the session's ``spark.checkpoint.dir``; whoever owns that folder clears it.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from batches that come sorted by ``keys`` (non-null integers)."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        head = tuple(c[0] for c in columns)
        if rest and head != last:
            yield pa.Table.from_batches(rest)
            rest = []
        for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield pa.Table.from_batches([*rest, batch.slice(a, b - a)])
            rest = []
        rest.append(batch.slice(cuts[-2]))
        last = tuple(c[-1] for c in columns)
    if rest:
        yield pa.Table.from_batches(rest)
