"""CSV with line breaks inside quotes, read in as many tasks as the files have splits.

Whether a line break ends a record depends on the number of quotes before it in the file, which a task that reads one split does not
know. But only their parity counts, and it adds up: every split is taken in under both assumptions, even and odd, the parities
of the splits of a file are summed up in order (a row for each split), and then each task knows what its split begins with.

Records of one line go on where they were read. Lines of a record that has several are shuffled to each other, also across splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BOM = "﻿"
_LINES = "file string, block bigint, line bigint, value string, odd boolean, closes boolean, start_even bigint, start_odd bigint"
_SPLITS = "file string, block bigint, odd boolean, start_even bigint, start_odd bigint"


class _Split:
    """State of the split that is being read: number of the line, quotes so far, last line that starts a record if they are even
    or odd before the split (-1: none yet)."""

    def __init__(self, key):
        self.key, self.line, self.odd, self.starts = key, 0, 0, [-1, -1]

    def take(self, values: pa.Array) -> dict[str, np.ndarray]:
        """Columns of the next lines of the split."""
        quotes = pc.fill_null(pc.count_substring(values, '"'), 0).to_numpy(zero_copy_only=False)
        after = (np.cumsum(quotes) + self.odd) & 1
        before = np.concatenate([[self.odd], after[:-1]])
        line = np.arange(self.line, self.line + len(after))
        starts = []
        for assumed in (0, 1):
            last = np.maximum.accumulate(np.where(before == assumed, line, -1))
            starts.append(np.maximum(last, self.starts[assumed]))
        self.line, self.odd, self.starts = self.line + len(after), int(after[-1]), [int(s[-1]) for s in starts]
        return {"line": line, "odd": before == 1, "closes": after == 0, "start_even": starts[0], "start_odd": starts[1]}


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Lines of one split that follow one another."""
    files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
    at = 0
    for i in range(1, len(files) + 1):
        if i == len(files) or blocks[i] != blocks[at] or files[i] != files[at]:
            yield (files[at], blocks[at]), batch.slice(at, i - at)
            at = i


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        for key, part in _runs(batch):
            split = split if split is not None and split.key == key else _Split(key)
            taken = split.take(part.column("value"))
            names = ["file", "block", "line", "value", "odd", "closes", "start_even", "start_odd"]
            arrays = [pa.array(taken[c]) if c in taken else part.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split, schema = None, pa.schema([("file", pa.string()), ("block", pa.int64()), ("odd", pa.bool_()), ("start_even", pa.int64()), ("start_odd", pa.int64())])

    def row():
        return pa.RecordBatch.from_pylist([{"file": split.key[0], "block": split.key[1], "odd": split.odd == 1, "start_even": split.starts[0], "start_odd": split.starts[1]}], schema)

    for batch in batches:
        for key, part in _runs(batch):
            if split is not None and split.key != key:
                yield row()
            split = split if split is not None and split.key == key else _Split(key)
            split.take(part.column("value"))
    if split is not None:
        yield row()


def _scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines in the order of their files, as each task reads its splits from the beginning to the end."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _begins(scan: DataFrame) -> DataFrame:
    """For each split: whether its first line lies in quotes, and where the record that this line belongs to started."""
    splits = scan.mapInArrow(_splits, _SPLITS)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split of a file
    odd = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    known = splits.withColumn("begins_odd", odd)
    start = F.when(F.col("begins_odd"), F.col("start_odd")).otherwise(F.col("start_even"))
    opened = F.when(start >= 0, F.struct("block", start.alias("line")))
    known = known.withColumn("ends_odd", F.col("odd") != F.col("begins_odd"))
    last = F.last(F.when(F.col("ends_odd"), opened), ignorenulls=True).over(before)
    return known.select("file", "block", "begins_odd", last.alias("from"))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, block, line, record``: the records of the files with the place where each starts, header records included, without the line
    break at their end. Empty lines between records are left out. A quote that never closes makes the rest of its file one record,
    as the format has it."""
    scan = _scan(spark, path)
    lines = scan.mapInArrow(_lines, _LINES).join(F.broadcast(_begins(scan)), ["file", "block"])  # a row for each split of the input
    inside = F.col("odd") != F.col("begins_odd")
    ends = F.col("closes") != F.col("begins_odd")
    start = F.when(F.col("begins_odd"), F.col("start_odd")).otherwise(F.col("start_even"))
    lines = lines.withColumn("_inside", inside).withColumn("_ends", ends)
    single = lines.filter("NOT _inside AND _ends").select("file", "block", "line", F.col("value").alias("record"))
    own = F.when(start >= 0, F.struct("block", start.alias("line"))).otherwise(F.col("from"))
    several = lines.filter("_inside OR NOT _ends").select("file", own.alias("at"), F.struct("block", "line", "value").alias("part"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"]), "\n")
    several = several.groupBy("file", "at").agg(joined.alias("record")).select("file", "at.block", "at.line", "record")
    records = single.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))
    first = (F.col("block") == 0) & (F.col("line") == 0)
    records = records.withColumn("record", F.when(first, F.regexp_replace("record", f"^{_BOM}", "")).otherwise(F.col("record")))
    return records.filter("record <> ''")


def read_quoted_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as strings, named by the header, which every file has and which takes one line; an empty cell is NULL."""
    columns = spark.read.option("lineSep", "\n").csv(path, header=True, escape='"', inferSchema=False).columns
    columns = [c.removeprefix(_BOM).rstrip("\r") for c in columns]
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    rows = read_records(spark, path).filter("NOT (block = 0 AND line = 0)")
    options = {"escape": '"', "nullValue": "", "emptyValue": "", "mode": "PERMISSIVE"}
    return rows.select(F.from_csv("record", schema, options).alias("r")).select(*[F.col("r").getField(c).alias(c) for c in columns])
