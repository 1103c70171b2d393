"""Readers and writers. Text formats are for exchange with people; Parquet is the working format."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom import schemas
from themeloom.functions import fixed, text
from themeloom.operators.codings import dictionary_columns
from themeloom.operators.prompts import unused_lines
from themeloom.sources.quoted_csv import read_quoted_csv


#: What a folder of a partition escapes in its value, besides control characters.
_PARTITION_MARKS = "\"#%'*/:=?\\{[]^"


def require_columns(df: DataFrame, required: Iterable[str] = schemas.REVIEW_COLUMNS) -> DataFrame:
    """Fail before any job when columns are missing; extra columns are fine."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {df.columns}")
    return df


# --- reviews ------------------------------------------------------------------------------------

def read_reviews_csv(spark: SparkSession, path: str | list[str], app: str | None = None) -> DataFrame:
    """Reviews CSV with header: BOM, doubled quotes and line breaks inside quotes are allowed. All
    columns stay strings, so ids keep their form; only an empty cell is NULL. Large files are read in many tasks, whatever
    the line breaks (``quoted_csv``)."""
    df = read_quoted_csv(spark, path)
    require_columns(df)
    return df if app is None else df.withColumn("app", F.lit(app))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    df = require_columns(spark.read.parquet(path), ("app", *schemas.REVIEW_COLUMNS))
    return df.withColumn("name", F.col("name").cast("string"))


# --- sampling log -------------------------------------------------------------------------------

def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The sampling log, empty when there is none yet."""
    try:
        df = spark.read.schema(schemas.SAMPLING_LOG).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.SAMPLING_LOG)
    return df.select(*schemas.SAMPLING_LOG.fieldNames())


def append_log(rows: DataFrame, path: str, manifest: DataFrame | None = None) -> None:
    """Add a run to the log. Rows land under their app and run, and a retried run replaces only its own
    folder, so history never shrinks and never doubles."""
    (
        rows.select(*schemas.SAMPLING_LOG.fieldNames()).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("app", "run_id").parquet(path)
    )
    record_run(path, manifest)


# --- batches ------------------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, overwrite: bool = False) -> None:
    """Write Parquet; an existing target is an error unless ``overwrite``, which replaces only the
    partitions that occur in ``df``."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def write_batches(batches: DataFrame, path: str, overwrite: bool = False, manifest: DataFrame | None = None) -> None:
    """Entries as text lines under ``app=/batch_id=``, in sequence order within a batch."""
    rows = batches.repartition("app", "batch_id").sortWithinPartitions("app", "batch_id", "global_seq")
    writer = rows.select("app", "batch_id", F.col("entry").alias("value")).write
    writer = writer.mode("overwrite" if overwrite else "errorifexists").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("app", "batch_id").text(path)
    record_run(path, manifest)


def write_unused(unused: DataFrame, path: str, apps: DataFrame | None = None, manifest: DataFrame | None = None) -> None:
    """The unused pool as text lines per app; always replaced as a whole.

    ``apps`` (``app``) names all apps of the run: each gets the header in a file of its own that sorts first by name
    of its content, and one with nothing left says so. The pool itself is never joined into one text.
    """
    rows = unused_lines(unused).select("app", F.col("entry").alias("value"))
    if apps is not None:
        left = unused.select("app").distinct().withColumn("_left", F.lit(True))
        head = apps.select("app").distinct().join(left, "app", "left")
        lines = F.when(F.col("_left"), "\n".join(fixed.UNUSED_HEADER)).otherwise("\n".join((*fixed.UNUSED_HEADER, "", fixed.UNUSED_NONE)))
        rows = head.select("app", lines.alias("value")).unionByName(rows)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("app").text(path)
    record_run(path, manifest)


def read_unused(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the unused pool, ``app, entry``, without header lines. With nothing written there are no app folders."""
    if "app" not in spark.read.text(path).columns:
        return spark.createDataFrame([], "app string, entry string")
    lines = spark.read.schema("value string, app string").text(path).filter(F.col("value").startswith(fixed.ENTRY_START_TEXT))
    return lines.select("app", F.col("value").alias("entry"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Entries of written batches, taken apart again. Lines that start no entry are left out."""
    lines = spark.read.schema("value string, app string, batch_id bigint").text(path).filter(F.col("value").startswith("[ID:"))
    def part(i: int):
        return F.regexp_extract("value", fixed.ENTRY_PATTERN, i)

    return lines.select(
        "app", "batch_id",
        part(1).alias("name"), part(2).alias("rating"), part(3).alias("review_norm"), F.col("value").alias("entry"),
    )


def count_entries(batch_texts: DataFrame) -> DataFrame:
    """Entries per batch text ``app, batch_id, batch_text``."""
    return batch_texts.select(
        "app", "batch_id", F.regexp_count("batch_text", F.lit(fixed.ENTRY_START)).cast("long").alias("n_entries")
    )


# --- coding files -------------------------------------------------------------------------------

def _escaped(value: str | None, marks: str) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if not value else "".join(f"%{ord(c):02X}" if c in marks or c < " " or c == "\x7f" else c for c in value)


def _write_files(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
        folders = set()
        for batch in batches:
            for app, name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder = f"{root.rstrip('/')}/app={_escaped(app, _PARTITION_MARKS)}"
                if folder not in folders:
                    system.create_dir(folder, recursive=True)
                    folders.add(folder)
                with system.open_output_stream(f"{folder}/{_escaped(name, '/:')}") as out:
                    out.write((content or "").encode() + b"\n")
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["n"])

    return run


def write_coding_files(files: DataFrame, path: str) -> None:
    """Coding files (``app, src_file, content``; a file without a name is left out), each written once and in place by the task that
    holds its row, below a folder for each app. ``path`` is a mounted folder, hdfs:// or s3://. Spark's own text writer needs a folder
    for each file, which it makes, moves and lists one by one. A retry writes the same files."""
    rows = files.select("app", "src_file", "content").filter("src_file IS NOT NULL")
    rows.mapInArrow(_write_files(path), "n bigint").agg(F.sum("n")).collect()


def read_coding_files(spark: SparkSession, path: str | list[str], app: str | None = None) -> DataFrame:
    """Coding files (``app, src_file, content``), whole, so that lines keep their order. ``path`` may
    hold files named ``batch_...csv`` or folders named so; other files are left out."""
    df = spark.read.option("recursiveFileLookup", app is not None).text(path, wholetext=True)
    app_column = F.lit(app) if app is not None else F.col("app").cast("string")
    named = df.select(
        app_column.alias("app"), text.coding_file_name("_metadata.file_path").alias("src_file"),
        F.col("value").alias("content"),
    )
    return named.filter(F.col("src_file") != "")


# --- codebook and dictionary --------------------------------------------------------------------

def write_codebook_csv(merged: DataFrame, path: str, overwrite: bool = False, manifest: DataFrame | None = None) -> None:
    """Merged codebook as CSV per app, sorted by code and quote."""
    rows = dictionary_columns(merged).repartitionByRange("app", fixed.CODE_COLUMN, fixed.QUOTE_COLUMN)
    rows = rows.sortWithinPartitions("app", fixed.CODE_COLUMN, fixed.QUOTE_COLUMN)
    mode = "overwrite" if overwrite else "errorifexists"
    rows.write.mode(mode).partitionBy("app").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    record_run(path, manifest)


def read_codebook_csv(spark: SparkSession, path: str) -> DataFrame:
    require_columns(spark.read.csv(path, header=True, escape='"'), (fixed.CODE_COLUMN, fixed.QUOTE_COLUMN))
    schema = f"`{fixed.CODE_COLUMN}` string, `{fixed.QUOTE_COLUMN}` string, app string"
    df = spark.read.schema(schema).csv(path, header=True, escape='"')
    return df.select("app", F.col(fixed.CODE_COLUMN).alias("code"), F.col(fixed.QUOTE_COLUMN).alias("quote"))


def export_dictionary(merged: DataFrame, path: str, overwrite: bool = False, manifest: DataFrame | None = None) -> None:
    """Dictionary for use on new data: the same two columns, codes and quotes both required."""
    require_columns(merged, ("app", "code", "quote"))
    write_codebook_csv(merged.filter("code <> '' AND quote <> ''"), path, overwrite, manifest)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return read_codebook_csv(spark, path).withColumnRenamed("quote", "term")


# --- prompts and run records --------------------------------------------------------------------

def write_prompts(prompts: DataFrame, path: str, manifest: DataFrame | None = None) -> None:
    """Latest prompt per app, stage and batch; a new run replaces only the batches it covers."""
    # one task for each folder, so no task holds a writer for every batch
    write_table(prompts.repartition("app", "stage", "batch_id"), path, ["app", "stage", "batch_id"], overwrite=True)
    record_run(path, manifest)


def source_hashes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SHA-256 of every source file, hashed where it is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("sha256"))


def _row_hash(columns: Iterable[str]):
    """MD5 of a row. Each cell is preceded by its length, so no content of a cell can pass for another row; NULL is ``-``."""
    cells = [F.col(f"`{c.replace('`', '``')}`").cast("string") for c in sorted(columns)]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]))


def _content(rows: DataFrame, by: list[str], columns: Iterable[str], name: str) -> DataFrame:
    """``by, n_rows, sha256`` over the row hashes ``_h`` of ``rows``, added up as two 60-bit numbers, so nothing is gathered."""
    def part(start: int):
        return F.sum(F.conv(F.substring("_h", start, 15), 16, 10).cast("decimal(20,0)"))

    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), part(1).alias("_a"), part(16).alias("_b"))
    names = "".join(f"{len(c.encode())}:{c}" for c in sorted(columns))
    text = F.concat_ws(":", F.lit(name), F.lit(names), *[F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in ("n_rows", "_a", "_b")])
    return sums.select(*by, "n_rows", F.sha2(text, 256).alias("sha256"))


def table_hash(df: DataFrame, name: str) -> DataFrame:
    """``file, sha256`` of a table's content and column names: one row, whatever the order and the files of the table.

    A file may have any size. Columns are taken in the order of their names, as text; NULL is told from ''.
    """
    hashed = df.select(_row_hash(df.columns).alias("_h"))
    return _content(hashed, [], df.columns, name).select(F.lit(name).alias("file"), "sha256")


def partition_hashes(df: DataFrame, name: str, by: str) -> DataFrame:
    """``file, part, n_rows, sha256``: the hash of each partition of a table by the text of column ``by``, the leaves of its manifest."""
    hashed = df.select(F.col(by).cast("string").alias("part"), _row_hash(df.columns).alias("_h"))
    return _content(hashed, ["part"], df.columns, name).select(F.lit(name).alias("file"), "part", "n_rows", "sha256")


def root_hash(parts: DataFrame) -> DataFrame:
    """``file, n_parts, n_rows, sha256``: partition hashes folded to one, in 256 groups first, so no row holds all of them."""
    own = F.sha2(F.concat_ws(":", F.coalesce(F.concat(F.octet_length("part").cast("string"), F.lit("="), "part"), F.lit("-")), "sha256"), 256)

    def over(column: str):
        return F.sha2(F.concat_ws("", F.array_sort(F.collect_list(column))), 256)

    rows = parts.select("file", "n_rows", own.alias("h"))
    groups = rows.groupBy("file", F.substring("h", 1, 2).alias("g")).agg(over("h").alias("h"), F.count(F.lit(1)).alias("n_parts"), F.sum("n_rows").alias("n_rows"))
    gathered = F.transform(F.array_sort(F.collect_list(F.struct("g", "h"))), lambda x: x["h"])
    return groups.groupBy("file").agg(
        F.sum("n_parts").alias("n_parts"), F.sum("n_rows").alias("n_rows"), F.sha2(F.concat_ws("", gathered), 256).alias("sha256")
    )


def changed_partitions(old: DataFrame, new: DataFrame) -> DataFrame:
    """``file, part, change`` between two manifests of ``partition_hashes``: added, removed or changed."""
    a, b = old.alias("a"), new.alias("b")
    same = (F.col("a.file") == F.col("b.file")) & F.col("a.part").eqNullSafe(F.col("b.part"))
    both = a.join(b, same, "full_outer")
    change = F.when(F.col("a.sha256").isNull(), "added").when(F.col("b.sha256").isNull(), "removed").when(F.col("a.sha256") != F.col("b.sha256"), "changed")
    part = F.when(F.col("b.sha256").isNull(), F.col("a.part")).otherwise(F.col("b.part"))
    return both.select(F.coalesce("a.file", "b.file").alias("file"), part.alias("part"), change.alias("change")).filter("change IS NOT NULL")


def write_with_manifest(df: DataFrame, path: str, manifest: DataFrame, partition_by: list[str] | None = None, overwrite: bool = False) -> None:
    """``write_table`` and, beside it under ``<path>.meta``, the manifest of the run that made it."""
    write_table(df, path, partition_by, overwrite)
    record_run(path, manifest)


def record_run(path: str, manifest: DataFrame | None) -> None:
    """Write the manifest of the run that made ``path`` to ``<path>.meta``. All sinks take one; None leaves it out."""
    if manifest is not None:
        manifest.write.mode("overwrite").parquet(f"{path.rstrip('/')}.meta")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest of the run that made ``path``."""
    return spark.read.parquet(f"{path.rstrip('/')}.meta")


def run_manifest(hashes: DataFrame, params: dict[str, object], version: str) -> DataFrame:
    """One row: generation time, parameters, version and one hash over all sources. Files are hashed
    together in 256 groups first, so no row holds the list of all files."""
    flat = [F.lit(x) for k, v in sorted(params.items()) for x in (str(k), str(v))]

    def over(*columns: str):
        return F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct(*columns))), lambda f: f[columns[-1]])), 256)

    groups = hashes.groupBy(F.substring("sha256", 1, 2).alias("g")).agg(over("file", "sha256").alias("h"), F.count(F.lit(1)).alias("n"))
    return groups.agg(over("g", "h").alias("source_hash"), F.sum("n").alias("n_sources")).select(
        F.current_timestamp().alias("generated_at"), F.create_map(*flat).alias("params"), "source_hash", "n_sources",
        F.lit(version).alias("script_version"),
    )
