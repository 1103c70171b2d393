"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and returns the columns of ``documents``; the last returns token ids and the
position in the mix, as scans do not keep the order of the files. Each works on
all rows that its predecessor kept and learns what it needs from them. An empty table passes through all stages; a null text
is rejected by the first.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm import bpe, language, lines, minhash, mixing
from llm.tables import small_batches, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Predict the language; texts without a letter have none and go. A missing label is filled in, others stay."""
    small_batches(spark)
    sample = language.labelled_sample(docs, F.lit(True))
    found = language.identify(docs.select(*COLUMNS), sample)
    kept = found.filter(F.col("lang_pred") != language.UNKNOWN) if sample else found.filter(F.col("text").rlike(r"\p{L}"))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that occurred before; documents of which no line with a word stays go."""
    cut = lines.dedup_lines(docs.select(*COLUMNS))
    kept = cut.filter("n_lines > n_removed")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles (similarity 0.8 or more) the one of the smallest doc_id stays."""
    small_batches(spark)
    gone = minhash.near_duplicates(docs, shingle=5, part=80, whole=100).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the documents in the order of the mix; none goes, and the files follow one another in that order."""
    return mixing.mix(docs.select(*COLUMNS)).orderBy("slot", "place", "doc_id").select(*COLUMNS)


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``: the number of the row in its files, which follow one another by number, from 0. Of a table
    that does not come from files it only rises with the rows."""
    if not docs.inputFiles():
        return docs.withColumn("position", F.monotonically_increasing_id())
    name = F.col("_metadata.file_name")
    sizes = docs.groupBy(name.alias("_file")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(F.regexp_extract("_file", r"^part-(\d+)", 1).cast("bigint"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))  # a row for each file
    own = docs.select("*", name.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return own.join(F.broadcast(starts), "_file").withColumn("position", F.col("_start") + F.col("_row")).drop("_file", "_start", "_row")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers), the digest of what they decode to, and ``position`` in the mix."""
    small_batches(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    done = bpe.round_trip(placed(docs).select("doc_id", "lang", "source", "position", "text"), path)
    return done.select("doc_id", "lang", "source", "position", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# Learned models, hashes of words and token merges are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
