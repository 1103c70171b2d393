"""The given tables seen as entities of the coding workflow."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from themeloom.functions import fixed, text
from themeloom.session import has_few_splits, materialise, shared_folder, spread

BATCH = 50
N_BATCHES = 5
SEED = 42
MIN_LEN = 20
PROMPT_BUDGET = 100_000
APP = "src"  # all documents have sources src0, src1, ...; as one app they are its hot group


BROKEN_ROW = '断行,"上半句\n下半句"'
OPEN_ROW = '未闭合,"没有结尾'
UNDATED_FILE = "batch_preview_t.csv"

_SCHEMAS: dict[str, StructType] = {}
_FEW_SPLITS: dict[tuple[str, int], bool] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is inferred once, as inference is a job of its own."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key = table(spark, sf_dir, "documents"), (sf_dir, spark.sparkContext.defaultParallelism)
    if key not in _FEW_SPLITS:
        _FEW_SPLITS[key] = has_few_splits(df)
    return spread(df, "doc_id", _FEW_SPLITS[key])


def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/themeloom-{uuid.uuid4().hex}"


def _batch_of(doc_id: str = "doc_id") -> Column:
    return F.floor(F.col(doc_id) / BATCH).cast("long")


def _rating() -> Column:
    n = F.col("n_chars")
    return F.when(n < 600, "1").when(n < 1200, "2").when(n < 2400, "3").when(n < 4800, "4").otherwise("5")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One app per language, rating by length."""
    return documents(spark, sf_dir).select(
        F.col("lang").alias("app"), F.col("doc_id").cast("string").alias("name"), _rating().alias("rating"),
        F.col("text").alias("review"),
    )


def sampling_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are those sampled by an earlier run."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("app"))
    return table(spark, sf_dir, "labels").select("doc_id").join(docs, "doc_id").select(
        "app", F.col("doc_id").cast("string").alias("name"), (F.col("doc_id") + 1).alias("global_seq"),
        _batch_of().alias("batch_id"), F.lit("r0").alias("run_id"),
    )


def _app() -> Column:
    return F.regexp_replace("source", "[0-9]+$", "")


def coded_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one app, 50 to a batch."""
    return documents(spark, sf_dir).select(
        _app().alias("app"), _batch_of().alias("batch_id"), F.col("doc_id").cast("string").alias("name"),
        F.col("lang").alias("theme"), _rating().alias("rating"), text.normalise("text").alias("review_norm"),
    )


def _src_file() -> Column:
    return F.concat(F.lit("batch_"), F.format_string("%02d", "batch_id"), F.lit("_"), "theme", F.lit(".csv"))


def codings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of a review is a quote; its code is its first two letters, its theme the language."""
    sentences = coded_reviews(spark, sf_dir).select(
        "app", "batch_id", "theme", "name", F.posexplode_outer(F.split("review_norm", r"\.")).alias("pos", "s")
    )
    quote = F.trim("s")
    return sentences.filter(F.length(quote) >= 3).select(
        "app", "batch_id", "theme", F.lower(F.substring(quote, 1, 2)).alias("code"), quote.alias("quote"),
        _src_file().alias("src_file"), (F.col("name").cast("long") * 100_000 + F.col("pos")).alias("line_no"),
    )


def undated(rows: DataFrame) -> DataFrame:
    """``rows`` and, for each app, one of a file that names no batch."""
    apps = materialise(rows.select("app").distinct())  # once, and not with every reading of the rows
    return rows.unionByName(apps.select("app", F.lit(None).cast("long").alias("batch_id"), F.lit("t").alias("theme"), F.lit("preview").alias("code"), F.lit("q").alias("quote")), allowMissingColumns=True)


def theme_codings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codings with the theme as code, so that one quote can carry several codes."""
    return codings(spark, sf_dir).withColumn("code", F.col("theme"))


def word_codings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many codes on shared quotes: the words of each review, coded by its batch, its length and its language."""
    code = F.concat_ws("-", F.format_string("%d", F.floor(F.col("batch_id") / 4)), "rating", "theme")
    # the code of a review is worked out once, and not for each of its words
    coded = coded_reviews(spark, sf_dir).select("app", "batch_id", "theme", code.alias("code"), "review_norm")
    words = coded.select("app", "batch_id", "theme", "code", F.explode_outer(F.split("review_norm", " ")).alias("quote"))
    return words.filter(F.length("quote") >= 3)


def _csv_field(c: str) -> Column:
    return F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))


def coding_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coding files: a line before the header, a quote over two lines, quoted quotes, codes as they are, a quote that never
    closes, a repeated header. A file without a batch in its name stands beside them."""
    def line(s: Column, pos: Column) -> Column:
        number = (F.col("name").cast("long") * 100_000 + pos).alias("line_no")
        return F.struct(number, F.concat(F.lower(F.substring(s, 1, 2)), F.lit(","), _csv_field(s)).alias("line"))

    # the lines of ``codings``; those of a review travel together
    quotes = F.transform(F.split("review_norm", r"\."), lambda s, i: F.struct(F.trim(s).alias("s"), i.alias("pos")))
    long = F.filter(quotes, lambda q: F.length(q["s"]) >= 3)
    lines = F.transform(long, lambda q: line(q["s"], q["pos"])).alias("lines")
    reviews = coded_reviews(spark, sf_dir).select("app", _src_file().alias("src_file"), lines)
    body = F.array_join(F.transform(F.array_sort(F.flatten(F.collect_list("lines"))), lambda r: r["line"]), "\n")
    head = F.lit(f"好的\n{fixed.CODING_HEADER}\n\n{BROKEN_ROW}\n")
    files = reviews.groupBy("app", "src_file").agg(
        F.concat(head, body, F.lit(f"\n{OPEN_ROW}\n{fixed.CODING_HEADER}\n")).alias("content"), F.max(F.size("lines")).alias("most")
    ).filter("most > 0").drop("most")  # a filter before would cut each review twice
    preview = F.lit(f"{fixed.CODING_HEADER}\nx,y\n")
    return files.unionByName(table(spark, sf_dir, "documents").select(_app().alias("app")).distinct().select("app", F.lit(UNDATED_FILE).alias("src_file"), preview.alias("content")))


def raw_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer per batch: a block per theme, both columns quoted, a row of three columns at its end, and a block without
    a header; an answer without any block for each app."""
    rows = F.array_sort(F.collect_list(F.struct("line_no", F.concat(_csv_field("code"), F.lit(","), _csv_field("quote")).alias("line"))))
    body = F.array_join(F.transform(rows, lambda r: r["line"]), "\n")
    block = F.concat(F.lit("--- 主题："), F.col("theme"), F.lit(f" ---\n\n{fixed.CODING_HEADER}\n"), body, F.lit("\nx,y,z\n\n"))
    blocks = codings(spark, sf_dir).groupBy("app", "batch_id", "theme").agg(block.alias("block"))
    answers = blocks.groupBy("app", "batch_id").agg(
        F.concat(F.lit("好的，结果如下\n\n"), F.array_join(F.array_sort(F.collect_list("block")), ""), F.lit("--- 主题：空 ---\n没有表头\n")).alias("text")
    ).withColumn("response_id", F.concat(F.lit("r"), F.col("batch_id")))
    plain = table(spark, sf_dir, "documents").select(_app().alias("app")).distinct().select(
        "app", F.lit(-1).cast("long").alias("batch_id"), F.lit("好的，没有结果").alias("text"), F.lit("r-1").alias("response_id")
    )
    return answers.unionByName(plain)


def filed_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes filed under their own batch and, by mistake, under the next one."""
    # the quotes of ``codings``; those of a review travel together, in one text, to the task of their batch and are told apart there
    quotes = F.filter(F.transform(F.split("review_norm", r"\."), lambda s: F.trim(s)), lambda q: F.length(q) >= 3)
    right = coded_reviews(spark, sf_dir).select("app", "batch_id", F.array_join(quotes, ".").alias("quotes"))
    both = F.explode(F.array("batch_id", F.col("batch_id") + 1))  # each text is read once
    filed = right.select("app", both.alias("batch_id"), "quotes").repartition("app", "batch_id")
    each = filed.select("app", "batch_id", F.explode_outer(F.split("quotes", r"\.")).alias("quote"))
    return each.filter(F.length("quote") >= 3).distinct()


def out_of_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope_flags(spark, sf_dir).filter("out_of_scope")


def scope_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.lit(APP).alias("app"), _batch_of().alias("batch_id"), F.col("doc_id").cast("string").alias("name"),
        (F.col("quality") == 0).alias("out_of_scope"),
    )


def gold_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First coding from the labels, the repeat from the length of the text."""
    labels = table(spark, sf_dir, "labels")
    docs = labels.join(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    name = F.col("doc_id").cast("string").alias("name")

    def rows(run: str, cond: Column, code: str) -> DataFrame:
        return docs.filter(cond).select(F.col("lang").alias("app"), name, F.lit(run).alias("run"), F.lit(code).alias("code"))

    return (
        rows("first", F.col("quality") == 1, "quality").unionByName(rows("first", F.col("toxic") == 1, "toxic"))
        .unionByName(rows("repeat", F.col("n_chars") >= 600, "quality"))
        .unionByName(rows("repeat", (F.col("n_chars") >= 4800) & (F.col("toxic") == 1), "toxic"))
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.lit(APP).alias("app"), F.concat(F.lit("item_"), F.col("item_id")).alias("code"), F.col("text").alias("term")
    )


def word_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of five letters or more of the benchmark texts, as short terms."""
    words = table(spark, sf_dir, "benchmark").select(F.explode_outer(F.split(text.normalise("text"), " ")).alias("w"))
    term = text.strip_outer_punctuation("w")
    return words.select(
        F.lit(APP).alias("app"), F.lower(term).alias("code"), term.alias("term")
    ).filter(F.length("term") >= 5).distinct()


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions by frequency: rare codes are merged (and their group renamed later), three quotes
    delete, four split, five rename a code and bring it back."""
    n = materialise(codings(spark, sf_dir).groupBy("app", "code").agg(F.count(F.lit(1)).alias("n")))
    star = F.concat(F.substring("code", 1, 1), F.lit("*"))

    def made(rows: DataFrame, batch: int, kind: str, source: Column, targets: list[Column]) -> DataFrame:
        target = F.array(*targets) if targets else F.array().cast("array<string>")
        return rows.select(
            "app", F.lit(batch).cast("long").alias("batch_id"), F.lit(1).alias("seq"), F.lit(kind).alias("type"),
            F.array(source).alias("source_codes"), target.alias("target_codes"),
        )

    code = F.col("code")
    thin = n.filter("n < 3")
    groups = thin.select("app", star.alias("code")).distinct()
    five = n.filter("n = 5")
    renamed = F.concat(code, F.lit("r"))
    return (
        made(thin, 10, "merge", code, [star])
        .unionByName(made(groups, 11, "rename", code, [F.concat(code, F.lit("*"))]))
        .unionByName(made(n.filter("n = 3"), 10, "delete", code, []))
        .unionByName(made(n.filter("n = 4"), 10, "split", code, [F.concat(code, F.lit("1")), F.concat(code, F.lit("2"))]))
        .unionByName(made(five, 8, "rename", code, [renamed]))
        .unionByName(made(five, 12, "merge", renamed, [code]))
    )


def codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes with three quotes or more; samples are the three shortest quotes, one of them altered for
    codes with four quotes."""
    c = codings(spark, sf_dir)
    counts = c.groupBy("app", "code").agg(F.count(F.lit(1)).alias("n"), F.min("theme").alias("theme")).filter("n >= 3")
    w = Window.partitionBy("app", "code").orderBy(F.length("quote"), "quote")
    best = c.select("app", "code", "quote").distinct().withColumn("r", F.row_number().over(w)).filter("r <= 3")
    samples = best.groupBy("app", "code").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "quote"))), lambda s: s["quote"]).alias("s")
    )
    none = F.array().cast("array<string>")
    return counts.join(samples, ["app", "code"]).select(
        "app", F.lit("v1").alias("version"), "theme", "code",
        F.when(F.col("n") >= 5, F.concat(F.lit("code "), F.col("code"))).alias("definition"),
        F.array("code").alias("include"), F.when(F.col("n") >= 10, F.array("theme")).otherwise(none).alias("exclude"),
        F.when(F.col("n") == 4, F.transform("s", lambda q: F.concat(q, F.lit("!")))).otherwise(F.col("s")).alias("samples"),
    )


def change_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log per app as JSON: the first batch is ``initial``, each later new code an ``add``."""
    first = codings(spark, sf_dir).groupBy("app", "code").agg(F.min(F.struct("batch_id", "theme")).alias("f")).select(
        "app", "code", "f.batch_id", "f.theme"
    )
    null = F.lit(None).cast("string")
    initial = first.filter("batch_id = 0").groupBy("app", "batch_id").agg(
        F.struct(F.lit("initial").alias("type"), F.count(F.lit(1)).cast("int").alias("codes_count"), null.alias("code"), null.alias("theme")).alias("c")
    )
    added = first.filter("batch_id > 0").select(
        "app", "batch_id",
        F.struct(F.lit("add").alias("type"), F.lit(None).cast("int").alias("codes_count"), "code", "theme").alias("c"),
    )
    batch = initial.unionByName(added).groupBy("app", "batch_id").agg(F.array_sort(F.collect_list("c")).alias("changes"))
    return batch.select("app", F.to_json(F.struct("batch_id", "changes", F.lit("v0.1").alias("codebook_version"))).alias("json"))


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knowledge layers per app. Layer 2 is still a template; deductive layers above the first are
    there for the app with most reviews only."""
    apps = reviews(spark, sf_dir).select("app").distinct()
    stage = F.explode(F.array(*[F.lit(s) for s in fixed.STAGES]))
    grid = apps.select("app", stage.alias("stage")).select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("layer"))
    content = F.when(F.col("layer") == 2, F.lit("\n# 当前编码本\n" + fixed.PLACEHOLDER_MARKERS[0] + "\n")).otherwise(
        F.concat(F.lit("\n\n "), F.col("stage"), F.lit(" "), F.col("app"), F.lit(" layer "), F.col("layer"), F.lit("\n"))
    )
    return grid.filter("stage = 'inductive' OR layer = 1 OR app = 'en'").withColumn("content", content)
