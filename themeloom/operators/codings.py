"""Coding files and raw answers to codings; merge, dedup and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.functions import fixed, text

_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_CSV_ROW = "code string, quote string, _corrupt_record string"
# A CSV field: quoted, over line breaks too, with doubled quotes inside; or plain; or empty. Possessive, so long texts do not
# recurse. A record that does not fit, as its quote is never closed, is the rest of its line.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^",\n]*+|[^",\n][^,\n]*+|)'
_RECORD = f"{_FIELD}(?:,{_FIELD})*+"
# A theme line starts a block; the look-ahead keeps the line in its block.
_BLOCK_START = f"(?m)^(?={fixed.THEME_MARK})"


def file_lines(files: DataFrame, keep: tuple[str, ...] = ("app", "src_file")) -> DataFrame:
    """Records after the header line of each file, with the 1-based number of their first line in the file.

    A file is one batch and theme, so it is one row here; header, records and line numbers come from its
    own text, without a window or a shuffle. A record is a line, or several if a quoted field holds line
    breaks. Files without a header give one row with a NULL line number.
    """
    lines = F.split(F.regexp_replace("content", r"\A\x{feff}", ""), _LINE_END)
    with_lines = files.select(*keep, lines.alias("_lines"))
    header_at = F.array_position(F.transform("_lines", lambda s: text.strip_blank(s)), fixed.CODING_HEADER)
    located = with_lines.withColumn("_header", header_at)
    body = F.concat(F.array_join(F.slice("_lines", F.col("_header").cast("int") + 1, F.size("_lines")), "\n"), F.lit("\n"))
    records = F.regexp_extract_all(F.when((F.col("_header") > 0) & (F.col("_header") < F.size("_lines")), body), F.lit(f"({_RECORD}|[^\\n]*+)\\n"), F.lit(1))
    # a record of several lines leaves a gap for each further line, so that places are line numbers
    further = F.transform(records, lambda r: F.concat(F.array(r), F.array_repeat(F.lit(None).cast("string"), F.regexp_count(r, F.lit("\n")))))
    exploded = located.select(*keep, "_header", F.posexplode_outer(F.flatten(further)).alias("_pos", "line"))
    exploded = exploded.filter("line IS NOT NULL OR _pos IS NULL")
    return exploded.select(
        *keep,
        F.when(F.col("_header") > 0, F.col("_header") + F.coalesce("_pos", F.lit(0)) + 1).cast("int").alias("line_no"),
        "line",
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Two-column rows from lines. ``status`` is ok, blank, header, empty or a reject reason."""
    # naming the mode also keeps the optimizer from pruning the row schema below two columns
    parsed = lines.withColumn("_row", F.from_csv(F.col("line"), _CSV_ROW, {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true", "lineSep": "\0"}))
    bare = text.strip_blank("line")
    code = text.strip_blank(F.coalesce(F.col("_row.code"), F.lit("")))
    quote = text.strip_outer_punctuation(text.strip_blank(F.coalesce(F.col("_row.quote"), F.lit(""))))
    status = (
        F.when(F.col("line_no").isNull(), "no_header")
        .when(F.col("line").isNull() | bare.rlike(r"\A[,\s]*\z"), "blank")
        .when(bare == fixed.CODING_HEADER, "header")
        .when(~F.col("line").rlike(rf"\A{_RECORD}\z"), "open_quote")
        .when(F.col("_row._corrupt_record").isNotNull(), "column_count")
        .when((code == "") | (quote == ""), "empty")
        .otherwise("ok")
    )
    return parsed.select("*", code.alias("code"), quote.alias("quote"), status.alias("status")).drop("_row")


def valid_codings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == "ok").drop("status", "line")


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows that were skipped although they carry something, with the reason."""
    return parsed.filter(F.col("status").isin("no_header", "column_count", "open_quote")).drop("code", "quote").withColumnRenamed(
        "status", "reason"
    )


def parse_files(files: DataFrame, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(codings, rejects) of coding files ``app, src_file, content``."""
    parsed = parse_lines(file_lines(files))
    bad = rejects(parsed)
    if fail_fast and not bad.filter("reason = 'no_header'").isEmpty():
        raise ValueError(f"a coding file has no header line {fixed.CODING_HEADER!r}")
    batch_id = text.file_batch_id("src_file")
    good = valid_codings(parsed).withColumn("batch_id", batch_id)
    # a file that names no batch belongs to none
    unnamed = files.filter(batch_id.isNull()).select(
        "app", "src_file", F.lit(None).cast("int").alias("line_no"), F.lit(None).cast("string").alias("line"), F.lit("file_name").alias("reason")
    )
    return (
        good.filter("batch_id IS NOT NULL").select(
            "app", "batch_id", text.file_theme("src_file").alias("theme"), "code", "quote", "src_file", "line_no",
        ),
        bad.filter(batch_id.isNotNull()).unionByName(unnamed),
    )


def completed_batches(files: DataFrame) -> DataFrame:
    """Batches that have at least one coding file, by file name."""
    return (
        files.select("app", text.file_batch_id("src_file").alias("batch_id"))
        .filter(F.col("batch_id").isNotNull()).distinct()
    )


def answer_blocks(answers: DataFrame) -> DataFrame:
    """Theme blocks of raw answers ``app, response_id, batch_id, text``; text before the first theme
    line is left out."""
    blocks = answers.select("app", "response_id", "batch_id", F.posexplode(F.split("text", _BLOCK_START)).alias("block", "content"))
    theme = F.regexp_extract("content", fixed.THEME_PATTERN, 1)
    return blocks.withColumn("theme", text.strip_blank(theme)).filter(F.col("content").startswith(fixed.THEME_MARK))


def parse_answers(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(codings, rejects) of raw answers: one row per coded quote, with the theme of the block.

    Rejects carry a reason: malformed rows, blocks without a header line, answers without a theme line. The line
    number counts from the theme line of the block.
    """
    keep = ("app", "response_id", "batch_id", "theme", "block")
    parsed = parse_lines(file_lines(answer_blocks(answers), keep))
    columns = ("app", "response_id", "batch_id", "theme", "line_no", "line", "reason")
    plain = answers.filter(~F.coalesce(F.col("text").rlike(_BLOCK_START), F.lit(False))).select(
        "app", "response_id", "batch_id", F.lit(None).cast("string").alias("theme"), F.lit(None).cast("int").alias("line_no"),
        F.lit(None).cast("string").alias("line"), F.lit("no_theme").alias("reason"),
    )
    return (
        valid_codings(parsed).select("app", "response_id", "batch_id", "theme", "code", "quote"),
        rejects(parsed).select(*columns).unionByName(plain),
    )


def rule_flags(codings: DataFrame) -> DataFrame:
    """Row-level rule checks on quote and code."""
    return codings.select(
        "*", text.has_entry_marks("quote").alias("has_marks"), text.has_ellipsis("quote").alias("has_ellipsis"),
        text.code_too_long("code").alias("code_too_long"),
    )


def union_codings(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def merge_codings(codings: DataFrame, fail_on_empty: bool = False) -> DataFrame:
    """Distinct (code, quote) per app. ``fail_on_empty`` makes nothing to merge an error."""
    if fail_on_empty and codings.isEmpty():
        raise ValueError("there are no codings to merge")
    return codings.select("app", "code", "quote").dropDuplicates(["app", "code", "quote"])


def merge_with_origin(codings: DataFrame) -> DataFrame:
    """Distinct (code, quote) with where it was seen first and how often in all."""
    origin = F.min(F.struct("batch_id", "src_file", "line_no"))
    return codings.groupBy("app", "code", "quote").agg(origin.alias("o"), F.count(F.lit(1)).alias("n_rows")).select(
        "app", "code", "quote", F.col("o.batch_id").alias("first_batch"), F.col("o.src_file").alias("first_file"), "n_rows"
    )


def sorted_codebook(codings: DataFrame) -> DataFrame:
    return merge_codings(codings).orderBy("app", "code", "quote")


def merge_summary(codings: DataFrame) -> DataFrame:
    """Rows before and after dedup and number of codes per app. Two plain aggregation steps instead
    of distinct counts, which would expand every row once per distinct expression."""
    per_pair = codings.groupBy("app", "code", "quote").agg(F.count(F.lit(1)).alias("n"))
    per_code = per_pair.groupBy("app", "code").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pairs"))
    return per_code.groupBy("app").agg(
        F.sum("n").alias("n_rows"), F.sum("pairs").alias("n_distinct"), F.count(F.lit(1)).alias("n_codes")
    )


def quotes_per_code(codings: DataFrame) -> DataFrame:
    counts = merge_codings(codings).groupBy("app", "code").agg(F.count(F.lit(1)).alias("n_quotes"))
    return counts.orderBy("app", F.desc("n_quotes"), "code")


def batch_codes(codings: DataFrame) -> DataFrame:
    """Distinct codes per batch over all its themes."""
    code = text.strip_blank("code")
    return codings.select("app", "batch_id", code.alias("code")).filter(F.col("code") != "").distinct()


def codes_only_in(codings: DataFrame, batch_id: int, other_batch_id: int) -> DataFrame:
    """Codes of one batch that another batch does not have."""
    def codes(b: int) -> DataFrame:
        return batch_codes(codings.filter(F.col("batch_id") == b)).select("app", "code")

    return codes(batch_id).subtract(codes(other_batch_id))


def dictionary_columns(merged: DataFrame) -> DataFrame:
    """The exported two columns under their fixed names."""
    return merged.select("app", F.col("code").alias(fixed.CODE_COLUMN), F.col("quote").alias(fixed.QUOTE_COLUMN))
