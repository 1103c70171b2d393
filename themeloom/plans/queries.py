"""Registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.functions import fixed, text
from themeloom.operators import codebook as cb
from themeloom.operators import codings as cd
from themeloom.operators import deductive as dd
from themeloom.operators import first_seen as fs
from themeloom.operators import prompts as pr
from themeloom.operators import quality as ql
from themeloom.operators import sampling as sm
from themeloom.operators import saturation as st
from themeloom.plans import bindings as b
from themeloom.session import fits_broadcast, materialise
from themeloom.sources import tables as io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
N_TOTAL = b.BATCH * b.N_BATCHES


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


def _count(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


# --- sources and sinks --------------------------------------------------------------------------

@query("io1_read_reviews")
def _(spark, d):
    path = b.scratch(spark)
    out = b.reviews(spark, d).select("app", "name", "rating", "review")
    out.write.csv(path, header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return io.read_reviews_csv(spark, path).select("app", "name", "rating", "review")


@query("io2_required_columns")
def _(spark, d):
    checked = io.require_columns(b.reviews(spark, d))
    return checked.groupBy("app").agg(*[F.count(c).alias(f"n_{c}") for c in ("name", "rating", "review")])


@query("io3_read_log")
def _(spark, d):
    path = b.scratch(spark)
    before = io.read_log(spark, path)  # no log yet: empty
    io.append_log(before.unionByName(b.sampling_log(spark, d)), path)
    return io.read_log(spark, path)


@query("io4_append_log")
def _(spark, d):
    path, old = b.scratch(spark), b.sampling_log(spark, d)
    io.append_log(old, path)
    run = sm.run_sampling(b.reviews(spark, d), io.read_log(spark, path), b.BATCH, b.N_BATCHES, b.SEED, b.MIN_LEN, True, "r1")
    io.append_log(run.log_rows(), path)
    io.append_log(run.log_rows(), path)  # a retry must change nothing
    return _count(io.read_log(spark, path), "app", "run_id").select("app", "run_id", "n")


def _stored_files(spark: SparkSession, d: str) -> DataFrame:
    path = b.scratch(spark)
    io.write_coding_files(b.coding_files(spark, d), path)
    return io.read_coding_files(spark, path)


@query("io5_scan_coding_files")
def _(spark, d):
    return _stored_files(spark, d).select("app", "src_file", "content")


@query("io6_write_batches")
def _(spark, d):
    path = b.scratch(spark)
    io.write_batches(_run(spark, d).batches, path)
    return spark.read.schema("value string, app string, batch_id bigint").text(path).select("app", "batch_id", F.col("value").alias("entry"))


@query("io7_write_unused")
def _(spark, d):
    path, run = b.scratch(spark), _run(spark, d)
    io.write_unused(run.available(), path)
    io.write_unused(run.unused(), path, b.reviews(spark, d))  # refreshed as a whole, with a header for each app
    return io.read_unused(spark, path)


@query("io7_unused_header")
def _(spark, d):
    path, run = b.scratch(spark), _run(spark, d)
    io.write_unused(run.unused().filter("app <> 'en'"), path, b.reviews(spark, d))
    lines = spark.read.schema("value string, app string").text(path)
    return lines.filter(~F.col("value").startswith(fixed.ENTRY_START_TEXT)).select("app", F.col("value").alias("line"))


@query("io8_overwrite_guard")
def _(spark, d):
    path, log = b.scratch(spark), b.sampling_log(spark, d)
    io.write_table(log, path, ["app"])
    refused = False
    try:
        io.write_table(log, path, ["app"])
    except AnalysisException as e:
        refused = e.getCondition() == "PATH_ALREADY_EXISTS"
    # replaces the partitions that are in the data, keeps the others
    io.write_table(log.filter("app <> 'en'").withColumn("run_id", F.lit("r1")), path, ["app"], overwrite=True)
    stored = spark.read.schema(log.schema).parquet(path)
    return _count(stored, "app", "run_id").withColumn("refused", F.lit(refused))


@query("io9_codebook_csv")
def _(spark, d):
    path = b.scratch(spark)
    io.write_codebook_csv(cd.merge_codings(b.codings(spark, d)), path)
    return io.read_codebook_csv(spark, path)


@query("io10_export_dictionary")
def _(spark, d):
    path = b.scratch(spark)
    io.export_dictionary(cd.merge_codings(b.theme_codings(spark, d)), path)
    return io.read_dictionary(spark, path)


@query("io11_run_manifest")
def _(spark, d):
    # both tables that the sampling run reads; written beside its log rows and read back
    hashes = io.table_hash(b.table(spark, d, "documents"), "documents").unionByName(io.table_hash(b.table(spark, d, "labels"), "labels"))
    manifest = io.run_manifest(hashes, {"batch_size": b.BATCH, "n_batches": b.N_BATCHES, "seed": b.SEED}, "1")
    path = b.scratch(spark)
    io.write_with_manifest(b.sampling_log(spark, d), path, manifest, ["app"])
    stored = io.read_manifest(spark, path)
    return stored.select("source_hash", "n_sources", "script_version", F.col("params")["seed"].alias("seed"), F.col("params")["batch_size"].alias("batch_size"))


@query("io11_partition_hashes")
def _(spark, d):
    return io.partition_hashes(b.table(spark, d, "documents"), "documents", "lang")


@query("io11_changed_partitions")
def _(spark, d):
    # a later state of the table: one language edited in one document, one left out, one new
    docs = b.table(spark, d, "documents")
    later = docs.filter("lang <> 'es'").withColumn("text", F.expr("if(lang = 'fr' AND doc_id % 20 = 0, concat(text, '.'), text)"))
    later = later.unionByName(docs.filter("lang = 'es'").withColumn("lang", F.lit("xx")))
    return io.changed_partitions(io.partition_hashes(docs, "documents", "lang"), io.partition_hashes(later, "documents", "lang"))


@query("io12_read_batches")
def _(spark, d):
    path = b.scratch(spark)
    io.write_batches(_run(spark, d).batches, path)
    return io.read_batches(spark, path).select("app", "batch_id", "name", "rating", "review_norm")


@query("io12_count_entries")
def _(spark, d):
    return io.count_entries(pr.batch_texts(_run(spark, d).batches))


# --- projections and filters --------------------------------------------------------------------

@query("pf1_min_length")
def _(spark, d):
    return sm.filter_length(b.reviews(spark, d), b.MIN_LEN).select(
        "app", "name", text.text_length("review").cast("long").alias("n_chars"))


@query("pf2_normalise")
def _(spark, d):
    return b.reviews(spark, d).select("app", "name", text.normalise("review").alias("review_norm"))


@query("pf3_entry")
def _(spark, d):
    return b.reviews(spark, d).select("app", text.entry("name", "rating", text.normalise("review")).alias("entry"))


@query("pf4_empty_rows")
def _(spark, d):
    parsed = cd.parse_lines(cd.file_lines(b.coding_files(spark, d)))
    return _count(parsed, "app", "src_file", "status")


@query("pf5_completed_batches")
def _(spark, d):
    return cd.completed_batches(b.coding_files(spark, d))


@query("pf6_header_seek")
def _(spark, d):
    lines = cd.file_lines(b.coding_files(spark, d))
    return lines.groupBy("app", "src_file").agg(
        F.min("line_no").cast("long").alias("first_line"), F.max("line_no").cast("long").alias("last_line"))


@query("pf7_parse_codings")
def _(spark, d):
    good, _bad = cd.parse_files(b.coding_files(spark, d))
    return good.select("app", "batch_id", "theme", "code", "quote")


@query("pf8_rejects")
def _(spark, d):
    _good, bad = cd.parse_files(b.coding_files(spark, d))
    return bad.select("app", "src_file", F.col("line_no").cast("long").alias("line_no"), "line", "reason")


@query("pf9_parse_answers")
def _(spark, d):
    good, _bad = cd.parse_answers(b.raw_answers(spark, d))
    return good


@query("pf9_answer_rejects")
def _(spark, d):
    _good, bad = cd.parse_answers(b.raw_answers(spark, d))
    return bad.select("app", "response_id", "theme", "line", "reason")


@query("pf10_rule_flags")
def _(spark, d):
    full = b.coded_reviews(spark, d).select("app", F.col("theme").alias("code"), F.col("review_norm").alias("quote"))
    entries = b.coded_reviews(spark, d).select(
        "app", F.concat(F.col("theme"), F.lit("-"), F.col("batch_id")).alias("code"), text.entry("name", "rating", "review_norm").alias("quote"))
    return cd.rule_flags(full.unionByName(entries)).select("app", "code", F.length("quote").cast("long").alias("n_chars"), "has_marks", "has_ellipsis", "code_too_long")


@query("pf11_layer_status")
def _(spark, d):
    return pr.layer_status(b.layers(spark, d))


@query("f1_strip_outer_punctuation")
def _(spark, d):
    words = b.coded_reviews(spark, d).select("app", F.explode_outer(F.split("review_norm", " ")).alias("w"))
    return _count(words.select("app", text.strip_outer_punctuation("w").alias("word")), "app", "word")


# --- joins --------------------------------------------------------------------------------------

@query("j1_exclude_logged")
def _(spark, d):
    return sm.exclude_logged(b.reviews(spark, d), b.sampling_log(spark, d)).select("app", "name", "rating")


@query("j2_unused")
def _(spark, d):
    return _run(spark, d).unused().select("app", "name", "rating")


@query("j3_batch_sizes")
def _(spark, d):
    per_batch = st.new_codes(b.codings(spark, d))
    sizes = _count(b.scope_flags(spark, d), "app", "batch_id", out="n_entries")
    return st.with_entries(per_batch, sizes).select("app", "batch_id", "n_entries")


def _sources(spark: SparkSession, d: str) -> DataFrame:
    return ql.quote_sources(b.filed_quotes(spark, d), b.coded_reviews(spark, d))


@query("j4_verbatim_pairs")
def _(spark, d):
    return _sources(spark, d)


@query("j4_verbatim_quotes")
def _(spark, d):
    return ql.verbatim_quotes(b.filed_quotes(spark, d), _sources(spark, d))


@query("j4_altered_quotes")
def _(spark, d):
    return ql.altered_quotes(b.filed_quotes(spark, d), _sources(spark, d))


@query("j5_dictionary_match")
def _(spark, d):
    return dd.match_dictionary(b.coded_reviews(spark, d), b.dictionary(spark, d))


@query("j5_word_dictionary")
def _(spark, d):
    return dd.match_dictionary(b.coded_reviews(spark, d), b.word_dictionary(spark, d))


@query("j6_uncoded_reviews")
def _(spark, d):
    matches = dd.match_dictionary(b.coded_reviews(spark, d), b.dictionary(spark, d))
    return ql.uncoded_reviews(b.coded_reviews(spark, d), matches, b.out_of_scope(spark, d))


@query("j7_codebook_reuse")
def _(spark, d):
    return ql.codebook_reuse(b.codings(spark, d), b.codebook(spark, d))


@query("j7_codes_outside_codebook")
def _(spark, d):
    return ql.codes_outside_codebook(b.codings(spark, d), b.codebook(spark, d))


@query("j8_revived_codes")
def _(spark, d):
    return cb.revived_codes(b.codings(spark, d), b.decisions(spark, d))


@query("j9_fallback_code")
def _(spark, d):
    reviews = b.coded_reviews(spark, d)
    return dd.code_reviews(reviews, dd.match_dictionary(reviews, b.dictionary(spark, d)))


@query("j10_canonical_map")
def _(spark, d):
    return cb.canonical_map(b.decisions(spark, d))


@query("j10_canonical_codes")
def _(spark, d):
    mapped = cb.canonicalise(b.codings(spark, d), cb.canonical_map(b.decisions(spark, d)))
    return _count(mapped, "app", "canonical", "status")


# --- sampling -----------------------------------------------------------------------------------

def _run(spark: SparkSession, d: str) -> sm.SamplingRun:
    return sm.run_sampling(b.reviews(spark, d), b.sampling_log(spark, d), b.BATCH, b.N_BATCHES, b.SEED, b.MIN_LEN, True)


@query("s1_simple_sample")
def _(spark, d):
    return sm.simple_sample(b.reviews(spark, d), N_TOTAL, b.SEED).select("app", "name", "rating")


@query("s2_stratum_quotas")
def _(spark, d):
    pool = sm.exclude_logged(sm.filter_length(b.reviews(spark, d), b.MIN_LEN), b.sampling_log(spark, d))
    return sm.stratum_quotas(_count(pool, "app", "rating", out="n_rows"), N_TOTAL)


@query("s3_stratified_pick")
def _(spark, d):
    pool = sm.filter_length(b.reviews(spark, d), b.MIN_LEN)
    return sm.stratified_pick(pool, N_TOTAL, b.SEED, b.sampling_log(spark, d)).select("app", "name", "rating")


@query("s4_sample_without_rating")
def _(spark, d):
    return sm.draw_sample(b.reviews(spark, d).drop("rating"), N_TOTAL, b.SEED, stratify=True).select("app", "name", "position")


@query("s5_assign_batches")
def _(spark, d):
    return _run(spark, d).batches


@query("s6_run_summary")
def _(spark, d):
    return _run(spark, d).summary()


@query("s7_rating_distribution")
def _(spark, d):
    return _run(spark, d).ratings()


@query("s8_gold_set")
def _(spark, d):
    none = b.sampling_log(spark, d).limit(0)
    return sm.gold_set(sm.run_sampling(b.reviews(spark, d), none, b.BATCH, b.N_BATCHES, b.SEED).batches)


# --- aggregations -------------------------------------------------------------------------------

@query("a1_merge_summary")
def _(spark, d):
    return cd.merge_summary(b.codings(spark, d))


@query("a2_quotes_per_code")
def _(spark, d):
    return cd.quotes_per_code(b.codings(spark, d))


@query("a3_new_code_rate")
def _(spark, d):
    sizes = _count(b.scope_flags(spark, d), "app", "batch_id", out="n_entries")
    return st.with_new_rate(st.with_entries(st.new_codes(b.codings(spark, d)), sizes))


@query("a4_coding_summary")
def _(spark, d):
    return ql.coding_summary(b.codings(spark, d))


@query("a5_theme_rollup")
def _(spark, d):
    return ql.theme_rollup(b.codings(spark, d))


@query("a5_theme_shape")
def _(spark, d):
    return ql.theme_shape(b.codings(spark, d))


@query("a6_thin_codes")
def _(spark, d):
    return ql.thin_codes(b.codings(spark, d))


@query("a7_scope_rate")
def _(spark, d):
    return ql.scope_rate(b.scope_flags(spark, d))


@query("a8_gap_rate")
def _(spark, d):
    reviews = b.coded_reviews(spark, d)
    return dd.gap_rate(reviews, dd.match_dictionary(reviews, b.dictionary(spark, d)))


@query("a9_deductive_summary")
def _(spark, d):
    reviews = b.coded_reviews(spark, d)
    coded = dd.code_reviews(reviews, dd.match_dictionary(reviews, b.dictionary(spark, d)))
    return dd.deductive_summary(coded, reviews.select("app", "name", F.col("theme").alias("label")))


@query("a9_deductive_quotes")
def _(spark, d):
    reviews = b.coded_reviews(spark, d)
    matches = dd.match_dictionary(reviews, b.dictionary(spark, d))
    placed = matches.join(reviews.select("app", "name", "batch_id"), ["app", "name"])
    gaps = dd.uncovered_reviews(reviews, matches).withColumn("label", F.col("theme"))
    return dd.deductive_quotes(placed, gaps)


@query("a10_gold_agreement")
def _(spark, d):
    return ql.gold_agreement(b.gold_assignments(spark, d))


@query("a11_drifting_quotes")
def _(spark, d):
    return ql.drifting_quotes(b.theme_codings(spark, d))


@query("a12_overlapping_codes")
def _(spark, d):
    return ql.overlapping_codes(b.theme_codings(spark, d))


@query("a12_merge_candidates")
def _(spark, d):
    return ql.similar_codes(b.word_codings(spark, d), 1, 5)


@query("a13_codebook_size")
def _(spark, d):
    expected = spark.createDataFrame(
        [(b.APP, "n_batches", 1.0, 5.0), (b.APP, "n_codes", 12.0, 18.0), (b.APP, "n_themes", 4.0, 6.0)],
        "app string, measure string, low double, high double")
    return ql.against_expectations(ql.codebook_size(b.codings(spark, d)), expected)


@query("a14_codebook_completeness")
def _(spark, d):
    return ql.codebook_completeness(b.codebook(spark, d), b.codings(spark, d))


# --- batch by batch -----------------------------------------------------------------------------

def _entry_counts(spark: SparkSession, d: str) -> DataFrame:
    return _count(b.coded_reviews(spark, d), "app", "batch_id", out="n_entries")


@query("w1_new_codes")
def _(spark, d):
    return st.new_codes(b.undated(b.codings(spark, d)))


@query("w1_kept_first_seen")
def _(spark, d):
    """Three arrivals: the later batches with their codes by quote, the earlier ones, and the later ones corrected."""
    stored = b.scratch(spark)  # the arrivals, written once as they would come in, and not cut from the texts at each reading
    b.undated(b.codings(spark, d).select("app", "batch_id", "theme", "code", "quote")).write.parquet(stored)
    codings = spark.read.parquet(stored)
    middle = materialise(codings.groupBy("app").agg(F.avg("batch_id").alias("_middle")))
    # rows meet the number of their app where they are read: a shuffle by app would bring an app into one task
    split = codings.join(F.broadcast(middle) if fits_broadcast(middle) else middle, "app")
    later, earlier = split.filter("batch_id >= _middle"), split.filter("batch_id < _middle")
    log, path = fs.empty_log(spark), b.scratch(spark)
    for n, part in enumerate((later.withColumn("code", F.col("quote")), earlier, later), 1):
        fs.append_arrival(fs.arrival_rows(log, part, n), path)
        log = fs.read_first_seen_log(spark, path)
    return fs.new_codes(log)


@query("w2_cumulative_codes")
def _(spark, d):
    return st.with_totals(st.new_codes(b.codings(spark, d)))


@query("w3_saturation_report")
def _(spark, d):
    return st.saturation_report(b.undated(b.codings(spark, d)), _entry_counts(spark, d))


@query("w4_final_status")
def _(spark, d):
    return st.final_status(st.saturation_report(b.undated(b.codings(spark, d)), _entry_counts(spark, d)))


@query("w5_stop_rule")
def _(spark, d):
    report = st.with_rolling(st.with_totals(st.new_codes(b.theme_codings(spark, d))))
    return report.select("app", "batch_id", "n_new", "all_last3_le2")


def _ordinals(spark: SparkSession, d: str) -> DataFrame:
    return materialise(st.with_totals(st.new_codes(b.codings(spark, d))).select("app", "batch_id", "ordinal"))


@query("w6_recurring_gaps")
def _(spark, d):
    reviews = b.coded_reviews(spark, d)
    gaps = dd.uncovered_reviews(reviews, dd.match_dictionary(reviews, b.dictionary(spark, d)))
    return dd.recurring_gaps(gaps.withColumn("label", F.concat_ws("-", "theme", "rating")), _ordinals(spark, d))


@query("w6_gap_islands")
def _(spark, d):
    reviews = b.coded_reviews(spark, d)
    gaps = dd.uncovered_reviews(reviews, dd.match_dictionary(reviews, b.dictionary(spark, d)))
    return dd.gap_islands(gaps.withColumn("label", F.concat_ws("-", "theme", "rating")), _ordinals(spark, d))


@query("w7_code_trend")
def _(spark, d):
    return ql.code_trend(b.codings(spark, d), _ordinals(spark, d))


# --- sorts, top-k, sets -------------------------------------------------------------------------

@query("t1_sorted_codebook")
def _(spark, d):
    return cd.sorted_codebook(b.codings(spark, d))


@query("t2_top_codes")
def _(spark, d):
    return ql.top_codes(b.codings(spark, d))


@query("t2_typical_quotes")
def _(spark, d):
    return ql.typical_quotes(b.codings(spark, d))


@query("u1_union_codings")
def _(spark, d):
    both = cd.union_codings(b.codings(spark, d), b.theme_codings(spark, d))
    return _count(both, "app", "batch_id", "theme")


@query("u2_merge_with_origin")
def _(spark, d):
    return cd.merge_with_origin(b.codings(spark, d))


@query("u3_codes_only_in")
def _(spark, d):
    return cd.codes_only_in(b.codings(spark, d), 0, 1)


@query("u4_batch_codes")
def _(spark, d):
    return cd.batch_codes(b.codings(spark, d))


# --- codebook evolution -------------------------------------------------------------------------

@query("g1_upsert_codebook")
def _(spark, d):
    book = b.codebook(spark, d).select("app", "code", "theme", "definition")
    current = book.withColumn("batch_id", F.lit(0).cast("long")).withColumn("seq", F.lit(0)).withColumn("deleted", F.lit(False))
    changed = b.codings(spark, d).groupBy("app", "code").agg(
        F.min("theme").alias("theme"), F.count(F.lit(1)).alias("n"), F.max("batch_id").alias("batch_id"))
    changes = changed.select(
        "app", "code", "theme", F.concat(F.lit("seen "), F.col("n")).alias("definition"), (F.col("batch_id") + 1).alias("batch_id"),
        F.lit(0).alias("seq"), (F.col("n") % 2 == 1).alias("deleted"))
    return cb.upsert_codebook(current, changes).select("app", "code", "theme", "definition", "batch_id")


@query("g2_change_counts")
def _(spark, d):
    return cb.change_counts(cb.read_change_log(b.change_documents(spark, d)))


@query("g2_change_matrix")
def _(spark, d):
    return cb.change_matrix(cb.read_change_log(b.change_documents(spark, d)))


@query("g3_codebook_as_of")
def _(spark, d):
    return cb.codebook_as_of(b.codings(spark, d), b.decisions(spark, d), 11)


@query("g3_codebook_versions")
def _(spark, d):
    return cb.codebook_versions(b.codings(spark, d), b.decisions(spark, d))


@query("g3_codings_as_of")
def _(spark, d):
    return cb.codings_as_of(b.codings(spark, d), b.decisions(spark, d))


# --- prompts ------------------------------------------------------------------------------------

def _prompts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    batches = _run(spark, d).batches
    return pr.build_prompts(b.layers(spark, d), pr.batch_texts(batches)), batches


@query("p1_batch_texts")
def _(spark, d):
    return pr.batch_texts(_run(spark, d).batches)


@query("p2_prompts")
def _(spark, d):
    return _prompts(spark, d)[0]


@query("p3_prompt_log")
def _(spark, d):
    path, prompts = b.scratch(spark), _prompts(spark, d)[0]
    io.write_prompts(prompts.withColumn("prompt", F.lit("earlier")), path)
    io.write_prompts(prompts, path)
    stored = spark.read.schema(prompts.schema).parquet(path)
    return stored.select("app", "stage", "batch_id", F.length("prompt").cast("long").alias("stored_chars"))


@query("p4_missing_layers")
def _(spark, d):
    return pr.missing_layers(b.reviews(spark, d), b.layers(spark, d))


@query("p4_missing_batches")
def _(spark, d):
    wanted = b.coded_reviews(spark, d).select("app", (F.col("batch_id") + 1).alias("batch_id")).distinct()
    return pr.missing_batches(wanted, b.scope_flags(spark, d))


@query("p5_prompt_sizes")
def _(spark, d):
    prompts, batches = _prompts(spark, d)
    return pr.prompt_sizes(prompts, batches, b.PROMPT_BUDGET)
