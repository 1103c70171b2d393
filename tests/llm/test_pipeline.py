"""The pipeline's stages on small input."""

from __future__ import annotations

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import mixing
from llm.tables import stored


def test_stages_one_by_one(spark, docs, rows):
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language_id"](spark, docs, "").cache()
    assert spoken.columns == corpus_pipeline.COLUMNS
    kept = {r.doc_id: r.text for r in spoken.collect()}
    assert kept == {d: t for d, t in rows if any(c.isalpha() for c in t or "")}
    assert spoken.filter("lang is null").count() == 0

    cut = stages["line_dedup"](spark, spoken, "").cache()
    want = {d: t for d, n, gone, t in brute.lines(sorted(kept.items())) if n > gone}
    assert {r.doc_id: r.text for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    single = stages["near_dedup"](spark, cut, "").cache()
    assert {r.doc_id for r in single.collect()} == {d for d, _, _, stays in brute.near(sorted(want.items()), 5) if stays}

    mixed = stages["mix_sources"](spark, single, "")
    assert mixed.columns == corpus_pipeline.COLUMNS
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in single.collect())

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in stages["encode"](spark, mixed, "").collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(want[r.doc_id], add_special_tokens=False).ids


def test_position_is_that_of_the_mix_after_the_reread(spark, make):
    docs = make([(i, f"document {i}") for i in range(1200)]).withColumn("source", F.expr("if(doc_id % 6 = 0, 'a', 'b')"))
    stages = dict(corpus_pipeline.STAGES)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # several files
    read = stored(stages["mix_sources"](spark, docs, ""))
    spark.conf.unset(key)
    assert len(read.inputFiles()) > 1
    got = stages["encode"](spark, read, "").orderBy("position").collect()
    assert [r.position for r in got] == list(range(1200))
    want = mixing.mix(docs).orderBy("slot", "place", "doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in want]
    share = 200**0.5 / (200**0.5 + 1000**0.5)
    for n in range(1, 400):
        assert abs(sum(r.source == "a" for r in got[:n]) - share * n) < 2 * mixing.BLOCK


def test_empty_table_passes(spark, nothing):
    df = nothing
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, "")
    assert df.count() == 0
