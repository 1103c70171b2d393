import tempfile
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from themeloom import schemas
from themeloom.functions import fixed
from themeloom.operators import codings as cd
from themeloom.operators import sampling as sm
from themeloom.sources import tables as io


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_reviews_csv(spark, folder):
    body = 'name,rating,review,platform\nU001,4,这个游戏,ios\n002,,"第一行\n第二行, ""引号"" ",\nNA,5,null,x\nU004,5,,\n'
    Path(folder, "r.csv").write_text("﻿" + body, encoding="utf-8")
    rows = {r["name"]: r for r in io.read_reviews_csv(spark, f"{folder}/r.csv", app="a").collect()}
    assert set(rows) == {"U001", "002", "NA", "U004"}
    assert rows["002"]["rating"] is None and rows["002"]["review"] == '第一行\n第二行, "引号" '
    assert rows["NA"]["review"] == "null" and rows["U004"]["review"] is None and rows["U001"]["platform"] == "ios"


def test_missing_columns(spark, folder):
    Path(folder, "r.csv").write_text("name,review\n1,x\n", encoding="utf-8")
    with pytest.raises(ValueError, match="rating"):
        io.read_reviews_csv(spark, f"{folder}/r.csv")


def test_log(spark, folder):
    path = folder + "/log"
    assert io.read_log(spark, path).isEmpty()
    rows = spark.createDataFrame([("007", "1", 1, 0, "r0"), ("b", "1", 1, 0, "r0")], schemas.SAMPLING_LOG)
    io.append_log(rows, path)
    io.append_log(rows, path)
    io.append_log(spark.createDataFrame([("007", "2", 2, 1, "r1")], schemas.SAMPLING_LOG), path)
    assert {tuple(r) for r in io.read_log(spark, path).collect()} == {("007", "1", 1, 0, "r0"), ("b", "1", 1, 0, "r0"), ("007", "2", 2, 1, "r1")}


def test_batches_round_trip_and_guard(spark, folder):
    reviews = spark.createDataFrame([("a", f"u{i}", "4", f"text\n{i}") for i in range(7)], schemas.REVIEWS)
    run = sm.run_sampling(reviews, spark.createDataFrame([], schemas.SAMPLING_LOG), 3, 2)
    path = folder + "/batches"
    io.write_batches(run.batches, path)
    with pytest.raises(AnalysisException):
        io.write_batches(run.batches, path)
    io.write_batches(run.batches.filter("batch_id = 1"), path, overwrite=True)
    cols = ["app", "batch_id", "name", "rating", "review_norm", "entry"]
    assert {tuple(r) for r in io.read_batches(spark, path).select(cols).collect()} == {tuple(r) for r in run.batches.select(cols).collect()}
    io.write_unused(run.unused(), folder + "/unused")
    assert io.read_unused(spark, folder + "/unused").count() == 1
    io.write_unused(run.unused().limit(0), folder + "/unused")
    assert io.read_unused(spark, folder + "/unused").isEmpty()


def test_coding_files_by_name(spark, folder):
    for name, line in {"batch_00_露营做饭.csv": "a,q1", "batch_100_x y.csv": "b,q2", "batch_01.csv": "c,q3", "batch_02_C++ 100%.csv": "d,q4"}.items():
        Path(folder, name).write_text(f"{fixed.CODING_HEADER}\n{line}\n", encoding="utf-8")
    Path(folder, "batch_00_preview.md").write_text("x", encoding="utf-8")
    good, bad = cd.parse_files(io.read_coding_files(spark, folder, app="a"))
    assert {(r["batch_id"], r["theme"], r["code"]) for r in good.collect()} == {(0, "露营做饭", "a"), (100, "x y", "b"), (1, None, "c"), (2, "C++ 100%", "d")}
    assert bad.isEmpty()


def test_coding_files_come_back_without_a_folder_for_each(spark, folder):
    files = [(app, name, f"好的\n{name}\n\n") for app in ("a", "x/y=1: 2%") for name in ("batch_00_露营.csv", "batch_100_x y.csv", "batch_02_C++ 100%.csv", "batch_03_a=b.csv")]
    files.append(("a", "batch_04.csv", ""))
    for _ in range(2):  # a retry writes the same
        io.write_coding_files(spark.createDataFrame([*files, ("a", None, "x")], "app string, src_file string, content string"), folder)
    got = [tuple(r) for r in io.read_coding_files(spark, folder).collect()]
    assert sorted(got) == sorted((app, name, content + "\n") for app, name, content in files)
    assert len([p for p in Path(folder).rglob("*") if p.is_dir()]) == 2


def test_codebook_and_dictionary(spark, folder):
    c = spark.createDataFrame([("a", "x ", 'he "q", x'), ("a", "y", "引文")], "app string, code string, quote string")
    io.write_codebook_csv(c, folder + "/c")
    assert {tuple(r) for r in io.read_codebook_csv(spark, folder + "/c").collect()} == {tuple(r) for r in c.collect()}
    io.export_dictionary(c, folder + "/d")
    assert io.read_dictionary(spark, folder + "/d").columns == ["app", "code", "term"]
    with pytest.raises(ValueError):
        io.export_dictionary(c.drop("quote"), folder + "/e")


def test_prompt_log_keeps_other_batches(spark, folder):
    s = "app string, stage string, batch_id long, prompt string"
    io.write_prompts(spark.createDataFrame([("a", "inductive", 0, "old"), ("a", "inductive", 1, "old")], s), folder + "/p")
    io.write_prompts(spark.createDataFrame([("a", "inductive", 1, "new")], s), folder + "/p")
    assert {(r["batch_id"], r["prompt"]) for r in spark.read.parquet(folder + "/p").collect()} == {(0, "old"), (1, "new")}


def test_manifest(spark, folder):
    Path(folder, "a.csv").write_text("x", encoding="utf-8")
    one = io.run_manifest(io.source_hashes(spark, folder), {"seed": 42}, "v1").first()
    Path(folder, "a.csv").write_text("y", encoding="utf-8")
    two = io.run_manifest(io.source_hashes(spark, folder), {"seed": 42}, "v1").first()
    assert one["params"] == {"seed": "42"} and one["n_sources"] == 1 and one["source_hash"] != two["source_hash"]
