"""CSV with quoted line breaks, read in splits of any size, against the reader that takes whole files."""

import random
import tempfile
from pathlib import Path

import pytest

from themeloom.sources import quoted_csv as qc


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def whole(spark, path):
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False, nullValue="", emptyValue="")


def write(folder, name, rows, end="\n", bom=False):
    quoted = ['"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n\r') or i % 3 == 0 else c for i, c in enumerate(c for r in rows for c in r)]
    lines = [",".join(quoted[i * 3 : i * 3 + 3]) for i in range(len(rows))]
    text = ("﻿" if bom else "") + end.join(["name,rating,review", *lines]) + end
    Path(folder, name).write_bytes(text.encode())


def rows_of(seed, n):
    r = random.Random(seed)
    pieces = ["word ", "two\nlines", '"', '""', ",", "é😀", "\n\n", "\r\n", " ", "long " * 9, ""]
    return [(str(i), r.choice(["1", "", "5"]), "x" + "".join(r.choice(pieces) for _ in range(r.randrange(7))) + "y") for i in range(n)]


def equal(spark, path):
    got = sorted(map(tuple, qc.read_quoted_csv(spark, path).collect()), key=str)
    want = sorted(map(tuple, whole(spark, path).collect()), key=str)
    assert got == want
    return got


@pytest.mark.parametrize("size", ["64b", "1k", "128m"])
def test_equals_the_whole_file_reader_at_any_split(spark, folder, size):
    write(folder, "a.csv", rows_of(1, 150))
    write(folder, "b.csv", rows_of(2, 80), bom=True)
    write(folder, "c.csv", [])
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        assert len(equal(spark, folder)) == 230
        if size == "64b":
            assert qc._scan(spark, folder).rdd.getNumPartitions() > 50
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_one_large_file_gives_many_tasks(spark, folder):
    write(folder, "a.csv", [(str(i), "3", "line\nbreak " * 20) for i in range(2000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = qc.read_quoted_csv(spark, folder)
        assert df.count() == 2000 and df.filter("review = repeat('line\nbreak ', 20)").count() == 2000
        assert qc._scan(spark, folder).rdd.getNumPartitions() >= 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_record_over_many_splits_and_windows_line_ends(spark, folder):
    long = "\n".join(f"line {i} \"\"" for i in range(300))
    write(folder, "a.csv", [("1", "2", "before"), ("2", "2", long), ("3", "2", "after")], end="\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        assert sorted(r["review"] for r in qc.read_quoted_csv(spark, folder).collect()) == sorted(["before", long, "after"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_of_other_widths_and_empty_lines(spark, folder):
    Path(folder, "a.csv").write_text('name,rating,review\n\n1,2\n2,3,"a"\n\n"3",,\n4,5,6,7\n')
    equal(spark, folder)


def test_a_quote_that_never_closes_takes_the_rest_of_its_file(spark, folder):
    Path(folder, "a.csv").write_text('name,rating,review\n1,2,x\n2,3,"open\n3,4,y\n')
    Path(folder, "b.csv").write_text('name,rating,review\n9,9,z\n')
    assert {r["name"] for r in qc.read_quoted_csv(spark, folder).collect()} == {"1", "2", "9"}


def test_plan_reads_in_splits(spark, folder):
    write(folder, "a.csv", rows_of(3, 20))
    plan = qc.read_quoted_csv(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "multiLine" not in plan and "Cartesian" not in plan
