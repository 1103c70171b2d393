import pytest
from pyspark.sql import functions as F

from themeloom.functions import fixed, text


def _one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw", ["第一行\n第二行　全角空格", "  a\r\n b\tc  ", "", " x\x1cy ", "a  b   c", "plain", " \n "])
def test_normalise_is_split_and_join(spark, raw):
    assert _one(spark, raw, text.normalise("v")) == " ".join(raw.split())


def test_missing_review_is_empty(spark):
    assert _one(spark, None, text.normalise("v")) == ""
    assert _one(spark, None, text.text_length("v")) == 0


def test_length_counts_code_points(spark):
    assert _one(spark, "中文😀a", text.text_length("v")) == 4


@pytest.mark.parametrize("raw,want", [("“引文。”", "引文"), ("a,b", "a,b"), ("。", ""), ("《x》…", "x"), ("-(ok)-", "ok")])
def test_strip_outer_punctuation(spark, raw, want):
    assert raw.strip(fixed.OUTER_PUNCTUATION) == want
    assert _one(spark, raw, text.strip_outer_punctuation("v")) == want


def test_entry(spark):
    assert _one(spark, "U1", text.entry("v", F.lit(None).cast("string"), F.lit("x y"))) == "[ID:U1] [rating:] x y"


@pytest.mark.parametrize("name,batch,theme", [
    ("batch_00_主题.csv", 0, "主题"), ("batch_00.csv", 0, None), ("batch_100_x.csv", 100, "x"), ("notes.csv", None, None)])
def test_file_names(spark, name, batch, theme):
    assert _one(spark, name, text.file_batch_id("v")) == batch
    assert _one(spark, name, text.file_theme("v")) == theme


@pytest.mark.parametrize("content,want", [("", True), (" \n", True), (None, True), ("x\n（初始为空，首批编码后填入）", True), ("编码A", False)])
def test_placeholder(spark, content, want):
    assert _one(spark, content, text.is_placeholder("v")) is want


def test_rule_flags(spark):
    assert _one(spark, "[ID:1] x", text.has_entry_marks("v"))
    assert _one(spark, "很长…", text.has_ellipsis("v")) and _one(spark, "a...b", text.has_ellipsis("v"))
    assert not _one(spark, "五个字编码", text.code_too_long("v")) and _one(spark, "六个字的编码", text.code_too_long("v"))
