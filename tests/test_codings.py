import pytest

from themeloom.operators import codings as cd

HEADER = "分类,检索词"


def _files(spark, *files):
    return spark.createDataFrame([("a", n, c) for n, c in files], "app string, src_file string, content string")


def _parse(spark, lines, name="batch_00_t.csv"):
    good, bad = cd.parse_files(_files(spark, (name, "\n".join(lines))))
    return (sorted((r["line_no"], r["code"], r["quote"]) for r in good.collect()),
            sorted((r["line_no"] or 0, r["reason"]) for r in bad.collect()))


@pytest.mark.parametrize("line,want", [
    ('编码A,"a,b"', ("编码A", "a,b")), ('编码D,"he ""q"" x"', ("编码D", 'he "q" x')), (" 编码E ,“引文。”", ("编码E", "引文")),
    ("编码B,x,y", None), ("编码B,x,", None), ("only", None), ("--- 主题：X ---", None)])
def test_odd_lines(spark, line, want):
    good, bad = _parse(spark, ["任意前言", HEADER, line])
    assert good == ([(3, *want)] if want else [])
    assert bad == ([] if want else [(3, "column_count")])


def test_dropped_rows_are_no_rejects(spark):
    assert _parse(spark, ["﻿" + HEADER, ",x", "编码F,。", "", "  ", ",", HEADER, "c,q"]) == ([(8, "c", "q")], [])


def test_header_after_windows_line_ends(spark):
    good, bad = cd.parse_files(_files(spark, ("batch_100_主题.csv", f"x\r\n {HEADER} \r\nc,q\r\n")))
    row = good.first()
    assert (row["batch_id"], row["theme"], row["code"], row["quote"], row["line_no"]) == (100, "主题", "c", "q", 3)
    assert bad.isEmpty()


def test_no_header_is_rejected_or_fails(spark):
    assert _parse(spark, ["c,q"]) == ([], [(0, "no_header")])
    with pytest.raises(ValueError):
        cd.parse_files(_files(spark, ("batch_00_t.csv", "c,q")), fail_fast=True)


def test_file_of_just_a_header(spark):
    assert _parse(spark, [HEADER]) == ([], [])


def test_line_breaks_inside_quotes(spark):
    good, bad = _parse(spark, [HEADER, 'x,"ab', 'cd"', 'y,"p ""q', '', 'r"" s"', "z,w"])
    assert good == [(2, "x", "ab\ncd"), (4, "y", 'p "q\n\nr" s'), (7, "z", "w")] and bad == []


def test_quotes_that_never_close(spark):
    assert _parse(spark, [HEADER, 'z,"open, no end']) == ([], [(2, "open_quote")])
    good, bad = _parse(spark, [HEADER, 'z,"open', 'y,"ok"', "x,plain"])
    assert (good, bad) == ([(3, "y", "ok"), (4, "x", "plain")], [(2, "open_quote")])


def test_files_that_name_no_batch(spark):
    good, bad = cd.parse_files(_files(spark, ("batch_preview_t.csv", f"{HEADER}\nc,q"), ("batch_03_t.csv", f"{HEADER}\nc,q\n")))
    assert [(r["batch_id"], r["line_no"]) for r in good.collect()] == [(3, 2)]
    assert [(r["src_file"], r["reason"], r["line_no"]) for r in bad.collect()] == [("batch_preview_t.csv", "file_name", None)]


def test_answers(spark):
    body = f"前言\n--- 主题：甲 ---\n\n{HEADER}\na,q1\n\n--- 主题：乙 ---\n{HEADER}\nb,\"q,2\"\nb,q3,x\n"
    df = spark.createDataFrame([("a", "r1", 0, body)], "app string, response_id string, batch_id long, text string")
    good, bad = cd.parse_answers(df)
    assert sorted((r["theme"], r["code"], r["quote"]) for r in good.collect()) == [("乙", "b", "q,2"), ("甲", "a", "q1")]
    assert [(r["theme"], r["line"], r["reason"]) for r in bad.collect()] == [("乙", "b,q3,x", "column_count")]


def test_answers_without_theme_or_header(spark):
    rows = [("a", "r1", 0, "no theme here"), ("a", "r2", 0, "--- 主题：甲 ---\na,b"), ("a", "r3", 1, None)]
    good, bad = cd.parse_answers(spark.createDataFrame(rows, "app string, response_id string, batch_id long, text string"))
    assert good.isEmpty()
    assert sorted((r["response_id"], r["reason"]) for r in bad.collect()) == [("r1", "no_theme"), ("r2", "no_header"), ("r3", "no_theme")]


def _codings(spark, rows):
    return spark.createDataFrame([("a", b, t, c, q, f"batch_{b:02d}_{t}.csv", i) for i, (b, t, c, q) in enumerate(rows)],
                                 "app string, batch_id long, theme string, code string, quote string, src_file string, line_no int")


def test_merge(spark):
    c = _codings(spark, [(1, "t", "x", "q"), (0, "u", "x", "q"), (0, "u", "y", "q"), (0, "u", "x", "p")])
    assert [tuple(r)[1:] for r in cd.sorted_codebook(c).collect()] == [("x", "p"), ("x", "q"), ("y", "q")]
    assert tuple(cd.merge_summary(c).first())[1:] == (4, 3, 2)
    assert [tuple(r)[1:] for r in cd.quotes_per_code(c).collect()] == [("x", 2), ("y", 1)]
    first = {(r["code"], r["quote"]): (r["first_batch"], r["first_file"], r["n_rows"]) for r in cd.merge_with_origin(c).collect()}
    assert first[("x", "q")] == (0, "batch_00_u.csv", 2)
    assert {r["code"] for r in cd.codes_only_in(c, 0, 1).collect()} == {"y"}
