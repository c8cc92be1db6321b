"""Markup strings and column widths on known values."""

import html

from pyspark.sql import functions as F

from quire.functions import markup as m


def test_strings(spark):
    raw = "<a href=\"x\">'&amp;'</a>"
    rows = spark.createDataFrame([(1, raw), (2, "  "), (3, None)], "k int, t string")
    got = {r["k"]: (r["e"], r["s"]) for r in rows.select("k", m.escaped(F.col("t")).alias("e"), m.labelled(F.lit("k"), F.col("t"), "c").alias("s")).collect()}
    assert got == {1: (html.escape(raw), f'<span data-kind="k" class="c">{html.escape(raw)}</span>'), 2: ("  ", ""), 3: ("", "")}


def test_strip_and_classes(spark):
    rows = spark.createDataFrame([(1, [("a", "1"), ("b", "2")], "right"), (2, [], "left")], "k int, p array<struct<label string, value string>>, a string")
    got = {r["k"]: (r["s"], r["c"]) for r in rows.select("k", m.key_strip(F.col("p")).alias("s"), m.align_class(F.col("a")).alias("c")).collect()}
    run = lambda kind, css, x: f'<span data-kind="{kind}" class="{css}">{x}</span>'
    pair = lambda a, b: run(m.LABEL, "k", a) + " " + run(m.VALUE, "v", b)
    assert got == {1: (f'<div class="strip">{pair("a", 1)} <span class="sep">|</span> {pair("b", 2)}</div>', "r"), 2: ("", "")}


def test_initials(spark):
    names = ["CÔNG TY CỔ PHẦN ĐIỆN MÁY VÀ GIA DỤNG HỒNG HÀ", "Công ty TNHH", "Siêu-thị Đông", "ô", "", None]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "k int, n string")
    assert [r["x"] for r in rows.select("k", m.initials(F.col("n")).alias("x")).orderBy("k").collect()] == ["HH", "C", "TĐ", "Ô", "VN", "VN"]


def test_widths(spark):
    rows = spark.createDataFrame([(1, i, w) for i, w in enumerate([4, 0, 10])], "s int, i int, w int")
    assert [(r["col0"], r["col1"]) for r in m.column_spans(rows, "s", "i", "w", 32, 1, 0).orderBy("i").collect()] == [(0, 3), (4, 21), (22, 32)]
    assert [(r["col0"], r["col1"]) for r in m.column_spans(rows, "s", "i", "w", 16, 1, 0).orderBy("i").collect()] == [(0, 3), (4, 11), (12, 16)]
    assert abs(sum(r["pct"] for r in m.column_percents(rows, "s", "i", "w", 32).collect()) - 100) < 1e-9
