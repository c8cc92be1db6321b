"""Edges of files, pairs of files, shards and gap stretches on small fixtures."""

from pyspark.sql import functions as F

from quire.operators import align
from quire.sources import files


def test_blank_edges(spark):
    rows = spark.createDataFrame([(1, "\na\n\n"), (2, ""), (3, " \n"), (4, None), (5, "a\nb")], "k int, t string")
    got = {r["k"]: (r["f"], r["l"]) for r in rows.select("k", files.without_blank_edge(F.col("t")).alias("f"), files.without_blank_edge(F.col("t"), True).alias("l")).collect()}
    assert got == {1: ("a\n\n", "\na\n"), 2: ("", ""), 3: ("", " "), 4: (None, None), 5: ("a\nb", "a\nb")}


def test_reading_order_and_pairs(spark):
    rows = spark.createDataFrame([(1, [("b", 5), ("c", 5), ("a", 1)], "x"), (2, [], "whole"), (3, None, "none")], "k int, lines array<struct<text string, top int>>, t string")
    assert {r["k"]: r["o"] for r in rows.select("k", files.reading_order(F.col("lines"), F.col("t")).alias("o")).collect()} == {1: "a b c", 2: "whole", 3: "none"}
    both, alone = files.paired(spark.createDataFrame([("x/a.txt",), ("x/b.c.txt",), ("x/.hid",)], "path string"), spark.createDataFrame([("y/a.json", 1), ("y/b.c.json", 2)], "path string, v int"))
    assert sorted((r["stem"], r["v"]) for r in both.collect()) == [("a", 1), ("b.c", 2)]
    assert [r["path"] for r in alone.collect()] == ["x/.hid"]


def test_finished_shards(spark):
    planned = spark.createDataFrame([(0,), (1,), (2,)], "shard int")
    done, open_ = files.finished(spark.createDataFrame([(0,), (2,), (2,)], "shard int"), planned)
    assert sorted(r[0] for r in done.collect()) == [0, 2] and [r[0] for r in open_.collect()] == [1]


def test_gap_runs(spark):
    rows = spark.createDataFrame([(1, ("cat sat@", "c@t@saxs")), (2, ("a @b", "a@ b")), (3, ("", "")), (4, ("rm", "m@")), (5, ("same", "same"))], "k int, p struct<gt string, noise string>")
    runs = align.gap_runs(rows, "p", "@")
    got = {r["k"]: [(x["src"], x["target"], x["spacing"], x["kind"]) for x in r["runs"]] for r in runs.collect()}
    assert got[1] == [("a", "", 0, "delete"), ("", "", 1, "spacing"), ("t", "xs", 0, "replace")]
    assert got[2] == [("", "", 2, "spacing")] and got[3] == [] == got[5] and got[4] == [("rm", "m", 0, "replace")]
    stats = {r["k"]: (r["insert"], r["delete"], r["replace"], r["spacing"]) for r in align.gap_stats(runs, "k").collect()}
    assert stats[1] == (0, 1, 1, 1) and stats[2] == (0, 0, 0, 2)
    assert {(r["src"], r["target"], r["n"]) for r in align.substitutions(runs).collect()} == {("t", "xs", 1), ("rm", "m", 1)}
