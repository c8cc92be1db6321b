import json

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import align as A
from quire.operators import records, sampling, stats, tables
from quire.sources import files
from quire.streaming import monitor


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_money_and_words(spark):
    assert one(spark, T.money(F.lit(-1234567.5), "dot", suffix="đ")) == "-1.234.568đ"
    assert one(spark, T.money(F.lit(2.5), "dot")) == "2"
    assert one(spark, T.money(F.lit(123456.0), "cents", prefix="$")) == "$1,234.56"
    assert one(spark, T.money(F.lit(1234.5), "comma_2dp")) == "1,234.50"
    assert one(spark, T.amount(F.lit("-1.234"), "dot")) == -1234.0
    assert one(spark, T.words_vi(F.lit(121000).cast("bigint"))) == "Một trăm hai mươi mốt nghìn đồng"
    assert one(spark, T.words_vi(F.lit(0).cast("bigint"))) == "Không đồng"
    assert one(spark, T.ean13_check(F.lit("400638133393"))) == 1
    assert one(spark, T.filled(F.lit("{a}-{b}"), F.create_map(F.lit("a"), F.lit("1")))) == "1-{b}"
    assert one(spark, T.wrapped(F.lit("aaa bb cccccccc"), 6)) == ["aaa bb", "cccccc", "cc"]


def test_fold_and_tokens(spark):
    df = spark.createDataFrame([("Đường Số",), (None,)], "x string").select(T.ascii_fold("x").alias("f"), T.tokens(F.col("x")).alias("t"))
    assert [(r.f, r.t) for r in df.collect()] == [("Duong So", ["đường", "số"]), (None, None)]


def test_alignment_is_lossless_and_best():
    for gt, noise in [("New York is big.", "N ewYork kis big."), ("", "abc"), ("abc", ""), ("a b", "ab"), ("same", "same")]:
        a, b = A.align(gt, noise)
        assert len(a) == len(b) and a.replace("@", "") == gt and b.replace("@", "") == noise
    a, b = A.align("New York is big.", "N ewYork kis big.")
    assert A.token_map(a, b) == [[0, 1], [1], [2], [3]] and A.token_map(b, a) == [[0], [0, 1], [2], [3]]
    long = " ".join(f"word{i} filler" for i in range(80))
    a, b = A.align(long, long.replace("word7 ", "w0rd7 "))
    assert a == long and len(a) == len(b)
    assert A.lcs_length("abcbdab", "bdcaba") == 4
    assert A.corrected(["B-A", "I-A", "O", "I-A", "I-C"]) == ["B-A", "I-A", "O", "B-A", "B-C"]


def test_sampling_respects_tags(spark):
    from quire.plans.registry import OPTIONS

    options = spark.createDataFrame(OPTIONS, sampling.SCHEMA)
    rows = sampling.sample(spark.range(200).withColumnRenamed("id", "draw"), options).collect()
    assert len(rows) == 200 and len({r["draw"] for r in rows}) == 200
    for r in rows:
        a = r["attributes"]
        assert a["layout"] != "grid" or a["document"] == "bill"
        assert a["visual"] != "stamp" or a["document"] == "bill"
    forced = sampling.sample(spark.range(9).withColumnRenamed("id", "draw"), options, {"document": "letter"}).collect()
    assert {r["attributes"]["document"] for r in forced} == {"letter"}
    changed = sampling.overridden(options, spark.createDataFrame([("layout", "grid", 0.0)], "attr string, id string, weight double"))
    assert [tuple(r) for r in sampling.invalid(changed).collect()] == [("layout", "grid", "no weight")]


def test_records_and_leaves(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": [1, {"c": "x"}]}, "d": null}'), (2, "torn {")], "id int, j string")
    got = {(r.id, r.path, r.leaf) for r in records.json_leaves(df, "id", "j").collect()}
    assert {(1, "a.b", "1"), (1, "a.b.c", "x"), (1, "d", None)} <= got
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    assert records.diff(a, a.where("k = 1"), "k", ["v"]).count() == 2
    assert records.digest(a, ["k", "v"]).collect() == records.digest(a.orderBy(F.desc("k")), ["k", "v"]).collect()


def test_tables(spark):
    markup = "<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>"
    cells = spark.range(1).select("id", F.explode(tables.cells_of(F.lit(markup))).alias("c")).select("id", "c.*")
    assert [(r.row, r.col, r.text) for r in cells.orderBy("row", "col").collect()] == [(0, 0, "a"), (0, 1, "b"), (1, 1, "c")]
    tokens = tables.structure_tokens(cells, "id").select(tables.rebuilt(F.col("tokens"), F.array(*map(F.lit, "abc"))).alias("x")).first()["x"]
    assert tokens == '<tr><td rowspan="2">a</td><td>b</td></tr><tr><td>c</td></tr>'
    assert tables.span_problems(cells, "id").count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('x\t1\n# no\nbad\n"q\t2\n')
    assert sorted(tuple(r) for r in files.read_columns(spark, str(tmp_path / "a.tsv"), ["n", "v"]).collect()) == [('"q', "2"), ("x", "1")]
    text = "a\tB-X\nb\tI-X\n\nc\tO"
    rows = files.iob(spark.createDataFrame([("f", text)], "f string, t string"), "f", "t")
    assert files.to_iob(rows, "f").first()["value"] == text
    (tmp_path / "jobs.json").write_text(json.dumps([{"seed": 1, "count": 2}]))
    assert files.read_jobs(spark, str(tmp_path / "jobs.json")).count() == 1
    df = spark.range(6).withColumn("problems", F.array().cast("array<string>"))
    files.write_records(df, str(tmp_path / "out"))
    files.write_split(df.select("id"), str(tmp_path / "split"), "id", ["train", "test"])
    assert spark.read.json(str(tmp_path / "split")).groupBy("split").count().where("count = 3").count() == 2


def test_stream_restarts(spark, tmp_path):
    for i, rows in enumerate([[("a", 1, 5), ("b", 1, 2)], [("a", 2, 1), ("b", 2, 3)]]):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("shard", "scan", "images"), r, strict=True))) for r in rows))
    q = monitor.restarts(monitor.scans(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("restarts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [tuple(r) for r in spark.table("restarts").collect()] == [("a", 2, 5, 1)]


def test_drift_of_even_mix_is_quiet(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "b")] * 40 + [("t", "a")] * 40, "s string, v string")
    got = {r.s: r.drifted for r in stats.drift(df, "s", "v").collect()}
    assert got == {"s": False, "t": True}
