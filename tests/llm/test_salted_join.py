"""The salted join gives the rows of a plain join, whatever the keys' sizes."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm.common import HOT, PARTS, salted_join
from quire.llm.components import components


@pytest.fixture(autouse=True)
def salted(monkeypatch):
    """Small tables are joined plainly; here they are to be salted too."""
    monkeypatch.setattr(common, "FEW", -1)


def test_equals_a_plain_join(spark):
    n = 3 * HOT
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"), (F.col("id") % 1000).alias("x"))
    side = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    want = Counter(tuple(r) for r in rows.join(side, "k").select("k", "x", "y").collect())
    joined = salted_join(rows, side, "k")
    assert joined.columns == ["k", "x", "y"]
    assert Counter(tuple(r) for r in joined.collect()) == want
    assert Counter(tuple(r) for r in salted_join(rows, side, "k", rows.select("k")).collect()) == want


def test_hot_key_is_spread(spark):
    rows = spark.range(6400).select(F.lit(1).cast("long").alias("k"), "id")
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(PARTS))
    sizes = [r["count"] for r in rows.groupBy(part.alias("p")).count().collect()]
    assert len(sizes) == PARTS and max(sizes) < 2 * 6400 / PARTS


def test_empty(spark):
    rows = spark.createDataFrame([], "k long, x long")
    assert salted_join(rows, spark.createDataFrame([(1, 2)], "k long, y long"), "k").count() == 0


def test_components_of_a_hub_a_chain_and_nothing(spark):
    """A star whose centre is its largest node, a chain, loops, nulls and repeated edges."""
    edges = [(1000, i) for i in range(100, 400)] + [(i, i + 1) for i in range(5, 25)] + [(2, 2), (3, None), (5, 6)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys([*range(101, 400), 1000], 100), **dict.fromkeys(range(6, 26), 5)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
