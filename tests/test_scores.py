from quire.operators import proof


def test_the_bag_is_made_once_a_record(spark):
    """Not again for each word of a field: the planner had put it inside the search."""
    rows = spark.createDataFrame([(1, [("a", "one two two"), ("b", "...")], "Two three"), (2, [("a", "x")], None)], "k int, f array<struct<role:string,expected:string>>, read string")
    df = proof.scored(rows.repartition(2), "k", "f", "read")
    assert "array_contains(array_distinct" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["k"], r["role"]): r["score"] for r in df.where("k = 1").collect()}
    assert got == {(1, "a"): 0.666667, (1, "b"): 1.0}
