from pyspark.sql import functions as F

from quire.functions.text import wrapped


def test_wrapped_is_one_match(spark):
    """No fold over the words, and blanks, long words and empty lines as before."""
    cases = {"part 123 of 45": ["part", "123 of", "45"], " abcdef": ["abcdef"], "       a": ["", "a"], "abcdefgh i": ["abcdef", "gh i"], "       ": [""], "": [""], "a  \n b  c": ["a  \n b", "c"]}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", wrapped(F.col("t"), 6).alias("l"))
    assert {r["t"]: r["l"] for r in df.collect()} == cases
    assert "aggregate(" not in df._jdf.queryExecution().analyzed().toString()
