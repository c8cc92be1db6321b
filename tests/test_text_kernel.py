"""Numbers, words and lines against golden rows: signs, fractions, ties, blanks and long words."""

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import align, labels


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "number, words",
    [
        (133400.0, "Một trăm ba mươi ba nghìn bốn trăm đồng"), (0.4, "Không đồng"), (-15.0, "Âm Mười lăm đồng"), (1005000.0, "Một triệu không trăm lẻ năm nghìn đồng"),
        (21.0, "Hai mươi mốt đồng"), (24.0, "Hai mươi tư đồng"), (35.0, "Ba mươi lăm đồng"), (11.0, "Mười một đồng"), (2.5, "Hai đồng"), (5e12, "Năm nghìn tỷ đồng"), (1e15, "1.000.000.000.000.000 đồng"),
    ],
)
def test_amount_in_words(spark, number, words):
    assert one(spark, T.words_vi(F.lit(number))) == words


@pytest.mark.parametrize(
    "value, style, decimals, text",
    [(1234.5, "dot", 3, "1.234,500"), (1234.5, "comma", 1, "1,234.5"), (2.0, "cents", 0, "2"), (2.0, "dot", 2, "2,00"), (0.95, "dot", 3, "0,950"), (-1234.25, "dot", 1, "-1.234,2"), (2.5, "dot", 0, "2"), (0.125, "comma", 2, "0.12")],
)
def test_quantity(spark, value, style, decimals, text):
    assert one(spark, T.quantity(F.lit(value), style, decimals)) == text


@pytest.mark.parametrize(
    "text, width, lines",
    [("  a b", 4, ["  a", "b"]), ("a  b", 3, ["a", "b"]), ("", 5, [""]), ("   ", 2, [""]), ("abcdefgh ij", 3, ["abc", "def", "gh", "ij"]), ("ab cd", 0, ["ab cd"]), ("a\tb", 9, ["a\tb"]), ("aa  bb  cc", 5, ["aa", "bb", "cc"]), ("xx yyyy", 3, ["xx", "yyy", "y"])],
)
def test_wrapped(spark, text, width, lines):
    assert one(spark, T.wrapped(F.lit(text), width)) == lines


def test_long_and_spaced_texts_are_kept_by_alignment():
    a = "one  two\tthree " * 40
    b = a.replace("three", "thre").replace("two", "tow")
    for x, y in ((a, b), (a[:50], b[:50]), ("word " * 30, ""), ("", "x"), ("abc " * 900, "abd " * 900)):
        p, q = align.align(x, y)
        assert len(p) == len(q) and p.replace("@", "") == x and q.replace("@", "") == y


def test_halved_alignments_score_as_whole_ones(monkeypatch):
    def score(p, q):
        gap = sum(x == "@" or y == "@" for x, y in zip(p, q, strict=True))
        return align.GAP * gap + sum(align.MATCH if x == y else align.MISMATCH + align.SPACE * (" " in (x, y)) for x, y in zip(p, q, strict=True) if "@" not in (x, y))

    pairs = [("the quick brown fox", "teh quikc brwn fox"), ("abcabcabba", "cbabac"), ("a", "xxxax"), ("hello world", "h e l l o")]
    whole = [score(*align._pair(a, b, "@")) for a, b in pairs]
    monkeypatch.setattr(align, "CELLS", 4)
    assert [round(score(*align._pair(a, b, "@")), 9) for a, b in pairs] == [round(x, 9) for x in whole]


def test_chain_goes_into_long_stretches():
    gt = ["start", *["a", "b"] * 60, "mid", *["c"] * 3, "end"]
    noise = ["start", *["a", "b"] * 58, "mid", "c", "end"]
    found = align.chain(gt, noise, 20)
    assert [gt[i] for i, _ in found] == [noise[j] for _, j in found] == ["start", "mid", "end"]
    assert align.chain([], []) == [] and align.chain(["a"], ["b"]) == []


def test_subsequence_and_words():
    assert labels._subsequence("abcbdab", "bdcaba") in ("bcba", "bdab", "bcab") and labels._subsequence("", "x") == ""
    assert labels.word_stats("ab cd", "ab cx") == (5, 2, 2, 4, 1, 1)
    assert labels.word_stats("", "") == (0, 0, 0, 0, 0, 0)


def test_kernels_of_nulls_and_empties(spark):
    row = spark.createDataFrame([(None, "", ["a"], [])], "n string, e string, w array<string>, z array<string>").select(
        T.joined("z").alias("joined"), T.squeezed(F.col("e")).alias("squeezed"), T.is_blank(F.col("n")).alias("blank"), T.is_separator(F.col("n")).alias("sep"), T.split_like(F.lit("a bc"), F.array(F.lit(1), F.lit(1))).alias("split"),
        T.missing_characters(F.lit("b a"), F.lit("a")).alias("missing"), align.unique_words(F.array(*map(F.lit, ["b", "A", "a", "c"]))).alias("unique"), align.unique_words("z").alias("no"),
    ).first()
    assert tuple(row) == ("", "", False, False, ["a", "bc"], ["b"], ["b", "c"], [])
