"""The cascade: its order is stable and by rejections per cost, and what a rule rejects costs later rules nothing."""

import random

from pyspark.sql import functions as F

from quire.llm import rules

SCHEMA = "doc_id bigint, text string"


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


def table(spark, bad, clean, text):
    return spark.createDataFrame([(i, text(i) if i < bad else prose(80, i)) for i in range(bad + clean)], SCHEMA).repartition(3)


def test_order_is_the_same_in_each_run(spark):
    df = table(spark, 150, 350, lambda i: prose(80, i).upper() if i % 2 else prose(20, i))
    runs = [[r.name for r in rules.ordered(d)] for d in (df, df.repartition(7), df.orderBy(F.desc("doc_id")))]
    assert runs[0] == runs[1] == runs[2] and sorted(runs[0]) == sorted(r.name for r in rules.RULES)


def test_the_rule_that_rejects_most_comes_first(spark):
    shouted = [r.name for r in rules.ordered(table(spark, 300, 50, lambda i: prose(80, i).upper()))]
    symbols = [r.name for r in rules.ordered(table(spark, 300, 50, lambda i: prose(80, i) + " ###" * 40))]
    assert shouted[0] == "capitals" and symbols[0] == "symbols"


def test_selectivity_is_given_the_rules_before(spark):
    """What one rule rejects, another that would reject the same rejects no more: it falls behind one that finds others."""
    same = rules.Rule("same", ("n_upper", "word_chars"), lambda u, c: 11 * u > 3 * c)
    few = rules.BASE[0]
    order = [r.name for r in rules.ordered(table(spark, 300, 60, lambda i: prose(80, i).upper() if i % 4 else prose(20, i)), (rules.RULES[3], same, few))]
    assert order.index("few_words") < order.index("same")


def test_short_circuit(spark):
    """A later rule's feature isn't computed for texts that a rule before rejects."""
    df = spark.createDataFrame([(1, "ONE"), (2, "TWO WORDS")], SCHEMA)
    boom = rules.Rule("boom", ("n_words",), lambda n: F.when(n > 0, F.raise_error(F.lit("computed"))).otherwise(F.lit(False)).cast("boolean"))
    assert df.where(rules.verdict((rules.BASE[0], boom), {"text": F.col("text")})).count() == 0


def test_windows_are_sorted_only_where_they_may_reject(spark):
    """The necessary condition of repeated_words never changes its verdict."""
    r = random.Random(4)
    texts = []
    for i in range(200):
        w = prose(60, i).split()
        for _ in range(r.randint(0, 12)):
            a, n = r.randint(0, 50), r.randint(3, 10)
            w += w[a : a + n]
        texts.append((i, " ".join(w)))
    texts += [(1000, None), (1001, ""), (1002, "a b c " * 5000), (1003, "a\tb c\x0bd\x0ce\rf\ng  h ")]
    df = spark.createDataFrame(texts, SCHEMA)
    rule = rules.BASE[1]
    text = F.coalesce("text", F.lit(""))
    whole = rules.Rule(rule.name, rule.uses, rule.rejects)
    got = df.select(rules.verdict((rule,), {"text": text}).alias("a"), rules.verdict((whole,), {"text": text}).alias("b")).collect()
    assert all(x.a == x.b for x in got) and 0 < sum(x.a for x in got) < len(got)


def test_words_and_characters(spark):
    odd = ["", " ", "\x20\x09\x0a\x0b\x0c\x0d", "a\tb c\x0bd\x0ce\rf\ng  h ", "　x　", "\U0001f600 é", " a", "a ", "#*$%&|<> #", "A\n\n \nB\nA\n a\n"]
    df = spark.createDataFrame(list(enumerate(odd)), SCHEMA)
    for r, t in zip(rules.judged(df).orderBy("doc_id").collect(), odd, strict=True):
        w = t.encode().split()
        assert (r.n_words, r.word_chars) == (len(w), sum(len(x.decode()) for x in w)), t
        kept = [x for x in t.split("\n") if x.encode().split()]
        assert r.n_dup_lines == len(kept) - len(set(kept)) and r.n_symbols == sum(c in rules.SYMBOLS for c in t)
