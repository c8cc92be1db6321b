"""Quality rules as a short-circuit cascade. DataFrame functions only.

Rules are predicates over features of the text; a document is kept if none rejects it. On a bounded
sample, drawn by a hash, each rule's cost and selectivity are estimated: the cost is the work its features
do there (code points of the texts that get so far, at a fixed price for each feature), less what the rules
before it have paid for; the selectivity is the share it rejects of what those rules pass. The cascade asks the
rule with the most rejections per cost first, then the best of the rest, and so on. Nothing is timed, so
the order is the same in each run. A feature is computed only where all rules before it have passed, and
once. The order changes the cost alone: the verdict is the same for any order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Rows of the sample on which costs and selectivities are estimated.
SAMPLE = 400
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\u000b\u000c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once; the optimizer would otherwise copy it into every use."""
    return F.get(F.transform(F.array(value), body), 0)


def words(text: Column) -> Column:
    """Cutting at one blank is much cheaper than at a pattern, and the other white space is rare: it becomes blanks first."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def word_chars(w: Column) -> Column:
    """Code points in the words w."""
    return F.length(F.array_join(w, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).cast("long")


def n_upper(text: Column) -> Column:
    """Letters A to Z."""
    return (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long")


def lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def n_dup_lines(x: Column) -> Column:
    """Of the lines x those that equal an earlier one."""
    return (F.size(x) - F.size(F.array_distinct(x))).cast("long")


def windows(w: Column) -> Column:
    """The 64-bit hashes of the 3-word windows of the array w."""
    return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))


def n_again(w: Column) -> Column:
    """Windows of the array w beyond the first of each kind. At most six times as many words are in repeated windows."""
    return let(windows(w), lambda h: F.size(h) - F.size(F.array_distinct(h))).cast("long")


def n_repeat_words(w: Column) -> Column:
    """Words of the array w that lie in a 3-word window that occurs twice or more.

    Windows go by their 64-bit hash. If any occurs again, they are sorted with their place; those beside an equal
    one are repeated. Each adds as many words as it reaches beyond the repeated window before it.
    """

    def covered(at: Column) -> Column:
        step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last"))
        return F.aggregate(F.sort_array(at), F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), step, lambda acc: acc["n"])

    def repeated(s: Column) -> Column:
        h = lambda j: F.get(s, j)["h"]
        twin = lambda x, j: F.coalesce(x["h"] == h(j - 1), F.lit(False)) | F.coalesce(x["h"] == h(j + 1), F.lit(False))
        return F.transform(F.filter(s, twin), lambda x: x["i"])

    def counted(hashes: Column) -> Column:
        keys = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), 0).otherwise(covered(let(keys, repeated)))

    return let(windows(w), counted).cast("long")


@dataclass(frozen=True)
class Feature:
    """of: its value, from the text, or from the words or lines. price: CPU seconds per million code points of the
    text, measured once on whole documents and kept as they are, so that the order doesn't hang on a clock."""

    of: Callable[[Column], Column]
    price: float
    on: str = "text"


FEATURES: dict[str, Feature] = {
    "words": Feature(words, 0.06),
    "n_words": Feature(lambda w: F.size(w).cast("long"), 0.0, "words"),
    "word_chars": Feature(word_chars, 0.022, "words"),
    "n_symbols": Feature(n_symbols, 0.033),
    "n_upper": Feature(n_upper, 0.028),
    "lines": Feature(lines, 0.003),
    "n_lines": Feature(lambda x: F.size(x).cast("long"), 0.0, "lines"),
    "n_dup_lines": Feature(n_dup_lines, 0.003, "lines"),
    "n_again": Feature(n_again, 0.1, "words"),
    "n_repeat_words": Feature(n_repeat_words, 0.25, "words"),
}


@dataclass(frozen=True)
class Rule:
    """rejects: of the features it uses. may: a cheap necessary condition, of features of its own; where it fails, the
    features of rejects aren't computed."""

    name: str
    uses: tuple[str, ...]
    rejects: Callable[..., Column]
    first: tuple[str, ...] = ()
    may: Callable[..., Column] | None = None


#: The first two reject a document whatever the others say.
BASE = (
    Rule("few_words", ("n_words",), lambda n: n < 50),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n, ("n_again", "n_words"), lambda a, n: 600 * a > 50 * n),
)
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("capitals", ("n_upper", "word_chars"), lambda u, c: 10 * u > 3 * c),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 12 * n)),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
)


def verdict(rules: Sequence[Rule], known: dict[str, Column]) -> Column:
    """True if no rule rejects. known: the text, and features that are there already.

    The cascade is one nested expression: a rule's features are bound to names inside the branch that its
    predecessors pass, so they are computed there, once, and later rules use the same values.
    """
    if not rules:
        return F.lit(True)
    rule, *rest = rules

    def bound(names: Sequence[str], known: dict[str, Column], body: Callable[[dict[str, Column]], Column]) -> Column:
        missing = [n for n in names if n not in known]
        if not missing:
            return body(known)
        on = FEATURES[missing[0]].on
        if on not in known:
            return bound([on, *names], known, body)
        return let(FEATURES[missing[0]].of(known[on]), lambda v: bound(names, {**known, missing[0]: v}, body))

    def asked(known: dict[str, Column]) -> Column:
        return F.when(rule.rejects(*(known[n] for n in rule.uses)), F.lit(False)).otherwise(verdict(rest, known))

    if rule.may is None or all(n in known for n in rule.uses):
        return bound(rule.uses, known, asked)
    exact = lambda known: bound(rule.uses, known, lambda k: rule.rejects(*(k[n] for n in rule.uses)))
    return bound(rule.first, known, lambda k: F.when(F.when(rule.may(*(k[n] for n in rule.first)), exact(k)).otherwise(F.lit(False)), F.lit(False)).otherwise(verdict(rest, k)))


def sampled(docs: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """The texts of about ``rows`` rows: those of the ids with the smallest hashes, and never more than four times as many.

    Choosing reads the ids alone; the texts are then read by those ids, which a scan of Parquet takes as a filter.
    """
    ids = [r[0] for r in docs.where("doc_id is not null").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()]
    return docs.where(F.col("doc_id").isin(ids) if ids else F.col("doc_id").isNull()).select(F.coalesce("text", F.lit("")).alias("text")).limit(4 * rows)


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE) -> list[Rule]:
    """rules by rejections per cost, each given those before it, as estimated on a sample; ties keep the given order.

    No text goes to the driver: only each sampled row's sizes and hits do. Of an empty table the given order is
    returned, and the order is the same in each run over the same rows.
    """
    have = {"text": F.col("text")}
    for name, f in FEATURES.items():
        have[name] = F.col(name)
    split = ("words", "lines")
    texts = cut(sampled(docs, rows)).select("text", *[FEATURES[name].of(F.col("text")).alias(name) for name in split])
    counted = texts.select(F.length("text").alias("chars"), *[f.of(F.col(f.on)).alias(name) for name, f in FEATURES.items() if name not in split])
    got = counted.select("chars", *[F.coalesce(r.rejects(*(have[u] for u in r.uses)), F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]).collect()
    if not got:
        return list(rules)
    chars = [r["chars"] for r in got]
    hit = [{k for k, r in enumerate(got) if r[f"r{i}"]} for i in range(len(rules))]
    left, open_, paid, out = set(range(len(got))), list(range(len(rules))), {"text"}, []
    while open_:

        def needs(i: int) -> set[str]:
            names = set(rules[i].first or rules[i].uses)
            return (names | {FEATURES[n].on for n in names}) - paid

        def gain(i: int) -> float:
            cost = (1e-4 + sum(FEATURES[n].price for n in needs(i))) * (1 + sum(chars[k] for k in left))
            return len(hit[i] & left) / cost

        best = max(open_, key=lambda i: (gain(i), -i))
        out.append(rules[best])
        left -= hit[best]
        paid |= needs(best)
        open_.remove(best)
    return out


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the features and verdicts of docs (doc_id, text, ...), one row per row.

    A null text is as the empty one: no words, and rejected for that. kept is false if a base rule
    fails, else the cascade's verdict. Repeated rows are judged alike; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", text.alias("text"), words(text).alias("words"), lines(text).alias("lines"))
    told = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = split.select("doc_id", "text", "lines", *[FEATURES[n].of(F.col(FEATURES[n].on)).alias(n) for n in told])
    base = F.lit(False)
    for r in BASE:
        base = base | r.rejects(*map(F.col, r.uses))
    known = {n: F.col(n) for n in ["text", "lines", *told]}
    return rows.select("doc_id", *told, base.alias("base_failed"), verdict(ordered(docs, rules), known).alias("kept"))


def kept(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of docs that no rule rejects, each column as it was.

    Here the cascade decides which features are computed at all. A null text is as the empty one; repeated rows
    stay or go together; an empty table gives no rows.
    """
    return docs.where(verdict(ordered(docs, rules), {"text": F.coalesce(F.col("text"), F.lit(""))}))
