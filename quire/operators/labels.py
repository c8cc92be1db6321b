"""Labels of tokens: their forms, sentences projected to noisy tokens, documents packed to pages, word statistics."""

from __future__ import annotations

import re
import string

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .align import GAP_CHAR, align, token_map

_BEGIN, _INSIDE = r"^\s*B-([a-zA-Z|]+)\s*$", r"^\s*I-([a-zA-Z|]+)\s*$"
#: Characters that may mark a gap, the usual one first.
PRINTABLE = GAP_CHAR + "".join(sorted(set(string.printable) - set(string.whitespace) - {GAP_CHAR}))
EMPTY, EMPTY_LABEL = "<<<<EMPTY_OCR_SENTENCE>>>>", "O"


def is_begin(label: Column) -> Column:
    return F.coalesce(label.rlike(_BEGIN), F.lit(False))


def is_inside(label: Column) -> Column:
    return F.coalesce(label.rlike(_INSIDE), F.lit(False))


def is_entity(label: Column) -> Column:
    return is_begin(label) | is_inside(label)


def clean(label: Column) -> Column:
    """An entity's label without white space around it; others as they are."""
    return F.when(is_entity(label), F.regexp_replace(label, r"^\s+|\s+$", "")).otherwise(label)


def to_begin(label: Column) -> Column:
    return F.when(is_inside(label), F.regexp_replace(clean(label), "^I-", "B-")).otherwise(label)


def to_inside(label: Column) -> Column:
    return F.when(is_begin(label), F.regexp_replace(clean(label), "^B-", "I-")).otherwise(label)


def lacks_begin(before: Column, label: Column) -> Column:
    """Whether an inside label continues no entity: the one before is of another kind, or none."""
    kind = lambda x: F.regexp_extract(x, "^[BI]-(.*)$", 1)
    return is_inside(label) & ~(F.coalesce(is_entity(before), F.lit(False)) & (kind(clean(before)) == kind(clean(label))))


def gap_candidates(*texts: Column) -> Column:
    """Printable characters that no text has, the usual gap first."""
    used = F.array_distinct(F.split(F.concat(*texts), ""))
    return F.array_except(F.split(F.lit(PRINTABLE), ""), used)


def display(tokens: Column, labels: Column, label_top: bool = True) -> Column:
    """Tokens and labels as two lines, padded so that they stand above each other."""
    width = F.zip_with(tokens, labels, lambda t, x: F.greatest(F.length(t), F.length(x)) + 1)
    padded = lambda xs: F.array_join(F.zip_with(xs, width, lambda x, w: F.rpad(x, w, F.lit(" "))), "")
    first, second = (labels, tokens) if label_top else (tokens, labels)
    return F.concat(padded(first), F.lit("\n"), padded(second))


@F.pandas_udf(ArrayType(ArrayType(IntegerType())))
def token_maps(gt: pd.Series, noise: pd.Series) -> pd.Series:
    """For each clean token the places of the noisy ones that it is aligned with."""
    return pd.Series([token_map(*align(" ".join(a), " ".join(b))) for a, b in zip(gt, noise, strict=True)])


def projected_sentences(docs: DataFrame, key: str) -> DataFrame:
    """(key, sent, first, last, tokens): the noisy tokens of each clean sentence.

    docs: key, gt and noise (arrays of tokens), starts (the places of the sentences' first clean tokens). A
    sentence whose first token is aligned with nothing begins at the next token that is; the first sentence
    begins at 0 if its own is, and what nothing follows is at the end. So sentences share all tokens but those
    before the first aligned one.
    """
    rows = docs.withColumn("map", token_maps("gt", "noise"))
    places = F.transform("map", lambda m: F.get(m, 0))
    after = lambda i: F.get(F.filter(F.slice(places, i + 1, F.size(places)), lambda x: x.isNotNull()), 0)
    n = F.size("noise")
    begin = F.transform("starts", lambda s: F.when((s == 0) & F.get(places, 0).isNull(), 0).otherwise(F.coalesce(after(s), n)))
    each = rows.withColumn("begin", begin).select(key, "noise", "begin", F.posexplode("begin").alias("sent", "first"))
    last = F.coalesce(F.get("begin", F.col("sent") + 1), F.size("noise"))
    out = each.withColumn("last", last)
    return out.select(key, "sent", "first", "last", F.slice("noise", F.col("first") + 1, F.greatest(F.col("last") - F.col("first"), F.lit(0))).alias("tokens"))


def sentence_mismatches(clean_rows: DataFrame, noisy_rows: DataFrame, key: str) -> DataFrame:
    """(key, clean, noisy, doubles): files whose sentences are not as many on both sides, or that part two of them twice.

    Rows are lines (key, line_no, value); a blank line ends a sentence.
    """

    def counted(rows: DataFrame, name: str) -> DataFrame:
        by = Window.partitionBy(key).orderBy("line_no")
        blank = F.trim("value") == ""
        flagged = rows.select(key, blank.alias("blank"), F.coalesce(F.lag(blank).over(by), F.lit(True)).alias("before"))
        return flagged.groupBy(key).agg(F.count_if(~F.col("blank") & F.col("before")).alias(name), F.count_if(F.col("blank") & F.col("before")).alias(f"{name}_doubles"))

    both = counted(clean_rows, "clean").join(counted(noisy_rows, "noisy"), key)
    return both.where("clean <> noisy or noisy_doubles > 0").select(key, "clean", "noisy", F.col("noisy_doubles").alias("doubles"))


def packed(sentences: DataFrame, key: str, order: str, size: str, limit: int) -> DataFrame:
    """sentences with page: consecutive ones share a page while their sizes add up to at most limit.

    A fold over a document's sizes, in order; a sentence above the limit has a page of its own, and those of one
    place in the order go together.
    """
    listed = sentences.groupBy(key, order).agg(F.sum(size).alias(size)).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(size).cast("bigint").alias("s")))).alias("x"))

    def step(acc: Column, x: Column) -> Column:
        new = (acc["used"] > 0) & (acc["used"] + x["s"] > limit)
        page = acc["page"] + new.cast("int")
        return F.struct(page.alias("page"), F.when(new, x["s"]).otherwise(acc["used"] + x["s"]).alias("used"), F.concat(acc["out"], F.array(F.struct(x["o"].alias("o"), page.alias("page")))).alias("out"))

    kind = sentences.schema[order].dataType.simpleString()
    start = F.struct(F.lit(0).alias("page"), F.lit(0).cast("bigint").alias("used"), F.array().cast(f"array<struct<o:{kind},page:int>>").alias("out"))
    pages = listed.select(key, F.explode(F.aggregate("x", start, step, lambda acc: acc["out"])).alias("p")).select(key, F.col("p.o").alias(order), F.col("p.page").alias("page"))
    return sentences.join(pages, [key, order])


def page_texts(pages: DataFrame, key: str, order: str) -> DataFrame:
    """(key, page, words, labels, text): each page's sentences (arrays words, labels) one after the other."""
    whole = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(c).alias("x")))), lambda s: s["x"]))
    out = pages.groupBy(key, "page").agg(whole("words").alias("words"), whole("labels").alias("labels"))
    return out.withColumn("text", F.array_join("words", " "))


WORD_STATS = StructType([StructField(n, IntegerType()) for n in ("total_chars", "total_words", "total_alnum_words", "matching_chars", "matching_words", "matching_alnum_words")])


def _bare(text: str, gap: str) -> bool:
    return not text.replace(gap, "").strip()


def word_stats(src: str, target: str, gap: str = GAP_CHAR) -> tuple[int, ...]:
    """Counts over an aligned pair: target's words, and those that stand whole inside stretches where both agree.

    A stretch's first word counts if a blank on both sides, the text's begin or nothing but gaps is before it; its
    last word likewise.
    """
    plain_src, plain = src.replace(gap, ""), target.replace(gap, "")
    words = plain.split()
    chars = hit = alnum = 0
    n, at = len(src), 0
    same = [a == b for a, b in zip(src, target, strict=True)]
    while at < n:
        if not same[at]:
            at += 1
            continue
        end = at
        while end < n and same[end]:
            end += 1
        chars += end - at
        part = target[at:end]
        inside = list(re.finditer(r"\S+", part))
        for k, m in enumerate(inside):
            open_left = k == 0 and m.start() == 0 and at > 0 and not ((_bare(src[:at], gap) and target[at - 1] == " ") or (_bare(target[:at], gap) and src[at - 1] == " "))
            open_right = k == len(inside) - 1 and m.end() == len(part) and end < n and not ((_bare(src[end:], gap) and target[end] == " ") or (_bare(target[end:], gap) and src[end] == " "))
            if not open_left and not open_right:
                hit += 1
                alnum += bool(re.search(r"\w", m[0]))
        at = end
    return max(len(plain), len(plain_src)), len(words), sum(bool(re.search(r"\w", w)) for w in words), chars, hit, alnum


@F.pandas_udf(WORD_STATS)
def word_matches(gt: pd.Series, noise: pd.Series) -> pd.DataFrame:
    """word_stats() of aligned pairs; src is the noisy side."""
    return pd.DataFrame([word_stats(b or "", a or "") for a, b in zip(gt, noise, strict=True)], columns=[f.name for f in WORD_STATS])


def accuracies(stats: Column) -> list[Column]:
    """Shares of characters and words that match; null where there are none."""
    share = lambda a, b: F.round(stats[a] / F.nullif(stats[b], F.lit(0)), 6)
    return [share("matching_chars", "total_chars").alias("char_accuracy"), share("matching_words", "total_words").alias("word_accuracy"), share("matching_alnum_words", "total_alnum_words").alias("alnum_word_accuracy")]


@F.pandas_udf(StringType())
def common_subsequence(a: pd.Series, b: pd.Series) -> pd.Series:
    """One longest common subsequence of characters; of several that which takes b's later characters last."""
    return pd.Series([_subsequence(x or "", y or "") for x, y in zip(a, b, strict=True)])


def _subsequence(a: str, b: str) -> str:
    """In memory for two rows: a is halved where the lengths on both sides add up to the most."""
    if not a or not b:
        return ""
    if len(a) == 1:
        return a if a in b else ""
    half = len(a) // 2
    left, right = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])[::-1]
    cut = max(range(len(b) + 1), key=lambda j: left[j] + right[j])
    return _subsequence(a[:half], b[:cut]) + _subsequence(a[half:], b[cut:])


def _lengths(a: str, b: str) -> list[int]:
    """The length of the longest common subsequence of a with each beginning of b."""
    row = [0] * (len(b) + 1)
    for c in a:
        last, up = 0, 0
        for j, d in enumerate(b, 1):
            up, row[j] = row[j], last + 1 if c == d else max(row[j], row[j - 1])
            last = up
    return row
