"""Alignment of clean and noisy text, label propagation and edit metrics.

Dynamic programming over characters is the one thing here that the JVM's functions can't express; it
runs in Arrow UDFs, on segments that anchors keep short. What follows from an alignment is columns.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: Scores of a global alignment, and the sign of a gap.
MATCH, MISMATCH, GAP, SPACE = 1.0, -0.5, -0.5, -0.1
GAP_CHAR = "@"
#: Segments of more characters are cut at anchors, where they have any.
SEGMENT = 100
#: Cells of the largest table of scores; larger ones are halved first.
CELLS = 4_000_000

_WORDS = re.compile(r"\S+")

ALIGNED = StructType([StructField("gt", StringType()), StructField("noise", StringType())])


def _last_row(gt: str, noise: str) -> np.ndarray:
    """The best scores of all of gt against each beginning of noise, in memory for two rows."""
    a, b, n = np.array(list(gt)), np.array(list(noise)), len(noise)
    steps = GAP * np.arange(n + 1)
    best = steps.copy()
    for i, c in enumerate(a, 1):
        score = np.where(b == c, MATCH, MISMATCH + SPACE * ((b == " ") | (c == " ")))
        row = np.empty(n + 1)
        row[0] = GAP * i
        row[1:] = np.maximum(best[:-1] + score, best[1:] + GAP)
        best = np.maximum.accumulate(row - steps) + steps
    return best


def _pair(gt: str, noise: str, gap: str) -> tuple[str, str]:
    """One best alignment: the diagonal where it ties, else a gap in noise. Where the table of scores would be larger
    than CELLS, gt is halved and noise is cut where the two halves' scores add up to the best."""
    if not gt or not noise:
        return gt or gap * len(noise), noise or gap * len(gt)
    m, n = len(gt), len(noise)
    if (m + 1) * (n + 1) > CELLS and m > 1:
        half = m // 2
        at = int(np.argmax(_last_row(gt[:half], noise) + _last_row(gt[half:][::-1], noise[::-1])[::-1]))
        left, right = _pair(gt[:half], noise[:at], gap), _pair(gt[half:], noise[at:], gap)
        return left[0] + right[0], left[1] + right[1]
    a, b = np.array(list(gt)), np.array(list(noise))
    score = np.where(a[:, None] == b[None, :], MATCH, MISMATCH + SPACE * ((a[:, None] == " ") | (b[None, :] == " ")))
    best = np.zeros((m + 1, n + 1))
    best[0], best[:, 0] = GAP * np.arange(n + 1), GAP * np.arange(m + 1)
    steps = GAP * np.arange(n + 1)
    for i in range(1, m + 1):
        row = np.empty(n + 1)
        row[0] = best[i, 0]
        row[1:] = np.maximum(best[i - 1, :-1] + score[i - 1], best[i - 1, 1:] + GAP)
        best[i] = np.maximum.accumulate(row - steps) + steps
    out_a, out_b, i, j = [], [], m, n
    while i or j:
        if i and j and abs(best[i, j] - best[i - 1, j - 1] - score[i - 1, j - 1]) < 1e-9:
            i, j = i - 1, j - 1
            out_a.append(gt[i])
            out_b.append(noise[j])
        elif i and abs(best[i, j] - best[i - 1, j] - GAP) < 1e-9:
            i -= 1
            out_a.append(gt[i])
            out_b.append(gap)
        else:
            j -= 1
            out_a.append(gap)
            out_b.append(noise[j])
    return "".join(reversed(out_a)), "".join(reversed(out_b))


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence of characters."""
    row = np.zeros(len(b) + 1, np.int64)
    codes = np.array(list(b))
    for c in a:
        new = row.copy()
        new[1:] = np.where(codes == c, row[:-1] + 1, row[1:])
        row = np.maximum.accumulate(new)
    return int(row[-1])


def anchors(gt: list[str], noise: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of words that occur once on both sides, as long an increasing chain of them as there is."""
    def once(t: list[str]) -> dict[str, int]:
        low = [w.lower() for w in t]
        n = Counter(low)
        return {w: i for i, (w, x) in enumerate(zip(t, low, strict=True)) if n[x] == 1}

    left, right = once(gt), once(noise)
    pairs = sorted((i, right[w]) for w, i in left.items() if w in right)
    tails: list[tuple[int, int]] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = int(np.searchsorted([t[0] for t in tails], j))
        back.append(tails[at - 1][1] if at else -1)
        tails[at : at + 1] = [(j, k)]
    chain, k = [], tails[-1][1] if tails else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def chain(gt: list[str], noise: list[str], size: int = SEGMENT) -> list[tuple[int, int]]:
    """anchors(), and those of each stretch between two of them that has more than size characters, and so on."""
    out, todo = [], [(0, len(gt), 0, len(noise))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        found = [(i0 + i, j0 + j) for i, j in anchors(gt[i0:i1], noise[j0:j1])]
        out += found
        ends = [*found, (i1, j1)]
        for (i, j), (p, q) in zip([(i0 - 1, j0 - 1), *found], ends, strict=True):
            longer = max(sum(map(len, gt[i + 1 : p])), sum(map(len, noise[j + 1 : q]))) > size
            if found and longer and i + 1 < p and j + 1 < q:
                todo.append((i + 1, p, j + 1, q))
    return sorted(out)


def align(gt: str, noise: str, gap: str = GAP_CHAR) -> tuple[str, str]:
    """Both texts at one length, gaps marked. Long texts are cut where an anchor begins; without the gaps, both sides
    are the texts that went in, blanks and all."""
    if max(len(gt), len(noise)) <= SEGMENT:
        return _pair(gt, noise, gap)
    a, b = list(_WORDS.finditer(gt)), list(_WORDS.finditer(noise))
    out_a, out_b, i0, j0 = [], [], 0, 0
    cuts = [(a[i].start(), b[j].start()) for i, j in chain([m[0] for m in a], [m[0] for m in b])]
    for i, j in [*cuts, (len(gt), len(noise))]:
        if (i, j) == (len(gt), len(noise)) or max(i - i0, j - j0) >= SEGMENT // 2 and i > i0 and j > j0:
            x, y = _pair(gt[i0:i], noise[j0:j], gap)
            out_a.append(x)
            out_b.append(y)
            i0, j0 = i, j
    return "".join(out_a), "".join(out_b)


@F.pandas_udf(ALIGNED)
def aligned(gt: pd.Series, noise: pd.Series) -> pd.DataFrame:
    """gt and noise aligned; nulls are empty."""
    return pd.DataFrame([align(a or "", b or "") for a, b in zip(gt, noise, strict=True)], columns=["gt", "noise"])


@F.pandas_udf(IntegerType())
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x or "", y or "") for x, y in zip(a, b, strict=True)])


def _spans(text: str, gap: str) -> list[tuple[int, int]]:
    out, begin = [], None
    for i, c in enumerate(text + " "):
        if c == " ":
            if begin is not None and text[begin:i].strip(gap):
                out.append((begin, i))
            begin = None
        elif begin is None:
            begin = i
    return out


def token_map(gt: str, noise: str, gap: str = GAP_CHAR) -> list[list[int]]:
    """For each token of the aligned gt the tokens of noise that share characters with it."""
    a, b = _spans(gt, gap), _spans(noise, gap)
    real = lambda lo, hi: any(x != gap and y != gap for x, y in zip(gt[lo:hi], noise[lo:hi], strict=True))
    return [[j for j, (p, q) in enumerate(b) if p < hi and lo < q and real(max(lo, p), min(hi, q))] for lo, hi in a]


def propagate(labels: list[str], gt: list[str], noise: list[str]) -> list[str]:
    """Labels of noisy tokens from their first clean one; those without any are O; orphans are corrected."""
    x, y = align(" ".join(gt), " ".join(noise))
    out = ["O"] * len(noise)
    for i, there in reversed(list(enumerate(token_map(x, y)))):
        for j in there:
            out[j] = labels[i]
    seen: str | None = None
    for j, (label, before) in enumerate(zip(out, [None, *out], strict=False)):
        if label.startswith("B-") and before == label and seen == label and labels.count(label) < out.count(label):
            out[j] = "I-" + label[2:]
        seen = label
    return corrected(out)


def corrected(labels: list[str]) -> list[str]:
    """I- without its B- before it becomes B-."""
    out, open_ = [], None
    for x in labels:
        if x.startswith("I-") and open_ != x[2:]:
            x = "B-" + x[2:]
        open_ = x[2:] if x[:2] in ("B-", "I-") else None
        out.append(x)
    return out


@F.pandas_udf(ArrayType(StringType()))
def propagated(labels: pd.Series, gt: pd.Series, noise: pd.Series) -> pd.Series:
    return pd.Series([propagate(list(a), list(b), list(c)) for a, b, c in zip(labels, gt, noise, strict=True)])


def corrected_labels(labels: Column) -> Column:
    """corrected() as a column."""

    def step(acc: Column, x: Column) -> Column:
        name = F.regexp_extract(x, "^[BI]-(.*)$", 1)
        fixed = F.when(x.startswith("I-") & (acc["open"] != name), F.concat(F.lit("B-"), name)).otherwise(x)
        return F.struct(F.concat(acc["out"], F.array(fixed)).alias("out"), name.alias("open"))

    return F.aggregate(labels, F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("open")), step, lambda acc: acc["out"])


def edit_counts(pair: Column, gap: str = GAP_CHAR) -> Column:
    """struct of matches, inserts, deletes, replaces and their spacing variants, from an aligned pair."""
    chars = F.arrays_zip(F.split(pair["gt"], "").alias("a"), F.split(pair["noise"], "").alias("b"))
    n = lambda test: F.size(F.filter(chars, lambda c: test(c["a"], c["b"])))
    return F.struct(
        n(lambda a, b: (a == b) & (a != gap)).alias("matches"),
        n(lambda a, b: (a == gap) & (b != gap) & (b != " ")).alias("inserts"),
        n(lambda a, b: (b == gap) & (a != gap) & (a != " ")).alias("deletes"),
        n(lambda a, b: (a != b) & (a != gap) & (b != gap) & (a != " ") & (b != " ")).alias("replaces"),
        n(lambda a, b: (a == gap) & (b == " ")).alias("space_inserts"),
        n(lambda a, b: (b == gap) & (a == " ")).alias("space_deletes"),
        n(lambda a, b: (a != b) & (a != gap) & (b != gap) & ((a == " ") | (b == " "))).alias("space_replaces"),
    )


def unique_words(tokens: Column) -> Column:
    """Words whose lower-case form occurs once, in order: sorted by that form, they have unlike neighbours."""
    placed = F.array_sort(F.transform(tokens, lambda t, i: F.struct(F.lower(t).alias("low"), i.alias("i"), t.alias("t"))))

    def lone(s: Column) -> Column:
        unlike = lambda x, j: ~F.get(s, j)["low"].eqNullSafe(x["low"])
        kept = F.filter(s, lambda x, i: unlike(x, i - 1) & unlike(x, i + 1))
        return F.transform(F.array_sort(F.transform(kept, lambda x: F.struct(x["i"], x["t"]))), lambda x: x["t"])

    return F.get(F.transform(F.array(placed), lone), 0)


def gap_runs(df: DataFrame, pair: str, gap: str = GAP_CHAR) -> DataFrame:
    """df with runs: array of struct(src, target, spacing, kind), one per longest stretch in which the pair differs.

    src and target are without gaps and blanks at their ends; kind is insert, delete, replace or, where nothing
    but blanks differ, spacing. spacing counts the blanks that meet a gap.
    """
    a, b = F.col("_a"), F.col("_b")
    off = lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i))  # noqa: E731 - beyond both ends nothing differs
    at = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
    out = df.withColumn("_a", F.split(f"{pair}.gt", "")).withColumn("_b", F.split(f"{pair}.noise", "")).withColumn("_at", at)
    out = out.withColumn("_from", F.filter("_at", lambda i: off(i) & ~off(i - 1))).withColumn("_to", F.filter("_at", lambda i: off(i) & ~off(i + 1)))
    part = lambda x, s, e: F.slice(x, s + 1, e - s + 1)
    bare = lambda x: F.btrim(F.array_join(x, ""), F.lit(gap + " "))
    blank = lambda x, y: ((x == gap) & (y == " ")) | ((x == " ") & (y == gap))

    def run(s: Column, e: Column) -> Column:
        spacing = F.size(F.filter(F.sequence(s, e), lambda i: blank(F.get(a, i), F.get(b, i))))
        return F.struct(bare(part(a, s, e)).alias("src"), bare(part(b, s, e)).alias("target"), spacing.alias("spacing"))

    kind = lambda r: F.when((r["src"] == "") & (r["target"] == ""), "spacing").when(r["src"] == "", "insert").when(r["target"] == "", "delete").otherwise("replace")
    out = out.withColumn("_runs", F.zip_with("_from", "_to", run))
    runs = F.transform("_runs", lambda r: F.struct(r["src"].alias("src"), r["target"].alias("target"), r["spacing"].alias("spacing"), kind(r).alias("kind")))
    return out.withColumn("runs", runs).drop("_a", "_b", "_at", "_from", "_to", "_runs")


def gap_stats(runs: DataFrame, key: str) -> DataFrame:
    """(key, insert, delete, replace, spacing): how many stretches of each kind, and the blanks in all of them."""
    n = lambda k: F.size(F.filter("runs", lambda r: r["kind"] == k)).alias(k)
    return runs.select(key, n("insert"), n("delete"), n("replace"), F.aggregate("runs", F.lit(0), lambda acc, r: acc + r["spacing"]).alias("spacing"))


def substitutions(runs: DataFrame) -> DataFrame:
    """(src, target, n) over all rows of runs: what was replaced by what, and how often."""
    return runs.select(F.explode("runs").alias("r")).where("r.kind = 'replace'").groupBy("r.src", "r.target").agg(F.count("*").alias("n"))
