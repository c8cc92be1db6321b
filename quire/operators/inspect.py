"""Whether what a label says is printed: leaves against boxes, frames, glyphs, totals; tallies and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a font without a glyph prints.
MISSING = ("�", "□")
#: Fields that few layouts may leave out, and the share of a layout's labels that may go unprinted.
MIN_COUNT = 5
EPSILON = 0.5


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def page_text(boxes: DataFrame, key: str) -> DataFrame:
    """(key, page, kinds): a page's box texts joined by blanks in order, whole and by kind (array of texts).

    boxes: key, pos, kind, text.
    """
    joined = lambda xs: F.array_join(F.transform(F.array_sort(xs), lambda x: x["t"]), " ")
    item = F.collect_list(F.struct("pos", squeezed(F.coalesce("text", F.lit(""))).alias("t")))
    per = boxes.groupBy(key, "kind").agg(joined(item).alias("s"))
    kinds = per.groupBy(key).agg(F.array_sort(F.collect_list("s")).alias("kinds"))
    return boxes.groupBy(key).agg(joined(item).alias("page")).join(kinds, key)


def unprinted(leaves: DataFrame, pages: DataFrame, key: str, budgeted: list[str]) -> DataFrame:
    """(key, field, value, budgeted): label values that stand on no box; totals count as one field. Blank values are printed.

    leaves (key, path, leaf), pages as page_text() gives them.
    """
    field = F.when(F.col("path").startswith("total."), "total").otherwise(F.col("path"))
    rows = leaves.where(F.trim(F.coalesce("leaf", F.lit(""))) != "").select(key, field.alias("field"), squeezed(F.col("leaf")).alias("value"))
    on_page = F.coalesce(F.col("page").contains(F.col("value")), F.lit(False)) | F.coalesce(F.exists("kinds", lambda k: k.contains(F.col("value"))), F.lit(False))
    return rows.join(pages, key, "left").where(~on_page).select(key, "field", "value", F.col("field").isin(*budgeted).alias("budgeted"))


def bad_glyphs(rows: DataFrame, text: str) -> DataFrame:
    """Rows whose text is blank or carries a missing glyph, and which of the two."""
    odd = F.coalesce(F.col(text).rlike("[" + "".join(MISSING) + "]"), F.lit(False))
    fault = F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "blank").when(odd, "glyph")
    return rows.withColumn("fault", fault).where("fault is not null")


def outside(boxes: DataFrame, width: str, height: str, slack: float = 1.0) -> DataFrame:
    """Boxes (x0, y0, x1, y1) that reach out of their frame by more than slack."""
    c = F.col
    return boxes.where((c("x0") < -slack) | (c("y0") < -slack) | (c("x1") > c(width) + slack) | (c("y1") > c(height) + slack))


def totals_off(totals: DataFrame, line_sums: DataFrame, key: str) -> DataFrame:
    """(key, check, off): subtotals that aren't the sum of the lines, and change that isn't what was paid less the total.

    totals: key, subtotal, grand, paid, change (any may be null); line_sums: key, line_sum.
    """
    rows = totals.join(line_sums, key, "left")
    checks = F.array(F.struct(F.lit("subtotal").alias("check"), F.round(F.col("line_sum") - F.col("subtotal"), 2).alias("off")), F.struct(F.lit("change").alias("check"), F.round(F.col("paid") - F.col("grand") - F.col("change"), 2).alias("off")))
    return rows.select(key, F.explode(checks).alias("c")).select(key, "c.*").where(F.abs("off") > EPSILON)


def doubled_labels(boxes: DataFrame, key: str) -> DataFrame:
    """(key, label, n): total labels that a page prints twice, so that a mapping by label loses an amount."""
    own = boxes.where(F.col("kind").startswith("total.") & F.col("kind").endswith(".label"))
    return own.groupBy(key, F.col("text").alias("label")).agg(F.count("*").alias("n")).where("n > 1")


def tally(leaves: DataFrame, lost: DataFrame, key: str, layout: DataFrame) -> DataFrame:
    """(layout, field, occurrences, unprinted): how often a layout's labels have each field, and how often it isn't printed.

    layout: (key, layout). Both sides are counted before they meet.
    """
    field = F.when(F.col("path").startswith("total."), "total").otherwise(F.col("path")).alias("field")
    have = leaves.where(F.trim(F.coalesce("leaf", F.lit(""))) != "").join(layout, key).groupBy("layout", field).agg(F.count("*").alias("occurrences"))
    gone = lost.join(layout, key).groupBy("layout", "field").agg(F.count("*").alias("unprinted"))
    return have.join(gone, ["layout", "field"], "left").fillna(0, ["unprinted"])


def over_budget(tallies: DataFrame, budgets: dict[str, float], suppressed: dict[str, list[str]] | None = None) -> DataFrame:
    """Tallies whose unprinted share is over the field's budget, but for fields that a layout is known to suppress."""
    budget = F.try_element_at(F.create_map(*[x for f, b in budgets.items() for x in (F.lit(f), F.lit(b))]), F.col("field"))
    known = F.lit(False)
    for name, fields in (suppressed or {}).items():
        known = known | ((F.col("layout") == name) & F.col("field").isin(*fields))
    share = F.round(F.col("unprinted") / F.col("occurrences"), 6)
    return tallies.withColumn("share", share).withColumn("budget", budget).where(~known & (F.col("unprinted") >= MIN_COUNT) & (F.col("share") > F.col("budget")))


def missing_attributes(recipes: DataFrame, key: str, names: list[str]) -> DataFrame:
    """(key, attribute): attributes that a recipe (map attributes) lacks."""
    lacking = F.array_except(F.array(*map(F.lit, names)), F.map_keys("attributes"))
    return recipes.select(key, F.explode(lacking).alias("attribute"))


def chain_steps(chains: DataFrame, key: str, chain: str) -> DataFrame:
    """(key, pos, step, known) of chains given as JSON lists of names, of [name, parameters] or of {name: parameters}."""
    each = chains.select(key, F.posexplode(F.from_json(chain, "array<string>")).alias("pos", "x"))
    name = F.when(F.col("x").startswith("["), F.get_json_object("x", "$[0]")).when(F.col("x").startswith("{"), F.get(F.json_object_keys("x"), 0)).otherwise(F.col("x"))
    return each.select(key, "pos", name.alias("step"))


def printable(texts: DataFrame, text: str) -> DataFrame:
    """(char, n): the characters that texts print, and how many texts have each; white space is left out."""
    chars = F.array_distinct(F.split(F.regexp_replace(F.col(text), r"\s+", ""), ""))
    return texts.select(F.explode(chars).alias("char")).where("char <> ''").groupBy("char").agg(F.count("*").alias("n"))


def uncovered(chars: DataFrame, coverage: DataFrame) -> DataFrame:
    """(font, char, n): characters (char, n) that a font's ranges (font, low, high of code points) don't cover."""
    code = F.ascii("char")
    fonts = coverage.groupBy("font").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    rows = chars.withColumn("code", code).join(F.broadcast(fonts))
    return rows.where(~F.exists("ranges", lambda r: (r["low"] <= F.col("code")) & (F.col("code") <= r["high"]))).select("font", "char", "n")


def overflowing(rows: DataFrame, key: str, size: str, limit: str) -> DataFrame:
    """(key, used, limit, over): sheets whose rows are taller together than the sheet."""
    out = rows.groupBy(key).agg(F.sum(size).alias("used"), F.max(limit).alias("limit"))
    return out.withColumn("over", F.round(F.col("used") - F.col("limit"), 6)).where("over > 0")


def top_values(rows: DataFrame, by: str, value: str, k: int) -> DataFrame:
    place = F.dense_rank().over(Window.partitionBy(by).orderBy(F.desc("n"), value))
    return rows.groupBy(by, value).agg(F.count("*").alias("n")).withColumn("place", place).where(F.col("place") <= k)
