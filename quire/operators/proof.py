"""Scores of read-back text against what was printed: fields, tokens, amounts; and when two reports compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ascii_fold, tokens
from .layout import let

#: A field is read if this share of its tokens is there.
HIT = 0.7
MONEY = r"^[\d.,]+\s*(đ|₫|VND|VNĐ)?$"
GROUND_TRUTH = "gt_parse struct<store:map<string,string>,title:string,menu:array<struct<nm:string,price:string>>,total:map<string,string>>"


def fields(truth: Column) -> Column:
    """array of struct(role, expected) of a parsed ground truth (GROUND_TRUTH): store values, title, each entry's name
    and price, and totals; blank ones go."""
    pairs = lambda m, prefix: F.transform(F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("role"), e["value"].alias("expected")))
    menu = F.coalesce(truth["menu"], F.array().cast("array<struct<nm:string,price:string>>"))
    one = lambda role, v: F.struct(F.lit(role).alias("role"), v.alias("expected"))
    found = F.concat(pairs(truth["store"], "store."), F.array(one("title", truth["title"])), F.flatten(F.transform(menu, lambda e: F.array(one("menu.nm", e["nm"]), one("menu.price", e["price"])))), pairs(truth["total"], "total."))
    return F.filter(found, lambda x: F.trim(F.coalesce(x["expected"], F.lit(""))) != "")


def score(words: Column, bag: Column) -> Column:
    """The share of a field's tokens that the bag holds, each counted as often as the field has it; 1 without tokens."""
    return F.when(F.size(words) == 0, 1.0).otherwise(F.size(F.filter(words, lambda w: F.array_contains(bag, w))) / F.size(words))


def scored(records: DataFrame, key: str, field: str, text: str, folded: bool = False) -> DataFrame:
    """(key, role, expected, score) of records (key, array of struct(role, expected), read text)."""
    read = F.lower(ascii_fold(text)) if folded else F.col(text)
    bag = records.select(key, F.array_distinct(tokens(read)).alias("bag"), F.explode(field).alias("f")).select(key, "bag", "f.*")
    own = ascii_fold("expected") if folded else F.col("expected")
    both = F.struct(tokens(own).alias("words"), F.col("bag"))  # named once: inside score() the planner would make the bag again for each word
    return bag.select(key, "role", "expected", let(both, lambda x: F.round(score(x["words"], x["bag"]), 6)).alias("score"))


def hit_rates(scores: DataFrame, key: str, least: float = HIT) -> DataFrame:
    """(key, fields, hits, field_hit_rate)."""
    out = scores.groupBy(key).agg(F.count("*").alias("fields"), F.count_if(F.col("score") >= least).alias("hits"))
    return out.withColumn("field_hit_rate", F.round(F.col("hits") / F.col("fields"), 6))


def worst(scores: DataFrame, key: str, k: int = 3) -> DataFrame:
    """The k fields of each record that were read worst; ties by role and text."""
    place = F.row_number().over(Window.partitionBy(key).orderBy("score", "role", "expected"))
    return scores.withColumn("place", place).where(F.col("place") <= k)


def money_read(records: DataFrame, key: str, field: str, text: str) -> DataFrame:
    """(key, money_total, money_exact): distinct amounts among the fields, and those that the text holds as they are."""
    amounts = F.array_distinct(F.transform(F.filter(field, lambda f: F.trim(f["expected"]).rlike(MONEY)), lambda f: F.lower(F.trim(f["expected"]))))
    out = records.select(key, amounts.alias("a"), tokens(F.col(text)).alias("bag"))
    return out.select(key, F.size("a").alias("money_total"), F.size(F.array_intersect("a", "bag")).alias("money_exact"))


def conditions(images: DataFrame, report: str, layout: str, settings: list[str]) -> DataFrame:
    """(report, layouts, images_per_layout, settings...): what a report's score is a score of."""
    per = images.groupBy(report, layout).agg(F.count("*").alias("n"), *[F.max(s).alias(s) for s in settings])
    return per.groupBy(report).agg(F.array_sort(F.collect_list(layout)).alias("layouts"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(layout, "n")))).alias("images_per_layout"), *[F.max(s).alias(s) for s in settings])


def refusals(left: Column, right: Column, settings: list[str]) -> Column:
    """Why two reports' pooled scores can't be compared: layouts that one lacks, and settings that differ."""
    lists = F.array(
        F.when(left["layouts"] != right["layouts"], F.concat(F.lit("layouts +"), F.array_join(F.array_except(right["layouts"], left["layouts"]), ","), F.lit(" -"), F.array_join(F.array_except(left["layouts"], right["layouts"]), ","))),
        *[F.when(~left[s].eqNullSafe(right[s]), F.concat(F.lit(f"{s} "), F.coalesce(left[s].cast("string"), F.lit("?")), F.lit(" vs "), F.coalesce(right[s].cast("string"), F.lit("?")))) for s in settings],
    )
    return F.filter(lists, lambda x: x.isNotNull())


def drops(before: DataFrame, after: DataFrame, layout: str, value: str) -> DataFrame:
    """(layout, before, after, drop, only): by layout, what was lost; layouts that one side lacks say which has them."""
    a, b = before.select(layout, F.col(value).alias("before")), after.select(layout, F.col(value).alias("after"))
    only = F.when(F.col("before").isNull(), "after").when(F.col("after").isNull(), "before")
    return a.join(b, layout, "full_outer").select(layout, "before", "after", F.round(F.col("before") - F.col("after"), 4).alias("drop"), only.alias("only"))


def markdown(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(pos, line): a small table of results as Markdown, in the order of its columns."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    body = rows.select(F.row_number().over(Window.orderBy(*columns)).alias("pos"), F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |")).alias("line"))
    head = rows.sparkSession.createDataFrame([(-1, f"| {' | '.join(columns)} |"), (0, f"| {' | '.join(['---'] * len(columns))} |")], "pos int, line string")
    return head.unionByName(body)
