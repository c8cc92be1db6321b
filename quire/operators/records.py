"""Checks of records, references and geometry; fingerprints and diffs of datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def problems(checks: dict[str, Column]) -> Column:
    """The names of the checks that fail, in order; a check is true where the record is bad. Null counts as good."""
    return F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]), lambda x: x.isNotNull())


def line_arithmetic(lines: DataFrame, quantity: Column, unit: Column, price: Column, tolerance: float = 0.5) -> DataFrame:
    """Lines whose quantity times unit price isn't their price."""
    return lines.withColumn("off", F.round(quantity * unit - price, 6)).where(F.abs("off") > tolerance)


def totals(heads: DataFrame, lines: DataFrame, key: str, total: str, amount: str, tolerance: float) -> DataFrame:
    """Heads whose total isn't the sum of their lines' amounts; heads without lines have the sum 0."""
    sums = lines.groupBy(key).agg(F.sum(amount).alias("line_sum"))
    return heads.join(sums, key, "left").withColumn("off", F.round(F.col(total) - F.coalesce("line_sum", F.lit(0.0)), 2)).where(F.abs("off") > tolerance)


def dangling(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, kind: str) -> DataFrame:
    """(kind, id): keys of child that parent lacks."""
    return child.select(F.col(child_key).alias("id")).distinct().join(parent.select(F.col(parent_key).alias("id")), "id", "left_anti").select(F.lit(kind).alias("kind"), "id")


def two_way(a: DataFrame, b: DataFrame, a_key: str, b_key: str, names: tuple[str, str]) -> DataFrame:
    return dangling(a, b, a_key, b_key, names[0]).unionByName(dangling(b, a, b_key, a_key, names[1]))


def unprinted(rows: DataFrame, group: str, fields: Sequence[str], budget: float, least: int = 5) -> DataFrame:
    """(group, field, n, missing, share): fields that too large a share of a group's rows lacks. fields: boolean columns, true where printed."""
    long = rows.select(group, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("there")) for f in fields])).alias("x")).select(group, "x.*")
    out = long.groupBy(group, "field").agg(F.count("*").alias("n"), F.count_if(~F.col("there")).alias("missing"))
    return out.withColumn("share", F.round(F.col("missing") / F.col("n"), 6)).where((F.col("n") >= least) & (F.col("share") > budget))


def json_leaves(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, leaf): the scalars of JSON values at any depth; lists don't lengthen the path.

    One step opens one level of all rows, and there are as many steps as the deepest row has levels. Text that
    isn't JSON is one null leaf, and so are empty objects and lists.
    """
    level = df.select(F.col(key).alias("_key"), F.lit("").alias("_path"), F.try_parse_json(column).alias("_v"))
    out = None
    while True:
        kind = F.coalesce(F.schema_of_variant("_v"), F.lit("VOID"))
        inner = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        leaf = level.where(~inner).select("_key", "_path", F.col("_v").cast("string").alias("leaf"))
        out = leaf if out is None else out.unionByName(leaf)
        nested = level.where(inner)
        if not nested.limit(1).count():
            return out.select(F.col("_key").alias(key), F.col("_path").alias("path"), "leaf")
        opened = nested.lateralJoin(nested.sparkSession.tvf.variant_explode(F.col("_v").outer()))
        level = opened.select("_key", F.concat_ws(".", F.nullif("_path", F.lit("")), "key").alias("_path"), F.col("value").alias("_v"))


def overlaps(boxes: DataFrame, page: str, number: str, threshold: float = 0.3) -> DataFrame:
    """(page, i, j, share): pairs of a page's boxes (x0, y0, x1, y1) whose overlap is more than threshold of the smaller.

    A self-join inside pages: pages are small, and the rectangle tests are part of the join's condition.
    """
    a, b = boxes.alias("a"), boxes.alias("b")
    c = lambda side, n: F.col(f"{side}.{n}")
    on = (c("a", page) == c("b", page)) & (c("a", number) < c("b", number)) & (c("a", "x0") < c("b", "x1")) & (c("b", "x0") < c("a", "x1")) & (c("a", "y0") < c("b", "y1")) & (c("b", "y0") < c("a", "y1"))
    common = (F.least(c("a", "x1"), c("b", "x1")) - F.greatest(c("a", "x0"), c("b", "x0"))) * (F.least(c("a", "y1"), c("b", "y1")) - F.greatest(c("a", "y0"), c("b", "y0")))
    area = lambda s: (c(s, "x1") - c(s, "x0")) * (c(s, "y1") - c(s, "y0"))
    share = F.round(common / F.least(area("a"), area("b")), 6)
    return a.join(b, on).select(c("a", page).alias(page), c("a", number).alias("i"), c("b", number).alias("j"), share.alias("share")).where(F.col("share") > threshold)


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of a row's columns as JSON with sorted keys, nulls left out."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def diff(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, change): rows that were added, are missing or differ."""
    a = before.select(key, row_hash(columns).alias("a"))
    b = after.select(key, row_hash(columns).alias("b"))
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "differs")
    return a.join(b, key, "full_outer").select(key, change.alias("change")).where("change is not null")


def digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One order-free hash of all rows, from two sums over row hashes, so no row order and no single task is needed."""
    h = F.conv(F.substring(row_hash(columns), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(h).cast("string").alias("digest"))


def adjacent_overlaps(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ranges [lo, hi) that reach into the next one of their group, in order of their start."""
    w = Window.partitionBy(*by).orderBy("lo", "hi")
    return ranges.withColumn("next_lo", F.lead("lo").over(w)).where("next_lo < hi")
