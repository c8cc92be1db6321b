"""Fingerprints of inputs and outputs, and whether a difference is a plan that moved or a regression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lines(options: DataFrame, layouts: list[str]) -> DataFrame:
    """(attr, id, line): options as canonical JSON, only the given layouts among the layout options."""
    kept = options.where((F.col("attr") != "layout") | F.col("id").isin(*layouts))
    names = sorted(c for c in options.columns if c not in ("attr_pos", "opt_pos"))
    ordered = [F.array_sort(c).alias(c) if c in ("tags", "requires", "excludes") else F.col(c) for c in names]
    return kept.select("attr", "id", F.to_json(F.struct(*ordered)).alias("line"))


def family(rows: DataFrame, name: str, key: list[str], value: str) -> DataFrame:
    """(family, n, digest) of rows (key..., value): the SHA-256 of the rows' own SHA-256s in key order.

    Each row is hashed where it lies; only the 64-digit hashes are put in order, so a family of inputs (rule
    options, layouts, word lists) may have millions of rows.
    """
    each = rows.select(F.struct(*key).alias("k"), F.sha2(F.concat_ws("\x00", *[F.col(c).cast("string") for c in key], value), 256).alias("h"))
    out = each.agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "h"))), lambda x: x["h"]), "").alias("all"))
    return out.select(F.lit(name).alias("family"), "n", F.sha2("all", 256).alias("digest"))


def file_digests(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, sha): the SHA-256 of each file's bytes."""
    return files.select(path, F.sha2(F.col(content).cast("binary"), 256).alias("sha"))


def normal_line(columns: list[str]) -> Column:
    """A record as JSON with sorted keys."""
    return F.to_json(F.struct(*sorted(columns)))


def record_lines(records: DataFrame, backend: str, order: str, columns: list[str]) -> DataFrame:
    """(backend, pos, sha): each record's hash and its place among its backend's, from 0."""
    pos = F.row_number().over(Window.partitionBy(backend).orderBy(order)) - 1
    return records.select(F.col(backend).alias("backend"), pos.alias("pos"), F.sha2(normal_line(columns), 256).alias("sha"))


def counted(records: DataFrame, backend: str, layout: str) -> DataFrame:
    """(kind, name, n): records by backend and by layout, in one aggregate."""
    out = records.groupingSets([[F.col(backend)], [F.col(layout)]], F.col(backend), F.col(layout)).agg(F.count("*").alias("n"), F.grouping(F.col(backend)).alias("g"))
    return out.select(F.when(F.col("g") == 0, "backend").otherwise("layout").alias("kind"), F.when(F.col("g") == 0, F.col(backend)).otherwise(F.col(layout)).alias("name"), "n")


def input_changes(want: DataFrame, have: DataFrame) -> DataFrame:
    """(plan, field, was, now): conditions of plans (plan, field, value) that moved; a plan that one side lacks is one change."""
    both = want.select("plan", "field", F.col("value").alias("was")).join(have.select("plan", "field", F.col("value").alias("now")), ["plan", "field"], "full_outer")
    by = Window.partitionBy("plan")
    sided = both.withColumn("wanted", F.max(F.col("was").isNotNull().cast("int")).over(by)).withColumn("had", F.max(F.col("now").isNotNull().cast("int")).over(by))
    whole = sided.where("wanted = 0 or had = 0").groupBy("plan").agg(F.max("wanted").alias("wanted")).select("plan", F.lit("plan").alias("field"), F.when(F.col("wanted") == 1, "there").alias("was"), F.when(F.col("wanted") == 0, "there").alias("now"))
    moved = sided.where((F.col("wanted") == 1) & (F.col("had") == 1) & ~F.col("was").eqNullSafe(F.col("now"))).select("plan", "field", "was", "now")
    return whole.unionByName(moved)


def output_changes(want: DataFrame, have: DataFrame) -> DataFrame:
    """(plan, kind, name, change): files, record lines and counts (plan, kind, name, sha) that are new, missing or differ."""
    a, b = (d.select("plan", "kind", "name", F.col("sha").alias(n)) for d, n in ((want, "was"), (have, "now")))
    change = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "missing").when(F.col("was") != F.col("now"), "differs")
    return a.join(b, ["plan", "kind", "name"], "full_outer").select("plan", "kind", "name", change.alias("change")).where("change is not null")


def first_lines(changes: DataFrame, k: int = 8) -> DataFrame:
    """(plan, kind, n, first): how much differs of each kind, and the k smallest names of it."""
    place = F.row_number().over(Window.partitionBy("plan", "kind").orderBy("name"))
    return changes.withColumn("place", place).groupBy("plan", "kind").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("place") <= k, F.col("name")))).alias("first"))


def verdicts(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """(plan, verdict, n): plans whose conditions moved, whatever they put out; of the others, those whose output did."""
    moved = inputs.groupBy("plan").agg(F.count("*").alias("n")).select("plan", F.lit("moved").alias("verdict"), "n")
    regressed = outputs.join(moved, "plan", "left_anti").groupBy("plan").agg(F.count("*").alias("n")).select("plan", F.lit("regressed").alias("verdict"), "n")
    return moved.unionByName(regressed)


def arguments(plans: DataFrame) -> DataFrame:
    """(plan, argv) of plans (plan, per_backend, seed, layouts)."""
    head = F.array(F.lit("-n"), F.col("per_backend").cast("string"), F.lit("--seed"), F.col("seed").cast("string"), F.lit("--layouts"))
    return plans.select("plan", F.concat(head, F.col("layouts").cast("array<string>")).alias("argv"))
