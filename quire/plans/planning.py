"""Deterministic plans: quotas, seed ranges, shards and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seeds between the layouts of a backend, and between backends that don't share content.
LAYOUT_STRIDE, BACKEND_STRIDE = 1000, 100000
#: Rows of a table that is broadcast.
SMALL = 10_000


def quotas(layouts: DataFrame, count: int, order: str) -> DataFrame:
    """layouts with pos and quota: count shared evenly, the remainder to the first."""
    n = F.count("*").over(Window.partitionBy())
    out = layouts.withColumn("pos", F.row_number().over(Window.orderBy(order)) - 1)
    return out.withColumn("quota", F.floor(F.lit(count) / n) + F.when(F.col("pos") < F.lit(count) % n, 1).otherwise(0))


def runs(quota: DataFrame, backend: str, seed: int, paired: bool) -> DataFrame:
    """(backend, layout, seed, count, first_index): quota (backend_pos, backend, pos, layout, quota) as ranges of seeds."""
    offset = F.lit(0) if paired else F.col("backend_pos") * BACKEND_STRIDE
    some = quota.where("quota > 0")
    by = Window.partitionBy(backend).orderBy("pos")
    slot = F.row_number().over(by) - 1
    first = F.coalesce(F.sum("quota").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return some.select(backend, "layout", (F.lit(seed) + offset + slot * LAYOUT_STRIDE).cast("long").alias("seed"), F.col("quota").cast("long").alias("count"), first.cast("long").alias("first_index"))


def pages(jobs: DataFrame, order: str) -> DataFrame:
    """One row per page of jobs (count, seed): its index over all jobs, and its seed."""
    first = F.coalesce(F.sum("count").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return jobs.withColumn("first", first).where("count > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("k")).withColumn("index", F.col("first") + F.col("k")).withColumn("page_seed", F.col("seed") + F.col("k"))


def shards(runs_: DataFrame, backend: str, size: int) -> DataFrame:
    """Runs cut at multiples of size: (backend, shard, layout, seed, count)."""
    cut = runs_.select("*", F.explode(F.sequence(F.floor(F.col("first_index") / size), F.floor((F.col("first_index") + F.col("count") - 1) / size))).alias("shard"))
    lo = F.greatest("first_index", F.col("shard") * size)
    hi = F.least(F.col("first_index") + F.col("count"), (F.col("shard") + 1) * size)
    return cut.select(backend, "shard", "layout", (F.col("seed") + lo - F.col("first_index")).cast("long").alias("seed"), (hi - lo).cast("long").alias("count"))


def unpaired(plan: DataFrame, left: str, right: str, backend: str, keys: list[str]) -> DataFrame:
    """Rows of keys that one of two backends has and the other lacks."""
    a = plan.where(F.col(backend) == left).select(*keys, F.lit(True).alias("in_left"))
    b = plan.where(F.col(backend) == right).select(*keys, F.lit(True).alias("in_right"))
    return a.join(b, keys, "full_outer").where("in_left is null or in_right is null").select(*keys, F.when(F.col("in_left"), left).otherwise(right).alias("only_in"))


def batched(df: DataFrame, by: str, order: str, size: int) -> DataFrame:
    """df with the number of the batch of size rows that a row falls in, inside each group."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1) / size))


def image_name(backend: Column, index: Column) -> Column:
    return F.format_string("%s_%03d.jpg", backend, index)


def product(*parts: DataFrame) -> DataFrame:
    """Every combination of small tables of styles."""
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p) if p.limit(SMALL + 1).count() <= SMALL else p)
    return out
