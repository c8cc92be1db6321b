"""Drift of an observed mix, order-free recall, stage costs and other aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Below so many draws a mix isn't judged; distance above tolerance and noise is drift; a value is missed if so many were expected.
MIN_DRAWS, TOLERANCE, MIN_EXPECTED = 30, 0.15, 5.0


def shares(df: DataFrame, attribute: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., value, n, draws, share): how often each value of attribute occurs."""
    counts = df.groupBy(*by, F.col(attribute).alias("value")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("draws", total).withColumn("share", F.col("n") / total)


def against(df: DataFrame, shard: str, attribute: str) -> DataFrame:
    """(shard, value, n, draws, p): each shard's counts beside the overall share p of every value, zeros included.

    The values' table is as small as the attribute's domain, so the pairs are shards times values.
    """
    overall = shares(df, attribute).select("value", F.col("share").alias("p"))
    seen = shares(df, attribute, [shard]).select(shard, "value", "n")
    totals = df.groupBy(shard).agg(F.count("*").alias("draws"))
    pairs = totals.crossJoin(overall)
    return pairs.join(seen, [shard, "value"], "left").fillna(0, ["n"])


def drift(df: DataFrame, shard: str, attribute: str) -> DataFrame:
    """Per shard: draws, total variation distance, its sampling noise, whether it is judged and drifted.

    A value that a shard lacks adds its overall share to the distance, and those shares are what is left of 1; the
    noise is one sum over all values, divided by the root of the draws. So shards meet only the values they have.
    """
    overall = shares(df, attribute).select("value", F.col("share").alias("p"))
    p = F.col("p")
    scatter = overall.agg(F.sum(F.when((p > 0) & (p < 1), F.sqrt(2 * p * (1 - p) / F.pi())).otherwise(0.0)).alias("scatter"))
    seen = shares(df, attribute, [shard]).join(overall, "value")
    out = seen.groupBy(shard).agg(F.max("draws").alias("draws"), F.sum(F.abs(F.col("n") / F.col("draws") - p)).alias("gaps"), F.sum(p).alias("seen")).join(F.broadcast(scatter))
    out = out.withColumn("distance", F.round(0.5 * (F.col("gaps") + F.greatest(1 - F.col("seen"), F.lit(0.0))), 6)).withColumn("noise", F.round(0.5 * F.col("scatter") / F.sqrt("draws"), 6))
    judged = F.col("draws") >= MIN_DRAWS
    return out.select(shard, "draws", "distance", "noise", judged.alias("judged"), (judged & (F.col("distance") > TOLERANCE + F.col("noise"))).alias("drifted"))


def never_drawn(df: DataFrame, shard: str, attribute: str) -> DataFrame:
    """Values that a shard lacks though at least MIN_EXPECTED of them were expected."""
    expected = F.round(F.col("p") * F.col("draws"), 6)
    return against(df, shard, attribute).where("n = 0").select(shard, "value", expected.alias("expected")).where(F.col("expected") >= MIN_EXPECTED)


def top_gaps(df: DataFrame, shard: str, attribute: str, k: int = 3) -> DataFrame:
    gap = F.round(F.col("n") / F.col("draws") - F.col("p"), 6)
    ranked = against(df, shard, attribute).withColumn("gap", gap).withColumn("place", F.row_number().over(Window.partitionBy(shard).orderBy(F.abs(F.col("gap")).desc(), "value")))
    return ranked.where(F.col("place") <= k).select(shard, "value", "gap", "place")


def run_draws(df: DataFrame, run: str, backend: str, paired: bool) -> DataFrame:
    """Draws of a run: of paired backends the largest count, else the sum."""
    per = df.groupBy(run, backend).agg(F.count("*").alias("n"))
    return per.groupBy(run).agg((F.max("n") if paired else F.sum("n")).alias("draws"))


def multiset_recall(want: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """(key, wanted, found, recall): tokens of want (key, token) that have (key, token) holds, counted with repeats."""
    a = want.groupBy(key, "token").agg(F.count("*").alias("a"))
    b = have.groupBy(key, "token").agg(F.count("*").alias("b"))
    return a.join(b, [key, "token"], "left").groupBy(key).agg(F.sum("a").alias("wanted"), F.sum(F.least("a", F.coalesce("b", F.lit(0)))).alias("found")).withColumn("recall", F.round(F.col("found") / F.col("wanted"), 6))


def strata(df: DataFrame, value: str, keys: Sequence[str], both: tuple[str, str]) -> DataFrame:
    """Mean and count of value by each key alone and by one pair of them, in one aggregate over grouping sets."""
    sets = [[k] for k in keys] + [list(both)]
    cols = [F.col(k) for k in keys]
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(F.round(F.avg(value), 6).alias("mean"), F.count(value).alias("n"), F.grouping_id(*cols).cast("int").alias("grouping"))
    return out


def spread(df: DataFrame, inside: str, by: str, value: str) -> DataFrame:
    """By how much the mean of value differs between the levels of by, inside each group that has two at least."""
    means = df.groupBy(inside, by).agg(F.avg(value).alias("m"))
    out = means.groupBy(inside).agg(F.round(F.max("m") - F.min("m"), 6).alias("spread"), F.max_by(by, F.struct("m", by)).alias("highest"), F.count("*").alias("levels"))
    return out.where("levels > 1")


def stage_cost(df: DataFrame, process: str, stage: str, seconds: str) -> DataFrame:
    """(process, stage, calls, seconds, per_call, share)."""
    out = df.groupBy(process, stage).agg(F.count("*").alias("calls"), F.round(F.sum(seconds), 6).alias("seconds"))
    share = F.round(F.col("seconds") / F.sum("seconds").over(Window.partitionBy(process)), 6)
    return out.withColumn("per_call", F.round(F.col("seconds") / F.col("calls"), 6)).withColumn("share", share)


def exclusive(df: DataFrame) -> DataFrame:
    """Own seconds of stages (process, path, seconds): inclusive, less those of the stages right below."""
    up = F.regexp_replace("path", "/?[^/]+$", "")
    below = df.select("process", up.alias("path"), "seconds").where("path <> ''").groupBy("process", "path").agg(F.sum("seconds").alias("inner_seconds"))
    return df.join(below, ["process", "path"], "left").withColumn("own", F.round(F.col("seconds") - F.coalesce("inner_seconds", F.lit(0.0)), 6)).drop("inner_seconds")


def merged_costs(df: DataFrame) -> DataFrame:
    """Reports (stage, calls, seconds) of several processes as one."""
    return df.groupBy("stage").agg(F.sum("calls").alias("calls"), F.round(F.sum("seconds"), 6).alias("seconds"), F.round(F.sum("seconds") / F.sum("calls"), 6).alias("per_call"))


def predicted(model: DataFrame, work: DataFrame, fixed: float = 0.0) -> DataFrame:
    """Seconds of work (job, stage, n) by a model (stage, per_call), plus a fixed part per job."""
    return work.join(model, "stage").groupBy("job").agg(F.round(F.sum(F.col("n") * F.col("per_call")) + fixed, 6).alias("seconds"))


def percent_table(df: DataFrame, row: str, column: str, values: Sequence[str], seconds: str) -> DataFrame:
    """Shares of each column's seconds by row, pivoted."""
    out = df.groupBy(row).pivot(column, list(values)).agg(F.sum(seconds))
    every = Window.partitionBy()
    return out.select(row, *[F.round(100 * F.coalesce(v, F.lit(0.0)) / F.sum(v).over(every), 4).alias(v) for v in values])


def restarts(df: DataFrame, key: str, order: Sequence[str], count: str) -> DataFrame:
    """Rows at which a count that can only grow is below the one before."""
    before = F.lag(count).over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("before", before).where(F.col(count) < F.col("before"))


def ordered_distinct(df: DataFrame, value: str, order: Column) -> DataFrame:
    """Each value once, at its first place."""
    return df.groupBy(value).agg(F.min(order).alias("first"))


def sum_in_order(table: DataFrame, value: Column) -> Column:
    """The sum of a group's doubles, added in the order of table's rows in its files, as an aggregate; null without any.

    Sums of doubles depend on the order, and a shuffle's order changes: where a sum is printed, rounded at a half, so does
    the print. table is read from files; a group's values are gathered in one row.
    """
    file = F.lit(0) if len(table.inputFiles()) == 1 else F.col("_metadata.file_path")
    one = F.struct(file.alias("file"), F.col("_metadata.row_index").alias("row"), value.alias("value"))
    rows = F.sort_array(F.collect_list(F.when(value.isNotNull(), one)))
    return F.aggregate(rows, F.lit(None).cast("double"), lambda acc, x: F.coalesce(acc, F.lit(0.0)) + x["value"])
