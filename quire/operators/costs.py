"""A timer of nested stages and the cost model that its reports give: fixed and per-image parts, predictions, verdicts."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REPORT = "path string, calls bigint, inclusive double, exclusive double"


class Timer:
    """Inclusive and own seconds of nested stages; a stage's name is the path of those around it.

    Off, a stage costs a comparison. On, what the timer itself costs is known from a calibration.
    """

    def __init__(self, on: bool = True):
        self.on, self.per_call, self.stack, self.seen = on, 0.0, [], {}

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        if not self.on:
            yield
            return
        path = "/".join([p for p, _ in self.stack[-1:]] + [name])
        self.stack.append((path, 0.0))
        began = time.perf_counter()
        try:
            yield
        finally:
            spent = time.perf_counter() - began
            _, inner = self.stack.pop()
            calls, inclusive, exclusive = self.seen.get(path, (0, 0.0, 0.0))
            self.seen[path] = (calls + 1, inclusive + spent, exclusive + spent - inner)
            if self.stack:
                self.stack[-1] = (self.stack[-1][0], self.stack[-1][1] + spent)

    def calibrate(self, rounds: int = 2000) -> float:
        """Seconds that one stage costs by being timed."""
        probe = Timer()
        began = time.perf_counter()
        for _ in range(rounds):
            with probe.stage("x"):
                pass
        self.per_call = (time.perf_counter() - began) / rounds
        return self.per_call

    def reset(self) -> None:
        self.stack, self.seen = [], {}

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(p, *v) for p, v in sorted(self.seen.items())], REPORT)


def enabled(spark: SparkSession, key: str = "spark.quire.profile") -> Timer:
    """A timer that is on if the session's setting says so."""
    return Timer(spark.conf.get(key, "false").lower() in ("1", "true", "yes"))


def roots(report: DataFrame) -> DataFrame:
    """Stages that no other holds."""
    return report.where(~F.col("path").contains("/"))


def unattributed(report: DataFrame, wall: DataFrame, key: str = "process") -> DataFrame:
    """(key, wall, attributed, rest): wall clock (key, wall) that no stage accounts for."""
    own = roots(report).groupBy(key).agg(F.sum("inclusive").alias("attributed"))
    return wall.join(own, key, "left").select(key, "wall", F.round(F.coalesce("attributed", F.lit(0.0)), 6).alias("attributed"), F.round(F.greatest(F.col("wall") - F.coalesce("attributed", F.lit(0.0)), F.lit(0.0)), 6).alias("rest"))


def model(report: DataFrame, images: DataFrame, fixed: list[str]) -> DataFrame:
    """(backend, stage, kind, seconds): fixed stages cost by process, all others by image.

    report (backend, process, path, inclusive) of whole stages, images (backend, process, images).
    """
    top = roots(report).groupBy("backend", F.col("path").alias("stage")).agg(F.sum("inclusive").alias("s"), F.count_distinct("process").alias("processes"))
    size = images.groupBy("backend").agg(F.sum("images").alias("images"))
    is_fixed = F.col("stage").isin(*fixed)
    each = F.when(is_fixed, F.col("s") / F.col("processes")).otherwise(F.col("s") / F.greatest("images", F.lit(1)))
    return top.join(F.broadcast(size), "backend").select("backend", "stage", F.when(is_fixed, "process").otherwise("image").alias("kind"), F.round(each, 6).alias("seconds"))


def pooled(report: DataFrame, parent: str) -> DataFrame:
    """(name, calls, seconds, per_call) of the stages right below parent, over all processes; dearest call first."""
    below = report.where(F.col("path").startswith(f"{parent}/") & ~F.substr("path", F.lit(len(parent) + 2)).contains("/"))
    out = below.groupBy(F.substr("path", F.lit(len(parent) + 2)).alias("name")).agg(F.sum("calls").alias("calls"), F.round(F.sum("inclusive"), 6).alias("seconds"))
    return out.withColumn("per_call", F.round(F.col("seconds") / F.nullif("calls", F.lit(0)), 6)).orderBy(F.desc("per_call"), "name")


def predicted(costs: DataFrame, work: DataFrame) -> DataFrame:
    """(backend, seconds) of work (backend, images, processes); a backend without costs has null."""
    per = costs.groupBy("backend").agg(F.sum(F.when(F.col("kind") == "image", F.col("seconds")).otherwise(0.0)).alias("each"), F.sum(F.when(F.col("kind") == "process", F.col("seconds")).otherwise(0.0)).alias("fixed"))
    return work.join(per, "backend", "left").select("backend", "images", "processes", F.round(F.col("each") * F.col("images") + F.col("fixed") * F.col("processes"), 6).alias("seconds"))


def shape(plan: DataFrame) -> DataFrame:
    """(backend, processes, was, images) of a plan: processes by shard, and as many as runs there were before."""
    per = plan.groupBy("backend", "shard").agg(F.count("*").alias("runs"), F.sum("count").alias("images"))
    return per.groupBy("backend").agg(F.count("*").alias("processes"), F.sum("runs").alias("was"), F.sum("images").alias("images"))


def saved(costs: DataFrame, plan_shape: DataFrame) -> DataFrame:
    """(backend, images, now, before, saved): a plan's seconds with a process a shard, and a process a run."""
    now = predicted(costs, plan_shape.select("backend", "images", "processes")).select("backend", "images", F.col("seconds").alias("now"))
    before = predicted(costs, plan_shape.select("backend", "images", F.col("was").alias("processes"))).select("backend", F.col("seconds").alias("before"))
    return now.join(before, "backend").where("before > 0").withColumn("saved", F.round(1 - F.col("now") / F.col("before"), 6))


def error(measured: Column, expected: Column) -> Column:
    """How far a prediction is below what was measured, as a share of it; 0 where nothing was measured."""
    return F.when(measured == 0, 0.0).otherwise(F.round((measured - expected) / measured, 4))


def dearest(report: DataFrame, by: str, name: str, seconds: str) -> DataFrame:
    """(by, name, seconds, share): what costs most in each group, and its share of the group."""
    per = report.groupBy(by, name).agg(F.sum(seconds).alias("s"))
    out = per.groupBy(by).agg(F.max_by(name, F.struct("s", name)).alias(name), F.max("s").alias("m"), F.sum("s").alias("all"))
    return out.select(by, name, F.round("m", 6).alias("seconds"), F.round(F.col("m") / F.col("all"), 6).alias("share"))


def options_in_order(options: DataFrame, attr: str) -> DataFrame:
    return options.where(F.col("attr") == attr).select("id", F.row_number().over(Window.orderBy("opt_pos")).alias("place"))
