"""Shard vectors, what a plan expects of them, and the verdicts between the two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_diacritics
from . import sampling
from .stats import MIN_DRAWS, MIN_EXPECTED, TOLERANCE

#: Draws per run of an expectation, its first seed and the seeds between runs. Shares are compared to six digits.
DRAWS, SEED, STRIDE = 400, 20260101, 1_000_000
#: More than this share of substituted content stops a run.
FALLBACK = 0.05


def vectors(records: DataFrame, text: str, pixels: str | None = None) -> DataFrame:
    """Per shard (backend, shard): images, mean text length, share of texts with diacritics, mean pixels, collapsed totals.

    records: backend, shard, the text, and collapsed (a count of label defects). One partial aggregate per map task.
    """
    size = F.avg(pixels).alias("p") if pixels else F.lit(0.0).alias("p")
    out = records.groupBy("backend", "shard").agg(F.count("*").alias("images"), F.avg(F.length(F.coalesce(text, F.lit("")))).alias("t"), F.avg(has_diacritics(F.col(text)).cast("double")).alias("d"), size, F.sum("collapsed").alias("collapsed_totals"))
    return out.select("backend", "shard", "images", F.round("t", 6).alias("text_length_mean"), F.round("d", 6).alias("diacritic_share"), F.round("p", 6).alias("image_pixels_mean"), "collapsed_totals", F.round(F.col("collapsed_totals") / F.col("images"), 6).alias("collapsed_total_share"))


def counts(records: DataFrame, attributes: list[str]) -> DataFrame:
    """(backend, shard, attribute, value, n): how often each value of each attribute was drawn, from one pass."""
    long = records.select("backend", "shard", F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])).alias("x"))
    return long.select("backend", "shard", "x.*").groupBy("backend", "shard", "attribute", "value").agg(F.count("*").alias("n"))


def forced(plan: DataFrame, pins: dict[str, str], clean: bool = False) -> DataFrame:
    """plan (shard, layout, count, ...) with pinned: what each run's draws are held to. A clean run holds the
    augmentation to none where no pin says otherwise; a run's own layout comes last."""
    pins = {**({"augmentation": "none"} if clean else {}), **pins}
    own = F.map_from_arrays(F.array(*map(F.lit, sorted(pins))).cast("array<string>"), F.array(*[F.lit(pins[k]) for k in sorted(pins)]).cast("array<string>"))
    return plan.withColumn("pinned", F.map_concat(F.map_filter(own, lambda k, v: k != "layout"), F.create_map(F.lit("layout"), F.col("layout"))))


def expected_shares(plan: DataFrame, options: DataFrame, pins: dict[str, str] | None = None, draws: int = DRAWS) -> DataFrame:
    """(shard, attribute, value, share): what a shard's runs should draw, by drawing each kind of run many times.

    A run's kind is its layout: each is drawn ``draws`` times with seeds of its own, failed draws left out, and
    weighted by the images that the shard takes of it. Kinds are as few as layouts, whatever the plan's size.
    """
    kinds = plan.select("layout").distinct().withColumn("kind", F.row_number().over(Window.orderBy("layout")) - 1)
    out = None
    for r in kinds.collect():
        seeds = plan.sparkSession.range(draws).select((F.col("id") + SEED + r["kind"] * STRIDE).alias("draw"))
        held = {**(pins or {}), "layout": r["layout"]}
        one = sampling.sample(seeds, options, held).withColumn("layout", F.lit(r["layout"]))
        out = one if out is None else out.unionByName(one)
    whole = out.where(~F.exists(F.map_values("attributes"), lambda v: v.isNull())).select("layout", "draw", F.explode("attributes").alias("attribute", "value"))
    seen = whole.groupBy("layout", "attribute", "value").agg(F.count("*").alias("n"))
    share = seen.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("layout", "attribute")))
    weighted = plan.groupBy("shard", "layout").agg(F.sum("count").alias("w")).join(share, "layout").groupBy("shard", "attribute", "value").agg(F.sum(F.col("p") * F.col("w")).alias("amount"))
    return weighted.select("shard", "attribute", "value", F.round(F.col("amount") / F.sum("amount").over(Window.partitionBy("shard", "attribute")), 6).alias("share"))


def compared(observed: DataFrame, expected: DataFrame, tolerance: float = TOLERANCE, min_draws: int = MIN_DRAWS, min_expected: float = MIN_EXPECTED) -> DataFrame:
    """(shard, attribute, severity, kind, value, amount): warnings of mixes that drifted and of values that never appeared,
    and notes of shards too small to judge or to resolve the tolerance.

    observed (shard, attribute, value, n), expected (shard, attribute, value, share): a full join on values.
    """
    both = observed.join(expected, ["shard", "attribute", "value"], "full_outer").fillna(0, ["n"]).fillna(0.0, ["share"])
    by = Window.partitionBy("shard", "attribute")
    both = both.withColumn("draws", F.sum("n").over(by)).where("draws > 0")
    p, n = F.col("share"), F.col("draws")
    noise = F.sum(F.when((p > 0) & (p < 1), F.sqrt(2 * p * (1 - p) / (F.pi() * n))).otherwise(0.0))
    mix = both.groupBy("shard", "attribute").agg(F.max("draws").alias("draws"), F.round(0.5 * F.sum(F.abs(F.col("n") / n - p)), 6).alias("distance"), F.round(0.5 * noise, 6).alias("noise"))
    verdict = lambda df, severity, kind, value, amount: df.select("shard", "attribute", F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), value.cast("string").alias("value"), amount.alias("amount"))
    nothing = F.lit(None)
    judged = F.col("draws") >= min_draws
    drifted = judged & (F.col("distance") > tolerance + F.col("noise"))
    lacking = both.where((F.col("n") == 0) & (p * n >= min_expected))
    return (
        verdict(mix.where(drifted), "warning", "drift", nothing, F.col("distance"))
        .unionByName(verdict(lacking, "warning", "never", F.col("value"), F.round(p * n, 6)))
        .unionByName(verdict(mix.where(judged & ~drifted & (F.col("noise") > tolerance)), "note", "unresolved", nothing, F.col("noise")))
        .unionByName(verdict(mix.where(~judged), "note", "few", nothing, F.col("draws").cast("double")))
    )


def stops(sources: DataFrame, known: list[str], limit: float = FALLBACK) -> DataFrame:
    """(backend, kind, share): backends of which too much content was substituted, or came from a source nobody knows.

    sources: backend, source, n.
    """
    per = sources.groupBy("backend").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("source") == "fallback", F.col("n")).otherwise(0)).alias("fell"), F.sum(F.when(F.col("source").isin(*known), 0).otherwise(F.col("n"))).alias("odd"))
    share = lambda c: F.round(F.col(c) / F.col("all"), 6)
    a = per.where(F.col("fell") > limit * F.col("all")).select("backend", F.lit("fallback").alias("kind"), share("fell").alias("share"))
    return a.unionByName(per.where("odd > 0").select("backend", F.lit("unknown").alias("kind"), share("odd").alias("share")))


def summary(vector: DataFrame, paired: bool) -> DataFrame:
    """One row for a run's vectors: images, draws, the backend that counts, collapsed totals and the mean text length.

    Paired backends draw the same pages, so only the first of them counts, and the draws are the most of any.
    """
    per = vector.groupBy("backend").agg(F.sum("images").alias("images"), F.sum("collapsed_totals").alias("collapsed"), F.sum(F.col("text_length_mean") * F.col("images")).alias("chars"))
    draws, chars = (F.max("images"), F.min_by("chars", "backend")) if paired else (F.sum("images"), F.sum("chars"))
    out = per.agg(F.sum("images").alias("images"), draws.alias("draws"), (F.min("backend") if paired else F.lit(None).cast("string")).alias("counted_backend"), F.sum("collapsed").alias("collapsed_totals"), chars.alias("chars"))
    share = lambda a, b: F.coalesce(F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 6), F.lit(0.0))
    return out.select("images", "draws", "counted_backend", "collapsed_totals", share("collapsed_totals", "images").alias("collapsed_total_share"), share("chars", "draws").alias("text_length_mean"))


def summed_counts(count: DataFrame, paired: bool) -> DataFrame:
    """(attribute, value, n) over a run; of paired backends the first."""
    own = count.join(F.broadcast(count.agg(F.min("backend").alias("backend"))), "backend", "left_semi") if paired else count
    return own.groupBy("attribute", "value").agg(F.sum("n").alias("n"))


def live_mix(count: DataFrame, done: DataFrame, attribute: str) -> DataFrame:
    """(value, n) of one attribute over finished shards of the backend that has most of them; names break ties."""
    finished = count.join(done.select("backend", "shard").distinct(), ["backend", "shard"], "left_semi")
    lead = done.groupBy("backend").agg(F.count_distinct("shard").alias("k")).orderBy(F.desc("k"), "backend").limit(1)
    return finished.where(F.col("attribute") == attribute).join(F.broadcast(lead), "backend", "left_semi").groupBy("value").agg(F.sum("n").alias("n"))


def signed(share: Column) -> Column:
    return F.format_string("%+.0f%%", 100 * share)
