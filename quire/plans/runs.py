"""A declared run: its configuration, checked; its plan of runs and shards as a table; what its shards report."""

from __future__ import annotations

import math
import os
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import planning

#: The sections and keys of a configuration.
KEYS = {
    "": ("run", "backends", "shard", "overrides", "quality"),
    "run": ("out", "per_backend", "seed", "workers", "clean", "force", "pairing", "layouts", "template"),
    "shard": ("size",),
    "quality": ("drift_tolerance", "sample_for_ocr"),
}
PAIRINGS = ("paired", "independent")
TOLERANCE = 0.15
PLAN = "backend_pos int, backend string, layout string, seed bigint, count bigint, first_index bigint, shard bigint"


class ConfigError(ValueError):
    """A configuration that can't be run."""


@dataclass(frozen=True)
class Config:
    out: str
    per_backend: int
    backends: tuple[str, ...]
    seed: int = 2026
    workers: int = 1
    shard_size: int = 250
    clean: bool = False
    pairing: str = "paired"
    force: tuple[str, ...] = ()
    layouts: tuple[str, ...] = ()
    template: str = ""
    overrides: dict[str, Any] = field(default_factory=dict)
    quality: dict[str, Any] = field(default_factory=dict)


def workers(value: Any) -> int:
    """A number of workers, or one less than the cores for auto."""
    if isinstance(value, str) and value.strip().lower() == "auto":
        return max(1, (os.cpu_count() or 2) - 1)
    try:
        n = int(value)
    except (TypeError, ValueError):
        n = 0
    if isinstance(value, str) or n < 1:
        raise ConfigError(f"run.workers: a number from 1 or auto, not {value!r}")
    return n


def known_only(section: str, given: Any) -> dict[str, Any]:
    """given, a mapping without keys other than the section's."""
    given = given or {}
    if not isinstance(given, dict):
        raise ConfigError(f"{section or 'config'}: must be a mapping")
    if more := sorted(set(given) - set(KEYS[section])):
        raise ConfigError(f"{section or 'config'}: unknown keys {more}; allowed are {sorted(KEYS[section])}")
    return given


def config(raw: Any, html_only: tuple[str, ...] = ()) -> Config:
    """A configuration from its parsed file. html_only: backends that can't draw a template."""
    top = known_only("", raw)
    run, shard, quality = (known_only(s, top.get(s)) for s in ("run", "shard", "quality"))
    backends, layouts, overrides = top.get("backends"), run.get("layouts") or [], top.get("overrides") or {}
    per, size, pairing = int(run.get("per_backend", 0)), int(shard.get("size", 250)), str(run.get("pairing", "paired"))
    template = str(run.get("template") or "")
    faults = {
        "backends: a list of one at least": not backends or not isinstance(backends, list),
        "run.out: required": not run.get("out"),
        f"run.per_backend: 1 at least, not {per}": per < 1,
        f"shard.size: 1 at least, not {size}": size < 1,
        "overrides: a mapping of attr.id.field to values": not isinstance(overrides, dict),
        f"run.pairing: one of {PAIRINGS}, not {pairing!r}": pairing not in PAIRINGS,
        "run.layouts: a list of names": not isinstance(layouts, (list, tuple)),
        "run.template: not every backend can draw it": bool(template) and bool(set(map(str, backends or ())) & set(html_only)),
    }
    for message, wrong in faults.items():
        if wrong:
            raise ConfigError(message)
    return Config(str(run["out"]), per, tuple(map(str, backends)), int(run.get("seed", 2026)), workers(run.get("workers", "auto")), size, bool(run.get("clean", False)), pairing, tuple(map(str, run.get("force") or ())), tuple(map(str, layouts)), template, dict(overrides), dict(quality))


def tolerance_of(quality: dict[str, Any] | None) -> float:
    """The drift that a run tolerates: a positive finite number, else the default."""
    try:
        value = float((quality or {}).get("drift_tolerance", TOLERANCE))
    except (TypeError, ValueError):
        return TOLERANCE
    return value if math.isfinite(value) and value > 0 else TOLERANCE


def pinned(force: tuple[str, ...], name: str = "layout") -> str | None:
    """The value that the first pin of that name gives."""
    return next((v.strip() for k, _, v in (str(x).partition("=") for x in force) if k.strip() == name and v.strip()), None)


def build_plan(spark: SparkSession, c: Config, layouts: list[str]) -> DataFrame:
    """PLAN: each backend's runs, cut into shards that are numbered over all backends.

    Seeds that two runs would share are an error, but for those of paired backends.
    """
    only = pinned(c.force)
    if only is not None and only not in layouts:
        raise ConfigError(f"force layout={only}: no such layout")
    names = spark.createDataFrame(list(enumerate([only] if only else layouts)), "pos int, layout string")
    quota = planning.quotas(names, c.per_backend, "pos")
    backends = spark.createDataFrame(list(enumerate(c.backends)), "backend_pos int, backend string")
    runs = planning.runs(backends.join(quota), "backend", c.seed, c.pairing == "paired").join(backends, "backend")
    clash = overlapping(runs, c.pairing == "paired")
    if clash.limit(1).count():
        raise ConfigError(f"the plan would draw one page twice: {clash.first().asDict()}")
    per = -(-c.per_backend // c.shard_size)
    cut = planning.shards(runs, "backend", c.shard_size).join(backends, "backend")
    first = runs.select("backend", "layout", F.col("seed").alias("run_seed"), "first_index")
    placed = cut.join(first, ["backend", "layout"]).withColumn("first_index", F.col("first_index") + F.col("seed") - F.col("run_seed"))
    return placed.select("backend_pos", "backend", "layout", "seed", "count", "first_index", (F.col("backend_pos") * per + F.col("shard")).cast("bigint").alias("shard"))


def overlapping(runs: DataFrame, paired: bool) -> DataFrame:
    """Runs whose seeds reach into the next run's; paired backends share theirs by design and are looked at one by one."""
    from ..operators.records import adjacent_overlaps

    ranges = runs.withColumn("lo", F.col("seed")).withColumn("hi", F.col("seed") + F.col("count")).withColumn("all", F.lit(0))
    return adjacent_overlaps(ranges, ["backend"] if paired else ["all"])


def shard_rows(plan: DataFrame) -> DataFrame:
    """(shard, name, backend, count, runs): a plan's shards, each with its runs in order."""
    run = F.struct("first_index", "layout", "seed", "count")
    out = plan.groupBy("shard", "backend").agg(F.sum("count").alias("count"), F.array_sort(F.collect_list(run)).alias("runs"))
    return out.select("shard", shard_name(F.col("shard")).alias("name"), "backend", "count", "runs")


def shard_name(number: Column) -> Column:
    return F.format_string("shard-%04d", number)


def shard_path(out: Column | str, number: Column) -> Column:
    return F.concat(F.lit(out) if isinstance(out, str) else out, F.lit("/shards/"), shard_name(number))


def plan_json(spark: SparkSession, c: Config, plan: DataFrame) -> DataFrame:
    """(plan): the whole plan as one JSON text, for a run's folder. A plan has as many shards as jobs were declared."""
    head = {k: v for k, v in asdict(c).items() if k not in ("out", "workers", "quality")}
    shards = shard_rows(plan).agg(F.array_sort(F.collect_list(F.struct(F.col("shard").alias("index"), "backend", "count", "runs"))).alias("shards"))
    import json

    text = json.dumps(head, sort_keys=True, ensure_ascii=False)
    return shards.select(F.concat(F.lit(text[:-1] + ', "shards": '), F.to_json("shards"), F.lit("}")).alias("plan"))


def command(plan: DataFrame, program: dict[str, str], clean: bool = False, force: tuple[str, ...] = (), template: str = "") -> DataFrame:
    """(shard, backend, argv): how each run would be drawn by an outside program (by backend)."""
    pins = [x for x in force if not x.replace(" ", "").startswith("layout=")]
    if clean and not any(x.replace(" ", "").startswith("augmentation=") for x in pins):
        pins.append("augmentation=none")
    more = [x for p in pins for x in ("--force", p)] + (["--template", template] if template else [])
    names = F.create_map(*[x for b, p in program.items() for x in (F.lit(b), F.lit(p))])
    argv = F.concat(F.array(names[F.col("backend")], F.lit("--layout"), F.col("layout"), F.lit("--seed"), F.col("seed").cast("string"), F.lit("--count"), F.col("count").cast("string")), F.array(*map(F.lit, more)).cast("array<string>"))
    return plan.select("shard", "backend", "first_index", argv.alias("argv"))


def progress(plan: DataFrame, done: DataFrame) -> DataFrame:
    """(backend, shards, finished, images, drawn): how far each backend is, by the shards that are marked done."""
    marks = done.select("shard").distinct().withColumn("done", F.lit(True))
    per = shard_rows(plan).join(marks, "shard", "left")
    return per.groupBy("backend").agg(F.count("*").alias("shards"), F.count("done").alias("finished"), F.sum("count").alias("images"), F.coalesce(F.sum(F.when(F.col("done"), F.col("count"))), F.lit(0)).alias("drawn"))


def gathered(reports: DataFrame, number: tuple[str, ...], counters: tuple[str, ...]) -> DataFrame:
    """One report of many shards' reports: numbers add up, counters (maps of names to numbers) by name.

    Maps are opened to rows and added as rows, so no task holds all of them.
    """
    sums = reports.agg(*[F.sum(c).alias(c) for c in number])
    out = sums
    for c in counters:
        each = reports.select(F.explode(c).alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v"))
        out = out.join(each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(c)))
    return out
