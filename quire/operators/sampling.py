"""Constrained weighted sampling over a table of options.

Options (attr_pos, attr, opt_pos, id, weight, tags, requires, excludes): attributes are drawn in order;
an option may be drawn if the tags collected so far hold all it requires and none it excludes. The options
are a small table (MOST rows at most) and become one literal, which each draw folds over: nothing is joined
or shuffled, however many draws there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "attr_pos int, attr string, opt_pos int, id string, weight double, tags array<string>, requires array<string>, excludes array<string>"


def allowed(tags: Column, requires: Column, excludes: Column) -> Column:
    return (F.size(F.array_except(requires, tags)) == 0) & ~F.arrays_overlap(excludes, tags)


def uniform(*key: Column) -> Column:
    """In [0, 1), from the MD5 of the key: the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[k.cast("string") for k in key])), 1, 8), 16, 10).cast("double") / 4294967296.0


def weight_shares(options: DataFrame) -> DataFrame:
    total = F.sum("weight").over(Window.partitionBy("attr"))
    return options.select("attr", "id", F.round(F.col("weight") / total, 6).alias("share"))


#: Rows of a table of options that are turned into a literal.
MOST = 10_000


def _literal(options: DataFrame) -> dict[str, Column]:
    """Each attribute's options, in order, as an array of structs; attributes in order."""
    rows = options.select("attr_pos", "attr", "opt_pos", "id", "weight", "tags", "requires", "excludes").orderBy("attr_pos", "opt_pos").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"a table of options has {MOST} rows at most")
    strings = lambda x: F.array(*map(F.lit, x or ())).cast("array<string>")
    of: dict[str, list[Column]] = {}
    for r in rows:
        of.setdefault(r["attr"], []).append(F.struct(F.lit(r["id"]).alias("id"), F.lit(float(r["weight"])).alias("weight"), strings(r["tags"]).alias("tags"), strings(r["requires"]).alias("requires"), strings(r["excludes"]).alias("excludes")))
    return {a: F.array(*x) for a, x in of.items()}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def _chosen(legal: Column, u: Column) -> Column:
    """The first of legal whose running weight reaches u times the total; null of none, or if all weigh nothing."""
    total = F.aggregate(legal, F.lit(0.0), lambda acc, o: acc + o["weight"])
    kind = "struct<id:string,weight:double,tags:array<string>,requires:array<string>,excludes:array<string>>"

    def walk(t: Column) -> Column:
        step = lambda acc, o: F.struct((acc["run"] + o["weight"]).alias("run"), F.when(acc["hit"].isNull() & (acc["run"] + o["weight"] >= u * t), o).otherwise(acc["hit"]).alias("hit"))
        return F.when(t > 0, F.aggregate(legal, F.struct(F.lit(0.0).alias("run"), F.lit(None).cast(kind).alias("hit")), step, lambda acc: acc["hit"]))

    return _let(total, walk)


def draw_one(rows: DataFrame, options: DataFrame, key: str, u: Column) -> DataFrame:
    """(key, id): for each row of rows the first option whose running weight reaches u times the total. options are one attribute's."""
    (listed,) = _literal(options).values()
    return rows.select(key, _chosen(listed, u)["id"].alias("id"))


def sample(draws: DataFrame, options: DataFrame, force: dict[str, str] | None = None, attempts: int = 1) -> DataFrame:
    """(draw, attributes, tags): one recipe per draw (draw bigint).

    A pinned id is drawn alone. An attribute without a legal option is null; with more attempts, a draw that had
    any is made anew with other chances, until it has none or the attempts are used up.
    """
    listed, force = _literal(options), force or {}
    if unknown := sorted(set(force) - set(listed)):
        raise ValueError(f"pins of unknown attributes {unknown}")

    def recipe(attempt: Column | None) -> Column:
        def step(left: list[str], tags: Column, ids: list[Column]) -> Column:
            if not left:
                return F.struct(F.map_from_arrays(F.array(*map(F.lit, listed)), F.array(*ids)).alias("attributes"), F.array_sort(tags).alias("tags"), F.array_contains(F.transform(F.array(*ids), lambda x: x.isNull()), True).alias("clash"))
            attr = left[0]
            name = F.lit(attr) if attempt is None else F.when(attempt == 0, attr).otherwise(F.concat(F.lit(f"{attr}:"), attempt.cast("string")))
            own = listed[attr] if attr not in force else F.filter(listed[attr], lambda o: o["id"] == force[attr])
            legal = F.filter(own, lambda o: allowed(tags, o["requires"], o["excludes"]))
            hit = _let(legal, lambda x: _chosen(x, uniform(F.col("draw"), name)))
            return _let(hit, lambda o: _let(F.array_union(tags, F.coalesce(o["tags"], F.array().cast("array<string>"))), lambda more: step(left[1:], more, [*ids, o["id"]])))

        return step(list(listed), F.array().cast("array<string>"), [])

    if attempts == 1:
        made = recipe(None)
    else:
        first = F.lit(None).cast("struct<attributes:map<string,string>,tags:array<string>,clash:boolean>")
        made = F.aggregate(F.sequence(F.lit(0), F.lit(attempts - 1)), first, lambda acc, a: F.when(acc["clash"].eqNullSafe(F.lit(False)), acc).otherwise(recipe(a)))
    return draws.select("draw", made.alias("r")).select("draw", "r.attributes", "r.tags")


def impossible(options: DataFrame, force: dict[str, str]) -> list[str]:
    """Pinned options that no legal choice before them allows, whatever the draws."""
    states: set[frozenset[str]] = {frozenset()}
    lost = []
    by: dict[str, list] = {}
    for r in options.orderBy("attr_pos", "opt_pos").limit(MOST).collect():
        by.setdefault(r["attr"], []).append(r)
    for attr, rows in by.items():
        own = [r for r in rows if attr not in force or r["id"] == force[attr]]
        after = {s | set(r["tags"] or ()) for s in states for r in own if r["weight"] > 0 or attr in force if set(r["requires"] or ()) <= s and not set(r["excludes"] or ()) & s}
        if not after:
            if attr in force:
                lost.append(f"{attr}={force[attr]}")
            break
        states = after
    return lost


def reachable(options: DataFrame) -> DataFrame:
    """(attr_pos, tags): every set of tags that can be held before an attribute; distinct at each step, so the sets stay few."""
    spark = options.sparkSession
    state = spark.createDataFrame([([],)], "tags array<string>")
    out = None
    for pos, attr in sorted({(r.attr_pos, r.attr) for r in options.select("attr_pos", "attr").distinct().collect()}):
        here = state.select(F.lit(pos).alias("attr_pos"), "tags")
        out = here if out is None else out.unionByName(here)
        own = options.where((F.col("attr") == attr) & (F.col("weight") > 0)).select(F.col("tags").alias("more"), "requires", "excludes")
        state = state.join(F.broadcast(own), allowed(F.col("tags"), F.col("requires"), F.col("excludes"))).select(F.array_sort(F.array_union("tags", "more")).alias("tags")).distinct()
    return out


def invalid(options: DataFrame) -> DataFrame:
    """(attr, id, problem): options that nothing before can satisfy, without weight, or given twice."""
    before = options.alias("o").join(options.select(F.col("attr_pos").alias("p"), F.explode("tags").alias("t")), F.col("p") < F.col("attr_pos"), "left")
    known = before.groupBy("attr", "id", "opt_pos").agg(F.collect_set("t").alias("known"), F.first("requires").alias("requires"))
    lost = known.where(F.size(F.array_except("requires", "known")) > 0).select("attr", "id", F.lit("unsatisfiable").alias("problem"))
    idle = options.where("weight <= 0").select("attr", "id", F.lit("no weight").alias("problem"))
    twice = options.groupBy("attr", "id").count().where("count > 1").select("attr", "id", F.lit("duplicate").alias("problem"))
    return lost.unionByName(idle).unionByName(twice)


def overridden(options: DataFrame, changes: DataFrame) -> DataFrame:
    """options with the weights of changes (attr, id, weight)."""
    new = changes.select("attr", "id", F.col("weight").alias("new"))
    return options.join(new, ["attr", "id"], "left").withColumn("weight", F.coalesce("new", "weight")).drop("new")
