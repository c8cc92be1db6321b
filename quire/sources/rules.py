"""Rule files as tables: YAML with a list of options, or of groups of options, one file per attribute.

Rule files are small and read on the driver through the cluster's own file system, so any store will do;
what they say becomes a table of options (SCHEMA) that the samplers join with. A manifest lists the attributes in
the order in which they are drawn.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    import yaml
except ImportError:  # only reading and writing YAML needs it
    yaml = None

SCHEMA = "attr_pos int, attr string, opt_pos int, id string, weight double, tags array<string>, requires array<string>, excludes array<string>, group string, params string"
GROUPS = "attr string, id string, label string, tags array<string>, requires array<string>, excludes array<string>"
MANIFEST = "_order"
OPTION_KEYS = ("id", "weight", "tags", "requires", "excludes", "params")
GROUP_KEYS = ("id", "label", "tags", "requires", "excludes", "options")
SETS = ("tags", "requires", "excludes")
#: What an override may change.
CHANGEABLE = ("weight", *SETS)


class RuleError(ValueError):
    """A rule file, an override or a pin that says what can't be."""


def _only(raw: dict[str, Any], known: Sequence[str], where: str) -> None:
    if more := sorted(set(raw) - set(known)):
        raise RuleError(f"{where}: unknown keys {more}; allowed are {sorted(known)}")
    if "id" not in raw:
        raise RuleError(f"{where}: an entry without id")


def order_of(manifest: Sequence[str], present: Iterable[str]) -> list[str]:
    """The attributes in order: each listed once, and just those that have a file."""
    order = list(map(str, manifest or ()))
    if not order:
        raise RuleError("the manifest lists no attributes")
    faults = {"listed more than once": [a for a, n in Counter(order).items() if n > 1], "not listed": set(present) - set(order), "without a file": set(order) - set(present)}
    for what, names in faults.items():
        if names:
            raise RuleError(f"attributes {what}: {sorted(names)}")
    return order


def option(raw: dict[str, Any], attr: str, group: dict[str, Any] | None = None) -> dict[str, Any]:
    """One option as a row: tags and conditions of its group are its own too."""
    _only(raw, OPTION_KEYS, attr)
    weight = float(raw.get("weight", 1.0))
    if weight < 0:
        raise RuleError(f"{attr}/{raw['id']}: negative weight")
    up = group or {}
    return {"attr": attr, "id": str(raw["id"]), "weight": weight, **{k: sorted({*(raw.get(k) or ()), *(up.get(k) or ())}) for k in SETS}, "group": str(up.get("id", "")), "params": json.dumps(raw.get("params") or {}, sort_keys=True, ensure_ascii=False)}


def group(raw: dict[str, Any], attr: str) -> dict[str, Any]:
    _only(raw, GROUP_KEYS, f"{attr}: group")
    return {"attr": attr, "id": str(raw["id"]), "label": str(raw.get("label", "")), **{k: sorted(raw.get(k) or ()) for k in SETS}}


def values_of(raw: dict[str, Any], attr: str) -> tuple[list[dict[str, Any]], list[dict[str, Any]]]:
    """(options, groups) of a file's content: a flat list, or groups of options, never both; ids occur once."""
    flat, nodes = raw.get("options"), raw.get("groups")
    if bool(flat) == bool(nodes):
        raise RuleError(f"{attr}: either options or groups, and one of them")
    if flat:
        options, groups = [option(x, attr) for x in flat], []
    else:
        groups = [group(x, attr) for x in nodes]
        if empty := [str(x["id"]) for x in nodes if not x.get("options")]:
            raise RuleError(f"{attr}: groups without options {empty}")
        options = [option(x, attr, g) for node, g in zip(nodes, groups, strict=True) for x in node["options"]]
    for what, rows in (("option", options), ("group", groups)):
        if twice := [i for i, n in Counter(r["id"] for r in rows).items() if n > 1]:
            raise RuleError(f"{attr}: duplicate {what} ids {twice}")
    return options, groups


def _parsed(spark: SparkSession, folder: str) -> dict[str, Any]:
    """The YAML files of a folder, by stem."""
    if yaml is None:
        raise RuleError("reading rule files needs a YAML parser")
    # Spark's readers pass over names that begin with _, as the manifest's does; the file system itself doesn't.
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder}/*.yaml")
    store = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for found in store.globStatus(pattern):
        stream = store.open(found.getPath())
        try:
            out[found.getPath().getName().removesuffix(".yaml")] = yaml.safe_load(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) or {}
        finally:
            stream.close()
    return out


def table(spark: SparkSession, parsed: dict[str, Any], params: dict[str, dict[str, Any]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(options, groups) of parsed files, one of which is the manifest. params: of some attributes, each option's
    parameters by id; each such option has just one set, and no set is left over."""
    found = {a: values_of(raw, a) for a, raw in parsed.items() if not a.startswith("_")}
    order = order_of((parsed.get(MANIFEST) or {}).get("order"), found)
    for attr, given in (params or {}).items():
        rows = found[attr][0]
        if own := [r["id"] for r in rows if r["params"] != "{}"]:
            raise RuleError(f"{attr}: {own} have parameters in two places")
        if odd := sorted({r["id"] for r in rows} ^ set(given)):
            raise RuleError(f"{attr}: options and parameter files don't match: {odd}")
        for r in rows:
            r["params"] = json.dumps(given[r["id"]] or {}, sort_keys=True, ensure_ascii=False)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    options = [{"attr_pos": i, "opt_pos": j, **r} for i, a in enumerate(order) for j, r in enumerate(found[a][0])]
    groups = [g for a in order for g in found[a][1]]
    as_rows = lambda rows, cols: [tuple(r[c] for c in cols) for r in rows]
    return spark.createDataFrame(as_rows(options, names), SCHEMA), spark.createDataFrame(as_rows(groups, [c.split()[0] for c in GROUPS.split(", ")]), GROUPS)


def read(spark: SparkSession, folder: str, params: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(options, groups) of a folder of rule files. params: of some attributes, the folder of parameter files."""
    return table(spark, _parsed(spark, folder), {a: _parsed(spark, f) for a, f in (params or {}).items()})


def attributes(options: DataFrame) -> list[str]:
    return [r["attr"] for r in options.select("attr_pos", "attr").distinct().orderBy("attr_pos").collect()]


def pins(items: Iterable[str] | None, known: Sequence[str], layout: str | None = None) -> dict[str, str]:
    """ATTR=ID items as a dictionary, and the layout where none of them names one."""
    out: dict[str, str] = {}
    for item in items or ():
        name, equals, value = (x.strip() for x in str(item).partition("="))
        if not equals or not value:
            raise RuleError(f"a pin is ATTR=ID, not {item!r}")
        if name not in known:
            raise RuleError(f"pin of an unknown attribute {name!r}; have {', '.join(known)}")
        out[name] = value
    return {"layout": layout, **out} if layout else out


def overridden(options: DataFrame, changes: dict[str, Any]) -> DataFrame:
    """options with attr.id.field values changed; field is one of CHANGEABLE, and what is named must exist."""
    ids = {(r["attr"], r["id"]) for r in options.select("attr", "id").collect()}
    out = options
    for path, value in changes.items():
        parts = str(path).split(".")
        if len(parts) != 3 or parts[2] not in CHANGEABLE or (parts[0], parts[1]) not in ids:
            raise RuleError(f"override {path!r}: names no option, or a field other than {', '.join(CHANGEABLE)}")
        attr, name, field = parts
        if field == "weight" and float(value) < 0:
            raise RuleError(f"{attr}/{name}: negative weight")
        new = F.lit(float(value)) if field == "weight" else F.array(*map(F.lit, sorted(value or ()))).cast("array<string>")
        out = out.withColumn(field, F.when((F.col("attr") == attr) & (F.col("id") == name), new).otherwise(F.col(field)))
    return out


def written(options: DataFrame) -> dict[str, str]:
    """Rule files of options, by name: the manifest and a flat file for each attribute. They read back to the options."""
    if yaml is None:
        raise RuleError("writing rule files needs a YAML parser")
    rows = options.orderBy("attr_pos", "opt_pos").collect()
    order = list(dict.fromkeys(r["attr"] for r in rows))
    body = lambda r: {"id": r["id"], "weight": r["weight"], **{k: list(r[k]) for k in SETS if r[k]}, **({"params": p} if (p := json.loads(r["params"])) else {})}
    dump = lambda x: yaml.safe_dump(x, allow_unicode=True, sort_keys=False)
    return {f"{MANIFEST}.yaml": dump({"order": order}), **{f"{a}.yaml": dump({"options": [body(r) for r in rows if r["attr"] == a]}) for a in order}}


def param(recipe: Column, options: dict[str, str], key: str, default: str | None = None) -> Column:
    """A parameter of what a recipe (map of attribute to id) drew of one attribute. options: its parameters as JSON by id."""
    table_ = F.create_map(*[x for i, p in options.items() for x in (F.lit(i), F.lit(p))])
    return F.coalesce(F.get_json_object(F.try_element_at(table_, recipe), f"$.{key}"), F.lit(default))


def recipe_json(draw: DataFrame, options: DataFrame) -> DataFrame:
    """(draw, recipe): a recipe (draw, attributes, tags) as JSON of its seed, each attribute's id, group and parameters, and its tags."""
    rows = draw.select("draw", "tags", F.explode("attributes").alias("attr", "id"))
    known = options.select("attr_pos", "attr", "id", "group", "params")
    body = F.concat(F.lit('"'), F.col("attr"), F.lit('":{"id":"'), F.col("id"), F.lit('"'), F.when(F.col("group") != "", F.concat(F.lit(',"group":"'), F.col("group"), F.lit('"'))).otherwise(""), F.lit(',"params":'), F.col("params"), F.lit("}"))
    placed = F.array_sort(F.collect_list(F.struct("attr_pos", body.alias("body"))))
    out = rows.join(F.broadcast(known), ["attr", "id"]).groupBy("draw").agg(placed.alias("a"), F.first("tags").alias("tags"))
    text = F.concat(F.lit('{"seed":'), F.col("draw").cast("string"), F.lit(',"attributes":{'), F.array_join(F.transform("a", lambda x: x["body"]), ","), F.lit('},"tags":'), F.to_json(F.array_sort("tags")), F.lit("}"))
    return out.select("draw", text.alias("recipe"))
