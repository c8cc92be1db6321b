"""Further queries: rules, runs, drift, proof, inspections, baselines, costs, labels and page layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import baseline, costs, drift, inspect, labels, layout, proof, sampling, sheets, stats, tables
from ..sources import rules as rule_files
from . import runs
from .registry import query

# --- rules ---

#: A rule folder as parsed: three attributes, one of them in groups.
RULES = {
    "_order": {"order": ["document", "layout", "augmentation"]},
    "document": {"groups": [
        {"id": "retail", "label": "Shops", "tags": ["shop"], "options": [{"id": "receipt", "weight": 3, "tags": ["short"]}, {"id": "bill", "weight": 1, "params": {"copies": 2}}]},
        {"id": "office", "options": [{"id": "invoice", "weight": 2, "tags": ["long"]}]},
    ]},
    "layout": {"options": [{"id": "narrow", "weight": 2, "requires": ["shop"]}, {"id": "wide", "excludes": ["short"]}, {"id": "plain", "weight": 0.5}]},
    "augmentation": {"options": [{"id": "none", "weight": 1, "params": {"chain": []}}, {"id": "aged", "weight": 1, "requires": ["long"], "params": {"chain": ["blur", ["holes", {"n": 3}]]}}]},
}

_OPTIONS = """
SELECT * FROM (VALUES (0, 'document', 0, 'receipt', 3.0::DOUBLE, ['shop', 'short'], []::VARCHAR[], []::VARCHAR[], 'retail', '{}'), (0, 'document', 1, 'bill', 1.0, ['shop'], [], [], 'retail', '{"copies": 2}'),
 (0, 'document', 2, 'invoice', 2.0, ['long'], [], [], 'office', '{}'), (1, 'layout', 0, 'narrow', 2.0, [], ['shop'], [], '', '{}'), (1, 'layout', 1, 'wide', 1.0, [], [], ['short'], '', '{}'),
 (1, 'layout', 2, 'plain', 0.5, [], [], [], '', '{}'), (2, 'augmentation', 0, 'none', 1.0, [], [], [], '', '{"chain": []}'), (2, 'augmentation', 1, 'aged', 1.0, [], ['long'], [], '', '{"chain": ["blur", ["holes", {"n": 3}]]}'))
 AS o(attr_pos, attr, opt_pos, id, weight, tags, requires, excludes, "group", params)
"""


@query(_OPTIONS)
def rule_options(t, spark):
    return rule_files.table(spark, RULES)[0]


@query("SELECT * FROM (VALUES ('document', 'retail', 'Shops', ['shop'], []::VARCHAR[], []::VARCHAR[]), ('document', 'office', '', [], [], [])) AS g(attr, id, label, tags, requires, excludes)")
def rule_groups(t, spark):
    return rule_files.table(spark, RULES)[1]


@query(f"SELECT attr, id, CASE WHEN id = 'bill' THEN 7.5::DOUBLE ELSE weight END AS weight, CASE WHEN id = 'plain' THEN ['long', 'shop'] ELSE requires END AS requires FROM ({_OPTIONS})")
def rule_overrides(t, spark):
    changed = rule_files.overridden(rule_files.table(spark, RULES)[0], {"document.bill.weight": 7.5, "layout.plain.requires": ["shop", "long"]})
    return changed.select("attr", "id", "weight", "requires")


@query("""
WITH d AS (SELECT c_custkey, 'u' || c_custkey % 3 AS k FROM customer),
p AS (SELECT c_custkey, CASE k WHEN 'u0' THEN 'receipt' WHEN 'u1' THEN 'bill' ELSE 'invoice' END AS d FROM d)
SELECT c_custkey, CASE WHEN d = 'bill' THEN '2' ELSE '1' END AS copies,
  '{"seed":' || c_custkey || ',"attributes":{"document":{"id":"' || d || '","group":"' || CASE WHEN d = 'invoice' THEN 'office' ELSE 'retail' END || '","params":' || CASE WHEN d = 'bill' THEN '{"copies": 2}' ELSE '{}' END || '},"layout":{"id":"plain","params":{}}},"tags":["t"]}' AS recipe FROM p
""")
def recipe_records(t, spark):
    options = rule_files.table(spark, RULES)[0]
    k = F.col("c_custkey")
    document = F.when(k % 3 == 0, "receipt").when(k % 3 == 1, "bill").otherwise("invoice")
    draws = t("customer").select(k.alias("draw"), F.create_map(F.lit("document"), document, F.lit("layout"), F.lit("plain")).alias("attributes"), F.array(F.lit("t")).alias("tags"))
    params = {r["id"]: r["params"] for r in options.where("attr = 'document'").collect()}
    copies = draws.select("draw", rule_files.param(F.col("attributes")["document"], params, "copies", "1").alias("copies"))
    return rule_files.recipe_json(draws, options).join(copies, "draw").withColumnRenamed("draw", "c_custkey")


#: The draws by the options' running weights, as the sampler makes them, in SQL.
_U = "('0x' || substr(md5(d || ':{a}'), 1, 8))::UBIGINT::DOUBLE / 4294967296.0"
_DRAWN = f"""
WITH o AS ({_OPTIONS}), d AS (SELECT c_custkey AS d FROM customer),
c1 AS (SELECT d, id, tags, sum(weight) OVER (PARTITION BY d ORDER BY opt_pos) AS run, sum(weight) OVER (PARTITION BY d) AS total, opt_pos FROM d, o WHERE attr = 'document'),
d1 AS (SELECT d, first(id ORDER BY opt_pos) AS document, first(tags ORDER BY opt_pos) AS tags FROM c1 WHERE run >= {_U.format(a="document")} * total GROUP BY d),
c2 AS (SELECT d, document, d1.tags AS tags, id, sum(weight) OVER (PARTITION BY d ORDER BY opt_pos) AS run, sum(weight) OVER (PARTITION BY d) AS total, opt_pos FROM d1, o WHERE attr = 'layout' AND list_has_all(d1.tags, requires) AND NOT list_has_any(d1.tags, excludes)),
d2 AS (SELECT d, first(document ORDER BY opt_pos) AS document, first(tags ORDER BY opt_pos) AS tags, first(id ORDER BY opt_pos) AS layout FROM c2 WHERE run >= {_U.format(a="layout")} * total GROUP BY d),
c3 AS (SELECT d, document, d2.tags AS tags, layout, id, sum(weight) OVER (PARTITION BY d ORDER BY opt_pos) AS run, sum(weight) OVER (PARTITION BY d) AS total, opt_pos FROM d2, o WHERE attr = 'augmentation' AND list_has_all(d2.tags, requires) AND NOT list_has_any(d2.tags, excludes)),
d3 AS (SELECT d, first(document ORDER BY opt_pos) AS document, first(layout ORDER BY opt_pos) AS layout, first(id ORDER BY opt_pos) AS augmentation FROM c3 WHERE run >= {_U.format(a="augmentation")} * total GROUP BY d)
"""


@query(_DRAWN + "SELECT d AS c_custkey, document, layout, augmentation FROM d3")
def drawn_recipes(t, spark):
    drawn = sampling.sample(t("customer").select(F.col("c_custkey").alias("draw")), rule_files.table(spark, RULES)[0])
    return drawn.select(F.col("draw").alias("c_custkey"), *[F.col("attributes")[a].alias(a) for a in ("document", "layout", "augmentation")])


@query(_DRAWN + "SELECT attribute, value, count(*) AS n FROM (UNPIVOT (SELECT document, layout, augmentation FROM d3) ON document, layout, augmentation INTO NAME attribute VALUE value) GROUP BY ALL")
def drawn_distribution(t, spark):
    drawn = sampling.sample(t("customer").select(F.col("c_custkey").alias("draw")), rule_files.table(spark, RULES)[0])
    return drawn.select(F.explode("attributes").alias("attribute", "value")).groupBy("attribute", "value").agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES ('none', 0, NULL), ('aged', 0, 'blur'), ('aged', 1, 'holes')) AS s(id, pos, step) WHERE step IS NOT NULL")
def chain_steps(t, spark):
    options = rule_files.table(spark, RULES)[0].where("attr = 'augmentation'").select("id", F.get_json_object("params", "$.chain").alias("chain"))
    return inspect.chain_steps(options, "id", "chain")


# --- runs ---

CONFIG = {"run": {"out": "/out", "per_backend": 53, "seed": 900, "workers": 2, "pairing": "independent", "force": ["augmentation=none"]}, "backends": ["html", "glyph", "print"], "shard": {"size": 20}}

_PLAN = """
WITH l AS (SELECT n_name AS layout, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos FROM nation WHERE n_regionkey = 1), k AS (SELECT count(*) AS k FROM l),
b AS (SELECT * FROM (VALUES (0, 'html'), (1, 'glyph'), (2, 'print')) AS b(backend_pos, backend)),
r AS (SELECT backend_pos, backend, layout, pos, 53 // k + CASE WHEN pos < 53 % k THEN 1 ELSE 0 END AS quota FROM l, k, b),
f AS (SELECT *, 900 + backend_pos * 100000 + pos * 1000 AS seed, coalesce(sum(quota) OVER (PARTITION BY backend ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fi FROM r),
p AS (SELECT backend_pos, backend, layout, seed + i AS seed, fi + i AS idx FROM f, (SELECT unnest(range(0, 53)) AS i) WHERE i < quota),
s AS (SELECT backend_pos, backend, layout, min(seed)::BIGINT AS seed, count(*) AS count, min(idx)::BIGINT AS first_index, (backend_pos * 3 + idx // 20)::BIGINT AS shard FROM p GROUP BY backend_pos, backend, layout, idx // 20)
"""


def _plan(t, spark):
    names = [r["n_name"] for r in t("nation").where("n_regionkey = 1").orderBy("n_nationkey").collect()]
    return runs.build_plan(spark, runs.config(CONFIG), names)


@query(_PLAN + "SELECT * FROM s")
def run_plan(t, spark):
    return _plan(t, spark)


@query(_PLAN + "SELECT shard, printf('shard-%04d', shard) AS name, backend, sum(count)::BIGINT AS count, string_agg(layout || ':' || seed || '+' || count, ' ' ORDER BY first_index) AS runs FROM s GROUP BY shard, backend")
def plan_shards(t, spark):
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["layout"], F.lit(":"), r["seed"].cast("string"), F.lit("+"), r["count"].cast("string"))), " ")
    return runs.shard_rows(_plan(t, spark)).withColumn("runs", listed)


@query(_PLAN + "SELECT shard, backend, first_index, ['draw-' || backend, '--layout', layout, '--seed', seed::VARCHAR, '--count', count::VARCHAR, '--force', 'augmentation=none'] AS argv FROM s")
def run_commands(t, spark):
    return runs.command(_plan(t, spark), {b: f"draw-{b}" for b in CONFIG["backends"]}, clean=True, force=tuple(CONFIG["run"]["force"]))


@query(_PLAN + ", g AS (SELECT shard, backend, sum(count) AS c FROM s GROUP BY ALL) SELECT backend, count(*) AS shards, count(*) FILTER (shard % 2 = 0) AS finished, sum(c)::BIGINT AS images, coalesce(sum(c) FILTER (shard % 2 = 0), 0)::BIGINT AS drawn FROM g GROUP BY backend")
def run_progress(t, spark):
    plan = _plan(t, spark)
    return runs.progress(plan, plan.where("shard % 2 = 0").select("shard").distinct())


@query(_PLAN + "SELECT shard, layout, map(['augmentation', 'layout'], ['none', layout])::VARCHAR AS pinned FROM s")
def forced_runs(t, spark):
    pinned = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("pinned"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", "), F.lit("}"))
    return drift.forced(_plan(t, spark), {}, clean=True).select("shard", "layout", pinned.alias("pinned"))


@query("""
WITH w AS (SELECT source, count(*) AS images, sum(n_chars)::BIGINT AS boxes FROM documents GROUP BY source)
SELECT sum(images)::BIGINT AS images, sum(boxes)::BIGINT AS boxes, (SELECT string_agg(lang || '=' || n, ',' ORDER BY lang) FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)) AS langs FROM w
""")
def gathered_reports(t, spark):
    each = t("documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("c"))
    reports = each.groupBy("source").agg(F.sum("n").alias("images"), F.sum("c").alias("boxes"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("langs"))
    told = F.array_join(F.transform(F.map_entries("langs"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return runs.gathered(reports, ("images", "boxes"), ("langs",)).withColumn("langs", told)


# --- drift ---

_RECORDS = "SELECT source AS backend, (doc_id % 4)::BIGINT AS shard, lang, CASE WHEN doc_id % 5 = 0 THEN 'fallback' ELSE 'corpus' END AS kind, text, n_chars, (doc_id % 7 = 0)::INT AS collapsed FROM documents"


def _drawn(t):
    k = F.col("doc_id")
    return t("documents").select(F.col("source").alias("backend"), (k % 4).alias("shard"), "lang", F.when(k % 5 == 0, "fallback").otherwise("corpus").alias("kind"), "text", "n_chars", (k % 7 == 0).cast("int").alias("collapsed"))


@query(f"""
SELECT backend, shard, count(*) AS images, round(avg(length(text)), 6) AS text_length_mean, round(avg(n_chars), 6) AS image_pixels_mean, sum(collapsed)::BIGINT AS collapsed_totals, round(sum(collapsed) / count(*)::DOUBLE, 6) AS collapsed_total_share,
       round(avg(CASE WHEN regexp_matches(text, '[áàãéèíìóòõúùýâêôÁÀÃÉÈÍÌÓÒÕÚÙÝÂÊÔăđơưĂĐƠƯ]') THEN 1.0 ELSE 0.0 END), 6) AS diacritic_share
FROM ({_RECORDS}) GROUP BY ALL
""")
def shard_vectors(t, spark):
    return drift.vectors(_drawn(t), "text", "n_chars")


@query(f"SELECT backend, shard, attribute, value, count(*) AS n FROM (UNPIVOT (SELECT backend, shard, lang, kind FROM ({_RECORDS})) ON lang, kind INTO NAME attribute VALUE value) GROUP BY ALL")
def shard_counts(t, spark):
    return drift.counts(_drawn(t), ["lang", "kind"])


@query(f"""
WITH c AS (SELECT backend, count(*) AS images, sum(collapsed) AS collapsed FROM ({_RECORDS}) GROUP BY backend), f AS (SELECT sum(length(text)) AS chars, count(*) AS n FROM ({_RECORDS}) WHERE backend = (SELECT min(backend) FROM c))
SELECT sum(images)::BIGINT AS images, max(images) AS draws, min(backend) AS counted_backend, sum(collapsed)::BIGINT AS collapsed_totals, round(sum(collapsed) / sum(images)::DOUBLE, 6) AS collapsed_total_share, round((SELECT chars FROM f) / max(images)::DOUBLE, 2) AS text_length_mean FROM c
""")
def run_summary_paired(t, spark):
    return drift.summary(drift.vectors(_drawn(t), "text", "n_chars"), True).withColumn("text_length_mean", F.round("text_length_mean", 2))


@query(f"SELECT attribute, value, count(*) AS n FROM (UNPIVOT (SELECT lang, kind FROM ({_RECORDS}) WHERE backend = (SELECT min(source) FROM documents)) ON lang, kind INTO NAME attribute VALUE value) GROUP BY ALL")
def run_counts_paired(t, spark):
    return drift.summed_counts(drift.counts(_drawn(t), ["lang", "kind"]), True)


@query(f"SELECT backend, 'fallback' AS kind, round(count(*) FILTER (kind = 'fallback') / count(*)::DOUBLE, 6) AS share FROM ({_RECORDS}) GROUP BY backend HAVING count(*) FILTER (kind = 'fallback') > 0.05 * count(*)")
def source_stops(t, spark):
    return drift.stops(_drawn(t).groupBy("backend", F.col("kind").alias("source")).agg(F.count("*").alias("n")), ["corpus", "fallback"])


_EXPECTED = """
WITH p AS (SELECT lang AS value, count(*) / (SELECT count(*) FROM documents)::DOUBLE AS share FROM documents WHERE lang <> 'de' GROUP BY lang UNION ALL SELECT 'xx', 0.25),
o AS (SELECT source AS shard, lang AS value, count(*) AS n FROM documents GROUP BY ALL), s AS (SELECT shard, sum(n) AS draws FROM o GROUP BY shard),
b AS (SELECT s.shard, v.value, s.draws, coalesce(o.n, 0) AS n, coalesce(p.share, 0) AS p FROM s CROSS JOIN (SELECT value FROM p UNION SELECT value FROM o) v LEFT JOIN o ON o.shard = s.shard AND o.value = v.value LEFT JOIN p ON p.value = v.value WHERE o.n IS NOT NULL OR p.share IS NOT NULL),
m AS (SELECT shard, max(draws) AS draws, round(0.5 * sum(abs(n / draws::DOUBLE - p)), 6) AS distance, round(0.5 * sum(CASE WHEN p > 0 AND p < 1 THEN sqrt(2 * p * (1 - p) / (pi() * draws)) ELSE 0 END), 6) AS noise FROM b GROUP BY shard)
"""


@query(_EXPECTED + """
SELECT shard, 'lang' AS attribute, 'warning' AS severity, 'drift' AS kind, NULL AS value, distance AS amount FROM m WHERE draws >= 30 AND distance > 0.15 + noise
UNION ALL SELECT shard, 'lang', 'warning', 'never', value, round(p * draws, 6) FROM b WHERE n = 0 AND p * draws >= 5
UNION ALL SELECT shard, 'lang', 'note', 'unresolved', NULL, noise FROM m WHERE draws >= 30 AND NOT distance > 0.15 + noise AND noise > 0.15
UNION ALL SELECT shard, 'lang', 'note', 'few', NULL, draws::DOUBLE FROM m WHERE draws < 30
""")
def drift_verdicts(t, spark):
    docs = t("documents")
    overall = stats.shares(docs, "lang").where("value <> 'de'").select("value", "share").unionByName(spark.createDataFrame([("xx", 0.25)], "value string, share double"))
    shards = docs.select(F.col("source").alias("shard"), F.lit("lang").alias("attribute")).distinct()
    observed = docs.groupBy(F.col("source").alias("shard"), F.lit("lang").alias("attribute"), F.col("lang").alias("value")).agg(F.count("*").alias("n"))
    return drift.compared(observed, shards.join(F.broadcast(overall)))


@query(_DRAWN.replace("SELECT c_custkey AS d FROM customer", "SELECT unnest(range(20260101, 20260501)) AS d") + """
, n AS (SELECT 'plain' AS layout, 'document' AS attribute, document AS value FROM d1
        UNION ALL SELECT 'plain', 'layout', 'plain' FROM d1),
a AS (SELECT d, document, d1.tags AS tags, id, sum(weight) OVER (PARTITION BY d ORDER BY opt_pos) AS run, sum(weight) OVER (PARTITION BY d) AS total, opt_pos FROM d1, o WHERE attr = 'augmentation' AND list_has_all(d1.tags, requires) AND NOT list_has_any(d1.tags, excludes)),
x AS (SELECT d, first(id ORDER BY opt_pos) AS value FROM a WHERE run >= ('0x' || substr(md5(d || ':augmentation'), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 * total GROUP BY d)
SELECT 0::BIGINT AS shard, attribute, value, round(count(*) / 400.0::DOUBLE, 6) AS share FROM (SELECT attribute, value FROM n UNION ALL SELECT 'augmentation', value FROM x) GROUP BY attribute, value
""")
def expected_shares(t, spark):
    plan = spark.createDataFrame([(0, "plain", 20), (0, "plain", 5)], "shard bigint, layout string, count bigint")
    return drift.expected_shares(plan, rule_files.table(spark, RULES)[0])


@query("""
WITH d AS (SELECT DISTINCT source AS backend, doc_id % 4 AS shard FROM documents WHERE doc_id % 3 > 0), k AS (SELECT backend, count(*) AS k FROM d GROUP BY backend), l AS (SELECT backend FROM k ORDER BY k DESC, backend LIMIT 1)
SELECT lang AS value, count(*) AS n FROM documents, l WHERE source = l.backend AND doc_id % 4 IN (SELECT shard FROM d WHERE d.backend = l.backend) GROUP BY lang
""")
def observed_mix(t, spark):
    done = t("documents").where("doc_id % 3 > 0").select(F.col("source").alias("backend"), (F.col("doc_id") % 4).alias("shard")).distinct()
    return drift.live_mix(drift.counts(_drawn(t), ["lang", "kind"]), done, "lang")


# --- proof ---

_FIELDS = r"""
WITH f AS (SELECT conv_id, role || '.' || turn AS role, text AS expected FROM conversations WHERE role = 'user' AND trim(coalesce(text, '')) <> ''),
r AS (SELECT conv_id, string_agg(text, ' ') AS read FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
x AS (SELECT conv_id, role, expected, [x FOR x IN regexp_split_to_array(lower(expected), '[^\p{L}\p{N}_.,\-]+') IF regexp_matches(x, '[\p{L}\p{N}_]')] AS w, [x FOR x IN regexp_split_to_array(lower(read), '[^\p{L}\p{N}_.,\-]+') IF regexp_matches(x, '[\p{L}\p{N}_]')] AS bag FROM f JOIN r USING (conv_id)),
s AS (SELECT conv_id, role, expected, CASE WHEN len(w) = 0 THEN 1.0 ELSE round(len([y FOR y IN w IF list_contains(bag, y)]) / len(w)::DOUBLE, 6) END AS score FROM x)
"""


def _scores(t):
    c = t("conversations")
    said = F.trim(F.coalesce("text", F.lit(""))) != ""
    field = c.where((F.col("role") == "user") & said).groupBy("conv_id").agg(F.collect_list(F.struct(F.concat_ws(".", "role", F.col("turn").cast("string")).alias("role"), F.col("text").alias("expected"))).alias("fields"))
    read = c.where("role = 'assistant'").groupBy("conv_id").agg(F.array_join(F.collect_list("text"), " ").alias("read"))
    return proof.scored(field.join(read, "conv_id"), "conv_id", "fields", "read")


@query(_FIELDS + "SELECT conv_id, count(*) AS fields, count(*) FILTER (score >= 0.3) AS hits, round(count(*) FILTER (score >= 0.3) / count(*)::DOUBLE, 6) AS field_hit_rate FROM s GROUP BY conv_id")
def field_hit_rate(t, spark):
    return proof.hit_rates(_scores(t), "conv_id", 0.3)


@query(_FIELDS + "SELECT conv_id, role, expected, score, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score, role, expected) AS place FROM s) WHERE place <= 3")
def worst_fields(t, spark):
    return proof.worst(_scores(t), "conv_id")


@query("""
SELECT o_orderkey, unnest([{'role': 'store.name', 'expected': o_orderpriority}, {'role': 'title', 'expected': o_orderstatus}, {'role': 'menu.nm', 'expected': 'item ' || o_custkey}, {'role': 'total.grand', 'expected': o_custkey::VARCHAR}], recursive := true) FROM orders
""")
def expected_fields(t, spark):
    text = F.to_json(F.struct(F.struct(F.create_map(F.lit("name"), F.col("o_orderpriority")).alias("store"), F.col("o_orderstatus").alias("title"), F.array(F.struct(F.concat(F.lit("item "), F.col("o_custkey").cast("string")).alias("nm"), F.lit(" ").alias("price"))).alias("menu"), F.create_map(F.lit("grand"), F.col("o_custkey").cast("string")).alias("total")).alias("gt_parse")))
    parsed = F.from_json(text, proof.GROUND_TRUTH)["gt_parse"]
    return t("orders").select("o_orderkey", F.explode(proof.fields(parsed)).alias("f")).select("o_orderkey", "f.*")


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 1000 = o_orderkey % 1000 THEN 1 ELSE 2 END::INT AS money_total, CASE WHEN o_custkey % 1000 = o_orderkey % 1000 THEN 1 ELSE 1 END::INT AS money_exact FROM orders
""")
def money_exact(t, spark):
    amount = lambda c: F.concat((F.col(c) % 1000).cast("string"), F.lit(".000"))
    field = F.array(*[F.struct(F.lit(r).alias("role"), e.alias("expected")) for r, e in (("total", amount("o_custkey")), ("paid", amount("o_orderkey")), ("again", amount("o_custkey")), ("name", F.lit("a shop")))])
    rows = t("orders").select("o_orderkey", field.alias("f"), F.concat(F.lit("sum "), amount("o_custkey"), F.lit(" paid none")).alias("read"))
    return proof.money_read(rows, "o_orderkey", "f", "read")


@query("""
WITH c AS (SELECT source, list_sort(list(DISTINCT lang)) AS layouts FROM documents GROUP BY source), a AS (SELECT layouts FROM c ORDER BY source LIMIT 1)
SELECT c.source, [x FOR x IN c.layouts IF NOT list_contains(a.layouts, x)] AS more, [x FOR x IN a.layouts IF NOT list_contains(c.layouts, x)] AS less, CASE WHEN c.layouts <> a.layouts THEN 1 ELSE 0 END + CASE WHEN c.source LIKE '%1%' THEN 1 ELSE 0 END AS refused FROM c, a
""")
def comparable_reports(t, spark):
    images = t("documents").where("source is not null").withColumn("engine", F.when(F.col("source").contains("1"), "b").otherwise("a")).withColumn("psm", F.lit(4))
    report = proof.conditions(images, "source", "lang", ["engine", "psm"])
    first = report.orderBy("source").limit(1).select(F.struct("layouts", F.lit("a").alias("engine"), "psm").alias("a"))
    both = report.join(F.broadcast(first))
    why = proof.refusals(F.col("a"), F.struct("layouts", "engine", "psm"), ["engine", "psm"])
    return both.select("source", F.array_except("layouts", "a.layouts").alias("more"), F.array_except("a.layouts", "layouts").alias("less"), F.size(why).alias("refused"))


@query("""
WITH a AS (SELECT lang, avg(n_chars) AS before FROM documents WHERE doc_id % 2 = 0 AND lang <> 'fr' GROUP BY lang), b AS (SELECT lang, avg(n_chars) AS after FROM documents WHERE doc_id % 2 = 1 AND lang <> 'es' GROUP BY lang)
SELECT lang, before, after, round(before - after, 4) AS drop, CASE WHEN before IS NULL THEN 'after' WHEN after IS NULL THEN 'before' END AS only FROM a FULL JOIN b USING (lang)
""")
def report_drops(t, spark):
    mean = lambda d: d.groupBy("lang").agg(F.avg("n_chars").alias("v"))
    d = t("documents")
    return proof.drops(mean(d.where("doc_id % 2 = 0 and lang <> 'fr'")), mean(d.where("doc_id % 2 = 1 and lang <> 'es'")), "lang", "v")


# --- inspections ---

_BOXES = "SELECT o_orderkey, 'store.name' AS kind, o_orderpriority AS text, 0 AS pos FROM orders UNION ALL SELECT o_orderkey, 'total.label', o_orderstatus, 1 FROM orders UNION ALL SELECT o_orderkey, 'total.label', CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'x  y' END, 2 FROM orders"


def _boxes(t):
    o = t("orders")
    second = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise("x  y")
    box = lambda kind, text, pos: F.struct(F.lit(kind).alias("kind"), text.alias("text"), F.lit(pos).alias("pos"))
    return o.select("o_orderkey", F.explode(F.array(box("store.name", F.col("o_orderpriority"), 0), box("total.label", F.col("o_orderstatus"), 1), box("total.label", second, 2))).alias("b")).select("o_orderkey", "b.*")


def _label_leaves(t):
    o = t("orders")
    leaf = lambda path, value: F.struct(F.lit(path).alias("path"), value.alias("leaf"))
    return o.select("o_orderkey", F.explode(F.array(leaf("store.name", F.col("o_orderpriority")), leaf("total.grand", F.lit("x y")), leaf("menu.nm", F.col("o_custkey").cast("string")), leaf("note", F.lit(" ")))).alias("x")).select("o_orderkey", "x.*")


@query("""
SELECT o_orderkey, 'total' AS field, 'x y' AS value, true AS budgeted FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'menu.nm', o_custkey::VARCHAR, false FROM orders WHERE NOT contains(o_orderpriority || ' ' || o_orderstatus || ' ' || CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'x y' END, o_custkey::VARCHAR)
""")
def unprinted_labels(t, spark):
    return inspect.unprinted(_label_leaves(t), inspect.page_text(_boxes(t), "o_orderkey"), "o_orderkey", ["total"])


@query("SELECT o_orderkey, o_orderstatus AS label, 2::BIGINT AS n FROM orders WHERE o_orderkey % 3 = 0")
def doubled_totals(t, spark):
    boxes = _boxes(t).withColumn("kind", F.when(F.col("kind") == "total.label", "total.line.label").otherwise(F.col("kind")))
    return inspect.doubled_labels(boxes, "o_orderkey")


@query("""
WITH u AS (SELECT o_orderstatus AS layout, count(*) AS n, count(*) FILTER (o_orderkey % 3 = 0) AS gone FROM orders GROUP BY 1)
SELECT layout, 'total' AS field, n AS occurrences, gone AS unprinted, round(gone / n::DOUBLE, 6) AS share, 0.2::DOUBLE AS budget FROM u WHERE gone >= 5 AND round(gone / n::DOUBLE, 6) > 0.2 AND layout <> 'P'
""")
def label_budgets(t, spark):
    leaves = _label_leaves(t)
    lost = inspect.unprinted(leaves, inspect.page_text(_boxes(t), "o_orderkey"), "o_orderkey", ["total"])
    tallies = inspect.tally(leaves, lost, "o_orderkey", t("orders").select("o_orderkey", F.col("o_orderstatus").alias("layout")))
    return inspect.over_budget(tallies, {"total": 0.2}, {"P": ["total"]})


@query("""
WITH s AS (SELECT l_orderkey AS k, sum(l_quantity) AS line_sum FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN line_sum + 2 ELSE line_sum END AS sub, 100.0 AS paid, 60.0 AS grand, CASE WHEN o_orderkey % 5 = 0 THEN 30.0 ELSE 40.0 END AS change FROM orders JOIN s ON k = o_orderkey)
SELECT k AS o_orderkey, 'subtotal' AS "check", -2.0::DOUBLE AS off FROM o WHERE k % 4 = 0 UNION ALL SELECT k, 'change', 10.0 FROM o WHERE k % 5 = 0
""")
def totals_arithmetic(t, spark):
    sums = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("line_sum"))
    k = F.col("o_orderkey")
    totals = t("orders").join(sums, "o_orderkey").select("o_orderkey", (F.col("line_sum") + F.when(k % 4 == 0, 2.0).otherwise(0.0)).alias("subtotal"), F.lit(60.0).alias("grand"), F.lit(100.0).alias("paid"), F.when(k % 5 == 0, 30.0).otherwise(40.0).alias("change"))
    return inspect.totals_off(totals, sums, "o_orderkey")


@query("""
SELECT conv_id, turn, CASE WHEN turn % 7 = 3 THEN 'glyph' WHEN trim(coalesce(text, '')) = '' THEN 'blank' END AS fault FROM conversations WHERE turn % 7 = 3 OR trim(coalesce(text, '')) = ''
""")
def bad_glyphs(t, spark):
    text = F.when(F.col("turn") % 7 == 3, F.concat(F.coalesce("text", F.lit("")), F.lit("�"))).otherwise(F.col("text"))
    return inspect.bad_glyphs(t("conversations").select("conv_id", "turn", text.alias("text")), "text").select("conv_id", "turn", "fault")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity + 10 > 51 OR l_discount * 100 + 5 > 13")
def out_of_frame(t, spark):
    q, d = F.col("l_quantity"), F.col("l_discount") * 100
    boxes = t("lineitem").select("l_orderkey", "l_linenumber", q.alias("x0"), (q + 10).alias("x1"), d.alias("y0"), (d + 5).alias("y1"), F.lit(50).alias("w"), F.lit(12).alias("h"))
    return inspect.outside(boxes, "w", "h").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, unnest(CASE WHEN c_custkey % 2 = 0 THEN ['layout'] ELSE ['layout', 'visual'] END) AS attribute FROM customer")
def missing_attributes(t, spark):
    k = F.col("c_custkey")
    have = F.map_from_arrays(F.when(k % 2 == 0, F.array(F.lit("document"), F.lit("visual"))).otherwise(F.array(F.lit("document"))), F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))))
    return inspect.missing_attributes(t("customer").select("c_custkey", have.alias("attributes")), "c_custkey", ["document", "layout", "visual"])


@query(r"SELECT char, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(string_split(regexp_replace(text, '\s+', '', 'g'), '')) AS char FROM documents) WHERE char <> '' GROUP BY char")
def printable_characters(t, spark):
    return inspect.printable(t("documents").dropDuplicates(["doc_id"]), "text")


@query("""
WITH c AS (SELECT char, count(*) AS n FROM (SELECT DISTINCT item_id, unnest(string_split(regexp_replace(text, '\\s+', '', 'g'), '')) AS char FROM benchmark) WHERE char <> '' GROUP BY char)
SELECT 'ascii' AS font, char, n FROM c WHERE NOT unicode(char) BETWEEN 33 AND 126 UNION ALL SELECT 'latin', char, n FROM c WHERE NOT (unicode(char) BETWEEN 65 AND 122 OR unicode(char) BETWEEN 192 AND 255)
""")
def font_gaps(t, spark):
    fonts = spark.createDataFrame([("ascii", 33, 126), ("latin", 65, 122), ("latin", 192, 255)], "font string, low int, high int")
    return inspect.uncovered(inspect.printable(t("benchmark"), "text"), fonts)


@query("SELECT l_orderkey, sum(l_quantity) AS used, 100.0::DOUBLE AS limit, round(sum(l_quantity) - 100.0, 6) AS over FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 100")
def sheet_overflow(t, spark):
    return inspect.overflowing(t("lineitem").withColumn("height", F.lit(100.0)), "l_orderkey", "l_quantity", "height")


# --- baselines ---


@query("SELECT path, sha256(text) AS sha FROM (SELECT source || '/' || doc_id AS path, coalesce(text, '') AS text FROM documents)")
def file_digests(t, spark):
    files = t("documents").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.coalesce("text", F.lit("")).alias("content"))
    return baseline.file_digests(files.where("path is not null"))


@query("SELECT 'rules' AS family, count(*) AS n, sha256(string_agg(sha256(n_nationkey || chr(0) || n_name), '' ORDER BY n_nationkey)) AS digest FROM nation")
def input_family(t, spark):
    return baseline.family(t("nation"), "rules", ["n_nationkey"], "n_name")


@query("SELECT attr, id, '{\"attr\":\"' || attr || '\",\"excludes\":' || CASE WHEN id = 'wide' THEN '[\"short\"]' ELSE '[]' END || ',\"group\":\"\",\"id\":\"' || id || '\"}' AS line FROM (VALUES ('layout', 'wide'), ('augmentation', 'none'), ('augmentation', 'aged')) AS x(attr, id)")
def canonical_rules(t, spark):
    options = rule_files.table(spark, RULES)[0].where("attr <> 'document'").select("attr_pos", "attr", "opt_pos", "id", "excludes", "group")
    return baseline.lines(options, ["wide"])


@query("""
SELECT p.plan, f.field, f.was, f.now FROM (SELECT 'p' || c_custkey AS plan, c_custkey AS k FROM customer) p, LATERAL (VALUES
  ('plan', CASE WHEN k % 5 = 0 THEN 'there' END, CASE WHEN k % 5 = 1 THEN 'there' END, k % 5 < 2), ('seed', k::VARCHAR, (k + 1)::VARCHAR, k % 5 = 2)) AS f(field, was, now, hit) WHERE f.hit
""")
def plan_moves(t, spark):
    k = F.col("c_custkey")
    plan = F.concat(F.lit("p"), k.cast("string"))
    of = lambda drop, seed: t("customer").where(k % 5 != drop).select(plan.alias("plan"), F.explode(F.create_map(F.lit("seed"), seed.cast("string"), F.lit("pairing"), F.lit("paired"))).alias("field", "value"))
    return baseline.input_changes(of(1, k), of(0, F.when(k % 5 == 2, k + 1).otherwise(k)))


@query("""
SELECT 'p' || n_regionkey AS plan, CASE WHEN n_regionkey = 0 THEN 'moved' ELSE 'regressed' END AS verdict, CASE WHEN n_regionkey = 0 THEN 1 ELSE count(*) FILTER (n_nationkey % 3 = 0) END AS n FROM nation GROUP BY n_regionkey HAVING n_regionkey = 0 OR count(*) FILTER (n_nationkey % 3 = 0) > 0
""")
def baseline_verdicts(t, spark):
    n = t("nation").select(F.concat(F.lit("p"), F.col("n_regionkey").cast("string")).alias("plan"), F.lit("image").alias("kind"), F.col("n_name").alias("name"), F.sha2("n_name", 256).alias("sha"), "n_nationkey")
    changed = n.withColumn("sha", F.when(F.col("n_nationkey") % 3 == 0, "x").otherwise(F.col("sha")))
    outputs = baseline.output_changes(n, changed)
    inputs = spark.createDataFrame([("p0", "seed", "1", "2")], "plan string, field string, was string, now string")
    return baseline.verdicts(inputs, outputs)


@query("SELECT kind, name, n FROM (SELECT 'backend' AS kind, source AS name, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT 'layout', lang, count(*) FROM documents GROUP BY lang)")
def record_counts(t, spark):
    return baseline.counted(t("documents"), "source", "lang")


# --- costs ---

_REPORT = "SELECT 'b' || user_id % 3 AS backend, user_id % 6 AS process, CASE event_id % 4 WHEN 0 THEN 'startup' WHEN 1 THEN 'draw' WHEN 2 THEN 'age' ELSE 'age/' || event_type END AS path, 1 AS calls, value AS inclusive FROM events"


def _report(t):
    e = F.col("event_id") % 4
    path = F.when(e == 0, "startup").when(e == 1, "draw").when(e == 2, "age").otherwise(F.concat(F.lit("age/"), F.col("event_type")))
    return t("events").select(F.concat(F.lit("b"), (F.col("user_id") % 3).cast("string")).alias("backend"), (F.col("user_id") % 6).alias("process"), path.alias("path"), F.lit(1).alias("calls"), F.col("value").alias("inclusive"))


_MODEL = f"""
WITH r AS ({_REPORT}), i AS (SELECT backend, count(*) AS images FROM r GROUP BY backend),
m AS (SELECT r.backend, path AS stage, CASE WHEN path = 'startup' THEN 'process' ELSE 'image' END AS kind, round(CASE WHEN path = 'startup' THEN sum(inclusive) / count(DISTINCT process) ELSE sum(inclusive) / max(images) END, 6) AS seconds FROM r JOIN i USING (backend) WHERE NOT contains(path, '/') GROUP BY r.backend, path)
"""


def _model(t):
    r = _report(t)
    return costs.model(r, r.groupBy("backend").agg(F.count("*").alias("images")), ["startup"])


@query(_MODEL + "SELECT backend, stage, kind, round(seconds, 4) AS seconds FROM m")
def cost_model(t, spark):
    return _model(t).withColumn("seconds", F.round("seconds", 4))


@query(_MODEL + "SELECT backend, 100::BIGINT AS images, 3::BIGINT AS processes, round(sum(CASE WHEN kind = 'image' THEN seconds * 100 ELSE seconds * 3 END), 2) AS seconds FROM m GROUP BY backend")
def predicted_run(t, spark):
    m = _model(t)
    work = m.select("backend").distinct().select("backend", F.lit(100).cast("bigint").alias("images"), F.lit(3).cast("bigint").alias("processes"))
    return costs.predicted(m, work).withColumn("seconds", F.round("seconds", 2))


@query(f"SELECT substr(path, 5) AS name, count(*) AS calls, round(sum(inclusive), 4) AS seconds, round(sum(inclusive) / count(*), 4) AS per_call FROM ({_REPORT}) WHERE path LIKE 'age/%' GROUP BY 1")
def pooled_calls(t, spark):
    return costs.pooled(_report(t), "age").withColumn("seconds", F.round("seconds", 4)).withColumn("per_call", F.round("per_call", 4))


@query(f"WITH w AS (SELECT process, sum(inclusive) FILTER (NOT contains(path, '/')) AS a, count(*) * 60.0::DOUBLE AS wall FROM ({_REPORT}) GROUP BY process) SELECT process, wall, round(a, 4) AS attributed, round(greatest(wall - a, 0), 4) AS rest FROM w")
def unattributed_seconds(t, spark):
    r = _report(t)
    out = costs.unattributed(r, r.groupBy("process").agg((F.count("*") * 60.0).alias("wall")))
    return out.withColumn("attributed", F.round("attributed", 4)).withColumn("rest", F.round("rest", 4))


@query(_PLAN + ", g AS (SELECT backend, shard, count(*) AS runs, sum(count) AS images FROM s GROUP BY ALL) SELECT backend, count(*) AS processes, sum(runs)::BIGINT AS was, sum(images)::BIGINT AS images FROM g GROUP BY backend")
def plan_shape(t, spark):
    return costs.shape(_plan(t, spark))


@query(_PLAN + """, g AS (SELECT backend, shard, count(*) AS runs, sum(count) AS images FROM s GROUP BY ALL), h AS (SELECT backend, count(*) AS p, sum(runs) AS w, sum(images) AS i FROM g GROUP BY backend)
SELECT backend, i::BIGINT AS images, round(i * 0.5 + p * 2.0, 6)::DOUBLE AS now, round(i * 0.5 + w * 2.0, 6)::DOUBLE AS before, round(1 - (i * 0.5 + p * 2.0)::DOUBLE / (i * 0.5 + w * 2.0)::DOUBLE, 6) AS saved FROM h""")
def plan_savings(t, spark):
    plan = _plan(t, spark)
    costs_ = plan.select("backend").distinct().select("backend", F.explode(F.array(F.struct(F.lit("draw").alias("stage"), F.lit("image").alias("kind"), F.lit(0.5).alias("seconds")), F.struct(F.lit("startup").alias("stage"), F.lit("process").alias("kind"), F.lit(2.0).alias("seconds")))).alias("c")).select("backend", "c.*")
    return costs.saved(costs_, costs.shape(plan))


@query(f"WITH x AS (SELECT backend, path, sum(inclusive) AS s FROM ({_REPORT}) WHERE NOT contains(path, '/') GROUP BY ALL) SELECT backend, max_by(path, (s, path)) AS path, round(max(s), 4) AS seconds, round(max(s) / sum(s), 4) AS share FROM x GROUP BY backend")
def dearest_stage(t, spark):
    return costs.dearest(costs.roots(_report(t)), "backend", "path", "inclusive").withColumn("seconds", F.round("seconds", 4)).withColumn("share", F.round("share", 4))


# --- labels ---

_LABELS = "SELECT event_id, unnest(['B-' || upper(event_type), ' I-LOC ', 'O', 'I-' || upper(event_type), 'B-9', 'x']) AS label FROM events"


def _labels(t):
    up = F.upper("event_type")
    return t("events").select("event_id", F.explode(F.array(F.concat(F.lit("B-"), up), F.lit(" I-LOC "), F.lit("O"), F.concat(F.lit("I-"), up), F.lit("B-9"), F.lit("x"))).alias("label"))


@query(rf"""
SELECT event_id, label, regexp_matches(label, '^\s*B-([a-zA-Z|]+)\s*$') AS begins, regexp_matches(label, '^\s*I-([a-zA-Z|]+)\s*$') AS inside,
  CASE WHEN regexp_matches(label, '^\s*I-([a-zA-Z|]+)\s*$') THEN replace(trim(label), 'I-', 'B-') ELSE label END AS to_begin, CASE WHEN regexp_matches(label, '^\s*B-([a-zA-Z|]+)\s*$') THEN 'I-' || substr(trim(label), 3) ELSE label END AS to_inside,
  CASE WHEN regexp_matches(label, '^\s*[BI]-([a-zA-Z|]+)\s*$') THEN trim(label) ELSE label END AS clean FROM ({_LABELS})
""")
def label_forms(t, spark):
    x = F.col("label")
    return _labels(t).select("event_id", "label", labels.is_begin(x).alias("begins"), labels.is_inside(x).alias("inside"), labels.to_begin(x).alias("to_begin"), labels.to_inside(x).alias("to_inside"), labels.clean(x).alias("clean"))


@query("SELECT item_id, list_sort([chr(c::INT) FOR c IN range(33, 127) IF NOT contains(text, chr(c::INT))]) AS candidates FROM benchmark")
def gap_candidates(t, spark):
    return t("benchmark").select("item_id", F.array_sort(labels.gap_candidates(F.col("text"))).alias("candidates"))


@query("SELECT o_orderkey, rpad('B-PER', 6, ' ') || rpad('O', (length(o_orderpriority) + 1)::INT, ' ') || chr(10) || rpad(o_orderstatus, 6, ' ') || rpad(o_orderpriority, (length(o_orderpriority) + 1)::INT, ' ') AS shown FROM orders")
def label_display(t, spark):
    return t("orders").select("o_orderkey", labels.display(F.array("o_orderstatus", "o_orderpriority"), F.array(F.lit("B-PER"), F.lit("O"))).alias("shown"))


_WORDS = r"SELECT item_id, regexp_split_to_array(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS w FROM benchmark WHERE length(trim(text)) > 0"


@query(f"""
WITH d AS ({_WORDS}), n AS (SELECT item_id, [x || 'q' FOR x IN w] AS noise, w, [s FOR s IN range(0, len(w), 9)] AS starts FROM d)
SELECT item_id, (k)::INT AS sent, starts[k + 1]::INT AS first, coalesce(starts[k + 2], len(w))::INT AS last, noise[starts[k + 1] + 1:coalesce(starts[k + 2], len(w))] AS tokens FROM n, (SELECT unnest(range(0, 2000)) AS k) WHERE k < len(starts)
""")
def projected_sentences(t, spark):
    w = T.split_words(F.col("text"))
    docs = t("benchmark").select("item_id", w.alias("gt")).where(F.size("gt") > 0)
    docs = docs.withColumn("noise", F.transform("gt", lambda x: F.concat(x, F.lit("q")))).withColumn("starts", F.sequence(F.lit(0), F.size("gt") - 1, F.lit(9)))
    return labels.projected_sentences(docs, "item_id")


@query(r"""
WITH l AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id) AS x, unnest(string_split(text, chr(10))) AS value, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM (SELECT DISTINCT doc_id, text FROM documents)),
f AS (SELECT doc_id, i, trim(value) = '' AS blank, coalesce(lag(trim(value) = '') OVER (PARTITION BY doc_id ORDER BY i), true) AS before FROM l),
g AS (SELECT doc_id, i, blank OR i % 5 = 0 AS blank, coalesce(lag(blank OR i % 5 = 0) OVER (PARTITION BY doc_id ORDER BY i), true) AS before FROM f)
SELECT f.doc_id, c AS clean, n AS noisy, d AS doubles FROM (SELECT doc_id, count(*) FILTER (NOT blank AND before) AS c FROM f GROUP BY doc_id) f JOIN (SELECT doc_id, count(*) FILTER (NOT blank AND before) AS n, count(*) FILTER (blank AND before) AS d FROM g GROUP BY doc_id) g USING (doc_id) WHERE c <> n OR d > 0
""")
def sentence_mismatches(t, spark):
    docs = t("documents").select("doc_id", "text").distinct()
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value"))
    noisy = lines.withColumn("value", F.when((F.col("line_no") + 1) % 5 == 0, "").otherwise(F.col("value")))
    return labels.sentence_mismatches(lines, noisy, "doc_id")


@query("""
WITH RECURSIVE g AS (SELECT l_orderkey, l_linenumber, sum(l_quantity)::BIGINT AS q FROM lineitem GROUP BY ALL), s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS i FROM g),
p AS (SELECT l_orderkey, l_linenumber, i, q AS used, 0 AS page FROM s WHERE i = 1
      UNION ALL SELECT s.l_orderkey, s.l_linenumber, s.i, CASE WHEN p.used + s.q > 60 THEN s.q ELSE p.used + s.q END, p.page + CASE WHEN p.used > 0 AND p.used + s.q > 60 THEN 1 ELSE 0 END FROM p JOIN s ON s.l_orderkey = p.l_orderkey AND s.i = p.i + 1)
SELECT l_orderkey, l_linenumber, page::INT AS page FROM p JOIN lineitem USING (l_orderkey, l_linenumber)
""")
def packed_pages(t, spark):
    return labels.packed(t("lineitem"), "l_orderkey", "l_linenumber", "l_quantity", 60).select("l_orderkey", "l_linenumber", "page")


@query(r"""
WITH w AS (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM benchmark), x AS (SELECT item_id, t, regexp_split_to_array(t, ' ') AS a FROM w)
SELECT item_id, length(t)::INT AS total_chars, len(a)::INT AS total_words, len([y FOR y IN a IF regexp_matches(y, '[\p{L}\p{N}_]')])::INT AS total_alnum_words, (length(t) - length(regexp_replace(t, '[^e]', '', 'g')))::INT AS matching_chars, len([y FOR y IN a IF NOT contains(y, 'e')])::INT AS matching_words, len([y FOR y IN a IF NOT contains(y, 'e') AND regexp_matches(y, '[\p{L}\p{N}_]')])::INT AS matching_alnum_words FROM x
""")
def word_statistics(t, spark):
    clean = T.trimmed(F.col("text"))
    return t("benchmark").select("item_id", labels.word_matches(clean, F.translate(clean, "e", "ß")).alias("s")).select("item_id", "s.*")


@query("SELECT item_id, replace(text, 'e', '') AS common FROM benchmark")
def common_text(t, spark):
    return t("benchmark").select("item_id", labels.common_subsequence(F.translate("text", "e", ""), F.translate("text", "e", "ß")).alias("common"))


# --- text kernels ---


@query("SELECT o_orderkey, [substr(x, 1, 3), substr(x, 4, 2), substr(x, 6)] AS pieces FROM (SELECT o_orderkey, replace(o_orderpriority || ' ' || o_orderkey, ' ', '') AS x FROM orders)")
def split_pieces(t, spark):
    return t("orders").select("o_orderkey", T.split_like(F.concat_ws(" ", "o_orderpriority", F.col("o_orderkey").cast("string")), F.array(F.lit(3), F.lit(2), F.lit(1))).alias("pieces"))


@query("SELECT item_id, list_sort(list_distinct([c FOR c IN string_split(regexp_replace(text, '\\s+', '', 'g'), '') IF NOT contains('abcdefghijklmnopqrstuvwxyz', c)])) AS missing FROM benchmark")
def missing_characters(t, spark):
    return t("benchmark").select("item_id", T.missing_characters(F.col("text"), F.lit("abcdefghijklmnopqrstuvwxyz")).alias("missing"))


@query("SELECT p_partkey, (11 - list_sum([substr(c, i::INT, 1)::INT * [31, 29, 23, 19, 17, 13, 7, 5, 3][i::INT] FOR i IN range(1, 10)]) % 11) % 11 AS digit, upper(left(p_name, 5)) AS name FROM (SELECT p_partkey, p_name, lpad(p_partkey::VARCHAR, 9, '0') AS c FROM part)")
def tax_code_digits(t, spark):
    code = F.lpad(F.col("p_partkey").cast("string"), 9, "0")
    return t("part").select("p_partkey", T.check_digits(code, (31, 29, 23, 19, 17, 13, 7, 5, 3)).cast("bigint").alias("digit"), T.cased(T.fitted(F.col("p_name"), 5), True, True).alias("name"))


@query("SELECT event_id, [regexp_matches(x, '^/?[.!?]+$') FOR x IN ['.', '/!', '?!', 'a.', event_type]] AS ends, 'a ' || event_type || ' b' AS joined FROM events")
def token_separators(t, spark):
    xs = F.array(F.lit("."), F.lit("/!"), F.lit("?!"), F.lit("a."), F.col("event_type"))
    return t("events").select("event_id", F.transform(xs, T.is_separator).alias("ends"), T.joined(F.array(F.lit("a"), F.lit(" "), F.col("event_type"), F.lit(""), F.lit("b"))).alias("joined"))


# --- page layout: each order as a bill of 60 columns ---

NCOLS = 60
COLUMNS = layout.columns_of([{"key": "no", "title": "No", "width": 5}, {"key": "name", "title": "Name of the goods", "width": 14}, {"key": "note", "title": "Status"}, {"key": "amount", "title": "Amount", "width": 14, "align": "right"}], NCOLS)
TEMPLATE = [[{"col": "no"}, {"col": "name"}, {"col": "note"}, {"col": "amount"}]]
VALUES = {"no": lambda e: e["no"], "name": lambda e: e["name"], "note": lambda e: e["note"], "amount": lambda e: e["amount"]}
_CELL = "text, role, row, col0, col1, align, scale, bold"


def _bills(t):
    """(o_orderkey, store, title, meta, entries, totals, footer): orders with their lines in one nested row."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_linenumber").cast("string").alias("no"), F.concat(F.lit("part "), F.col("l_partkey").cast("string"), F.lit(" of "), F.col("l_suppkey").cast("string")).alias("name"), F.col("l_linestatus").alias("note"), F.format_number(F.col("l_extendedprice"), 0).alias("amount"))
    items = t("lineitem")
    lines = items.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(line)).alias("entries"), F.bround(stats.sum_in_order(items, F.col("l_extendedprice")), 0).alias("sum"))
    pair = lambda a, b: F.struct(F.lit(a).alias("label"), b.alias("value"))
    store = F.struct(F.concat(F.lit("Shop "), F.col("o_custkey").cast("string")).alias("name"), F.lit("").alias("branch"), F.col("o_orderpriority").alias("address"), F.lit(None).cast("string").alias("address2"), F.lit("0123").alias("phone"), F.lit("").alias("website"), F.col("o_orderstatus").alias("tax_code"), F.lit("").alias("account"))
    rows = t("orders").join(lines, "o_orderkey")
    return rows.select(
        "o_orderkey", store.alias("store"), F.col("o_orderstatus").alias("title"), "entries",
        F.array(pair("Order:", F.col("o_orderkey").cast("string")), pair("By:", F.col("o_orderpriority")), pair("State:", F.col("o_orderstatus"))).alias("meta"),
        F.array(pair("Sum", F.format_number("sum", 0)), pair("To pay", F.format_number("sum", 0))).alias("totals"),
        F.array(F.lit("Thank you"), F.concat(F.lit("Bill "), F.col("o_orderkey").cast("string"))).alias("footer"),
    )


def _cells(df, s):
    return df.select("o_orderkey", F.explode(s["cells"]).alias("c")).select("o_orderkey", "c.*")


@query("""
SELECT o_orderkey, x.* FROM (SELECT o_orderkey, unnest([
  {'text': 'Order:', 'role': 'meta.label', 'row': 0, 'col0': 0, 'col1': 59 - length(o_orderkey::VARCHAR), 'align': 'left', 'scale': 1.0::DOUBLE, 'bold': false}, {'text': o_orderkey::VARCHAR, 'role': 'meta.value', 'row': 0, 'col0': 59 - length(o_orderkey::VARCHAR), 'col1': 60, 'align': 'right', 'scale': 1.0::DOUBLE, 'bold': false},
  {'text': 'By:', 'role': 'meta.label', 'row': 1, 'col0': 0, 'col1': 59 - length(o_orderpriority), 'align': 'left', 'scale': 1.0::DOUBLE, 'bold': false}, {'text': o_orderpriority, 'role': 'meta.value', 'row': 1, 'col0': 59 - length(o_orderpriority), 'col1': 60, 'align': 'right', 'scale': 1.0::DOUBLE, 'bold': false},
  {'text': 'State:', 'role': 'meta.label', 'row': 2, 'col0': 0, 'col1': 58, 'align': 'left', 'scale': 1.0::DOUBLE, 'bold': false}, {'text': o_orderstatus, 'role': 'meta.value', 'row': 2, 'col0': 58, 'col1': 60, 'align': 'right', 'scale': 1.0::DOUBLE, 'bold': false}]) AS x FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
""")
def grid_meta_pairs(t, spark):
    return _cells(_bills(t), layout.meta(F.col("meta"), NCOLS))


@query("""
WITH m AS (SELECT o_orderkey, 'Order: ' || o_orderkey AS a, 'By: ' || o_orderpriority AS b, 'State: ' || o_orderstatus AS c FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
f AS (SELECT *, length(a) + length(b) + 2 <= 24 AS ab, length(b) + length(c) + 2 <= 24 AS bc FROM m)
SELECT o_orderkey, a AS text, 'meta' AS role, 0 AS row, 0 AS col0, (CASE WHEN ab THEN 23 - length(b) ELSE 23 END)::INT AS col1, 'left' AS align, 1.0::DOUBLE AS scale, false AS bold FROM f
UNION ALL SELECT o_orderkey, b, 'meta', CASE WHEN ab THEN 0 ELSE 1 END, CASE WHEN ab THEN 24 - length(b) ELSE 0 END, CASE WHEN ab THEN 24 WHEN bc THEN 23 - length(c) ELSE 23 END, 'left', 1.0, false FROM f
UNION ALL SELECT o_orderkey, c, 'meta', CASE WHEN ab OR bc THEN 1 ELSE 2 END, CASE WHEN NOT ab AND bc THEN 24 - length(c) ELSE 0 END, CASE WHEN NOT ab AND bc THEN 24 ELSE 23 END, 'left', 1.0, false FROM f
""")
def grid_meta_columns(t, spark):
    return _cells(_bills(t), layout.meta(F.col("meta"), 24, "two_column"))


_ITEMS = """
l AS (SELECT l_orderkey AS o_orderkey, l_linenumber AS i, 'part ' || l_partkey || ' of ' || l_suppkey AS name, l_linestatus AS note, format('{:,}', round_even(l_extendedprice, 0)::BIGINT) AS amount, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, 'part ' || l_partkey || ' of ' || l_suppkey, l_linestatus, format('{:,}', round_even(l_extendedprice, 0)::BIGINT)) AS i2 FROM lineitem),
h AS (SELECT *, CASE WHEN length(name) <= 13 THEN [name] WHEN length('part ' || split_part(name, ' ', 2) || ' of') <= 13 THEN ['part ' || split_part(name, ' ', 2) || ' of', split_part(name, ' ', 4)] ELSE ['part ' || split_part(name, ' ', 2), 'of ' || split_part(name, ' ', 4)] END AS lines FROM l),
r AS (SELECT *, coalesce(sum(len(lines)) OVER (PARTITION BY o_orderkey ORDER BY i2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS top FROM h)
"""


@query("WITH " + _ITEMS + """
SELECT o_orderkey, i::VARCHAR AS text, 'menu.no' AS role, top AS row, 0 AS col0, 4 AS col1, 'left' AS align, 1.0::DOUBLE AS scale, false AS bold FROM r
UNION ALL SELECT o_orderkey, lines[k + 1], 'menu.name', top + k, 5, 18, 'left', 1.0, false FROM r, (SELECT unnest([0, 1])::INT AS k) WHERE k < len(lines)
UNION ALL SELECT o_orderkey, note, 'menu.note', top, 19, 45, 'left', 1.0, false FROM r UNION ALL SELECT o_orderkey, amount, 'menu.amount', top, 46, 60, 'right', 1.0, false FROM r
""")
def grid_items(t, spark):
    return _cells(_bills(t), layout.items(F.col("entries"), VALUES, TEMPLATE, COLUMNS, NCOLS))


@query("WITH " + _ITEMS + ", s AS (SELECT o_orderkey, sum(len(lines))::INT AS height, count(*) AS n FROM r GROUP BY o_orderkey) SELECT o_orderkey, (height + 5)::INT AS height, (16 + n + 6 * height)::INT AS cells FROM s")
def grid_table(t, spark):
    s = layout.table(F.col("entries"), VALUES, TEMPLATE, COLUMNS, NCOLS)
    df = _bills(t).select("o_orderkey", s.alias("s"))
    return df.select("o_orderkey", F.col("s.height").alias("height"), F.size("s.cells").alias("cells"))


_SUMS = "s AS (SELECT l_orderkey AS o_orderkey, format('{:,}', round_even(sum(l_extendedprice), 0)::BIGINT) AS v FROM lineitem GROUP BY l_orderkey)"


@query(f"""
WITH {_SUMS}
SELECT o_orderkey, x.* FROM (SELECT o_orderkey, unnest([
 {{'text': 'Sum', 'role': 'total.line.label', 'row': 0, 'col0': 0, 'col1': 59 - length(v), 'align': 'left', 'scale': 1.0::DOUBLE, 'bold': false}}, {{'text': v, 'role': 'total.line', 'row': 0, 'col0': 59 - length(v), 'col1': 60, 'align': 'right', 'scale': 1.0::DOUBLE, 'bold': false}},
 {{'text': 'To pay', 'role': 'total.grand.label', 'row': 1, 'col0': 0, 'col1': 59 - length(v), 'align': 'left', 'scale': 1.5::DOUBLE, 'bold': true}}, {{'text': v, 'role': 'total.grand', 'row': 1, 'col0': 59 - length(v), 'col1': 60, 'align': 'right', 'scale': 1.5::DOUBLE, 'bold': true}}]) AS x FROM s)
""")
def grid_totals(t, spark):
    return _cells(_bills(t), layout.totals(F.col("totals"), F.lit(1), NCOLS, scale=1.5))


@query(f"""
WITH {_SUMS}
SELECT o_orderkey, [rpad('| Sum', 45, ' ') || '|' || lpad(v, 12, ' ') || ' |', '+' || repeat('-', 44) || '+' || repeat('-', 13) || '+', rpad('| To pay', 45, ' ') || '|' || lpad(v, 12, ' ') || ' |', '+' || repeat('-', 44) || '+' || repeat('-', 13) || '+'] AS lines FROM (SELECT o_orderkey, v FROM s)
""")
def grid_framed_totals(t, spark):
    s = layout.framed_totals(F.col("totals"), F.lit(1), NCOLS, 46)
    return _bills(t).select("o_orderkey", layout.printed(layout.grid([s], F.lit("x"), NCOLS)).alias("lines"))


@query("""
SELECT o_orderkey, lpad('Thank you', 34, ' ') AS first, repeat(' ', (60 - length('Bill ' || o_orderkey)) // 2) || 'Bill ' || o_orderkey AS second, 3 AS height FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def grid_footer(t, spark):
    s = layout.footer(F.col("footer"), NCOLS)
    df = _bills(t).select("o_orderkey", layout.grid([s], F.lit("x"), NCOLS).alias("g"))
    lines = layout.printed(F.col("g"))
    return df.select("o_orderkey", F.get(lines, 1).alias("first"), F.get(lines, 2).alias("second"), F.col("g.nrows").alias("height"))


@query("""
SELECT o_orderkey, 'Shop ' || o_custkey AS l0, 'Addr ' || o_orderpriority AS l1, 'Tax ' || o_orderstatus AS l2, '0123' AS l3, 'No ' || o_orderkey AS r0, 5 AS height FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def grid_letterhead(t, spark):
    invoice = F.struct(F.lit("").alias("form_no"), F.lit(None).cast("string").alias("serial"), F.col("o_orderkey").cast("string").alias("number"))
    s = layout.letterhead(F.col("store"), invoice, {"address": "Addr", "tax_code": "Tax", "number": "No"}, NCOLS, F.col("o_orderkey"))
    df = _bills(t).select("o_orderkey", layout.grid([s], F.lit("x"), NCOLS).alias("g"))
    lines = layout.printed(F.col("g"))
    left = lambda i: F.rtrim(F.substring(F.get(lines, i), 1, 34))
    return df.select("o_orderkey", *[left(i).alias(f"l{i}") for i in range(4)], F.substr(F.get(lines, 0), F.lit(35)).alias("r0"), F.col("g.nrows").alias("height"))


@query("""
SELECT o_orderkey, rpad('Order: ' || o_orderkey, 33, ' ') || 'By: ' || o_orderpriority AS line, 4 AS height FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def grid_parties(t, spark):
    s = layout.parties(F.col("meta"), F.slice("meta", 2, 1), NCOLS)
    df = _bills(t).select("o_orderkey", layout.grid([s], F.lit("x"), NCOLS).alias("g"))
    return df.select("o_orderkey", F.get(layout.printed(F.col("g")), 0).alias("line"), F.col("g.nrows").alias("height"))


@query("""
WITH p AS (SELECT o_orderkey, 'Order: ' || o_orderkey AS a, 'By: ' || o_orderpriority AS b, 'State: ' || o_orderstatus AS c FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
q AS (SELECT *, length(a) + 3 + length(b) <= 26 AS ab, CASE WHEN length(a) + 3 + length(b) <= 26 THEN length(a) + 3 + length(b) ELSE length(b) END + 3 + length(c) <= 26 AS bc FROM p)
SELECT o_orderkey, string_split(a || CASE WHEN ab THEN ' | ' ELSE chr(10) END || b || CASE WHEN bc THEN ' | ' ELSE chr(10) END || c || chr(10) || repeat('-', 26), chr(10)) AS lines FROM q
""")
def grid_strip(t, spark):
    s = layout.strip(F.col("meta"), 26)
    return _bills(t).select("o_orderkey", layout.printed(layout.grid([s], F.lit("x"), 26)).alias("lines"))


@query("""
SELECT o_orderkey, ['Total of order ' || o_orderkey, repeat(' ', (30 - 6) // 2) || 'Seller' || repeat(' ', 12 + (30 - 5) // 2) || 'Buyer', '', '', '', '', 'x' || o_orderstatus] AS shown FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def grid_words_and_signatures(t, spark):
    words = layout.words("  Total of", F.concat(F.lit("order "), F.col("o_orderkey").cast("string")), NCOLS)
    sign = lambda title, name: F.struct(F.lit(title).alias("title"), F.lit("").alias("hint"), name.alias("name"))
    s = layout.signatures(F.array(sign("Seller", F.concat(F.lit("x"), "title")), sign("Buyer", F.lit(""))), NCOLS)
    lines = layout.printed(layout.grid([words, s], F.lit("x"), NCOLS))
    df = _bills(t).select("o_orderkey", lines.alias("l"))
    shown = F.transform(F.filter("l", lambda x, i: i != 1), lambda x, i: F.when(i == 6, F.trim(x)).otherwise(x))
    return df.select("o_orderkey", F.slice(shown, 1, 7).alias("shown"))


@query("WITH " + _ITEMS + """
, s AS (SELECT o_orderkey, sum(len(lines))::INT AS height FROM r GROUP BY o_orderkey)
SELECT o_orderkey, (3 + 2 + height + 2 + 3)::INT AS nrows, (6 + 5 + 3 * n + height + 4 + 2)::INT AS cells, 0 AS overflow FROM s JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1) USING (o_orderkey)
""")
def grid_pages(t, spark):
    parts = [layout.meta(F.col("meta"), NCOLS), layout.column_header(COLUMNS), layout.items(F.col("entries"), VALUES, TEMPLATE, COLUMNS, NCOLS), layout.totals(F.col("totals"), F.lit(1), NCOLS), layout.footer(F.col("footer"), NCOLS)]
    df = _bills(t).select("o_orderkey", layout.grid(parts, F.lit("plain"), NCOLS).alias("g"))
    return df.select("o_orderkey", F.col("g.nrows").alias("nrows"), F.size("g.cells").alias("cells"), F.size(layout.overflow(F.col("g"))).alias("overflow"))


@query("""
SELECT o_orderkey, 'frame' AS kind, 2.0::DOUBLE AS row0, 0.0::DOUBLE AS col0, 5.0::DOUBLE AS row1, 59.0::DOUBLE AS col1, 1.8::DOUBLE AS weight, 1.0::DOUBLE AS tone FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT o_orderkey, 'fill', 2.0, 0.0, 5.0, 59.0, 1.0, 0.9 FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def grid_marks(t, spark):
    marks = layout.frame_marks(layout.meta(F.col("meta"), NCOLS), NCOLS, F.lit(2), 0.9)
    return _bills(t).select("o_orderkey", F.explode(marks).alias("m")).select("o_orderkey", "m.*")


@query("SELECT * FROM (VALUES ('No', 0, 4), ('Name of the', 5, 18), ('goods', 5, 18), ('Status', 19, 45), ('Amount', 46, 60)) AS h(text, col0, col1)")
def grid_column_header(t, spark):
    s = layout.column_header(COLUMNS)
    return spark.range(1).select(F.explode(s["cells"]).alias("c")).select("c.text", "c.col0", "c.col1")


# --- sheets ---

SHEET = [{"key": "no", "title": "No", "align": "center"}, {"key": "name", "title": "Goods & more"}, {"key": "amount", "title": "Amount", "align": "right"}]


@query("WITH " + _ITEMS + """
, b AS (SELECT o_orderkey, count(*) AS n, string_agg('<tr><td data-cell="menu.no" data-row="' || i2 || '" data-col="0" class="c"><span data-kind="menu.no">' || i || '</span></td><td data-cell="menu.name" data-row="' || i2 || '" data-col="1"><span data-kind="menu.name">' || name || '</span></td><td data-cell="menu.amount" data-row="' || i2 || '" data-col="2" class="r"><span data-kind="menu.amount">' || amount || '</span></td></tr>', '' ORDER BY i2) AS body FROM r GROUP BY o_orderkey),
s AS (SELECT l_orderkey AS o_orderkey, format('{:,}', round_even(sum(l_extendedprice), 0)::BIGINT) AS v FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, '<table class="items"><thead><tr><th data-cell="colhdr" data-row="0" data-col="0" class="c"><span data-kind="colhdr">No</span></th><th data-cell="colhdr" data-row="0" data-col="1"><span data-kind="colhdr">Goods &amp; more</span></th><th data-cell="colhdr" data-row="0" data-col="2" class="r"><span data-kind="colhdr">Amount</span></th></tr></thead><tbody>' || body ||
 '<tr class="total"><td data-cell="total.line.label" data-row="' || n + 1 || '" data-col="0" colspan="2" class="tlabel"><span data-kind="total.line.label">Sum</span></td><td data-cell="total.line" data-row="' || n + 1 || '" data-col="2" class="r"><span data-kind="total.line">' || v || '</span></td></tr><tr class="grand"><td data-cell="total.grand.label" data-row="' || n + 2 || '" data-col="0" colspan="2" class="tlabel"><span data-kind="total.grand.label">To pay</span></td><td data-cell="total.grand" data-row="' || n + 2 || '" data-col="2" class="r"><span data-kind="total.grand">' || v || '</span></td></tr></tbody></table>' AS markup
FROM b JOIN s USING (o_orderkey)
""")
def sheet_items(t, spark):
    return _bills(t).select("o_orderkey", sheets.items_table(F.col("entries"), SHEET, VALUES, totals=F.col("totals"), grand=F.lit(1)).alias("markup"))


@query("""
WITH b AS (SELECT l_orderkey AS o_orderkey, format('{:,}', round_even(sum(l_extendedprice), 0)::BIGINT) AS v FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, '<div class="totals"><div class="t"><span data-kind="total.line.label" class="k">Sum</span><span data-kind="total.line" class="v">' || v || '</span></div><div class="t grand"><span data-kind="total.grand.label" class="k">To pay</span><span data-kind="total.grand" class="v">' || v || '</span></div></div>' AS totals,
 '<div class="footer"><div><span data-kind="footer">Thank you</span></div><div><span data-kind="footer">Bill ' || o_orderkey || '</span></div></div>' AS footer, '<div class="words"><span data-kind="invoice.words">In words ' || v || '</span></div>' AS words, '<div class="signs"><div class="sign"><span data-kind="sign.title">Seller</span><span data-kind="sign.name">' || v || '</span></div></div>' AS signs FROM b
""")
def sheet_blocks(t, spark):
    value = F.col("totals")[0]["value"]
    sign = F.array(F.struct(F.lit("Seller").alias("title"), F.lit("").alias("hint"), value.alias("name")))
    return _bills(t).select("o_orderkey", sheets.totals_block(F.col("totals"), F.lit(1)).alias("totals"), sheets.footer_block(F.col("footer")).alias("footer"), sheets.words_block("In words", value).alias("words"), sheets.signature_block(sign).alias("signs"))


@query("SELECT o_orderkey, ['No', 'Goods & more', 'Amount'] AS head, count(*) + 1 AS rows, sum(CASE WHEN k < 3 THEN 1 ELSE 0 END)::BIGINT AS cells FROM (SELECT l_orderkey AS o_orderkey, k FROM lineitem, (SELECT unnest([0, 1, 2]) AS k) WHERE k = 0) GROUP BY o_orderkey")
def sheet_read_back(t, spark):
    markup = sheets.document([sheets.items_table(F.col("entries"), SHEET, VALUES)], title=F.lit("a < b"))
    cells = _bills(t).select("o_orderkey", tables.cells_of(markup).alias("c"))
    first = F.transform(F.filter("c", lambda x: x["tag"] == "th"), lambda x: x["text"])
    return cells.select("o_orderkey", first.alias("head"), (F.array_max(F.transform("c", lambda x: x["row"])) + 1).cast("bigint").alias("rows"), (F.size(F.filter("c", lambda x: (x["tag"] == "td") & (x["col"] == 0)))).cast("bigint").alias("cells"))


@query("SELECT n_nationkey AS seed, 48::BIGINT AS covered, 0::BIGINT AS twice, true AS same FROM nation")
def made_tables(t, spark):
    cells = sheets.made_tables(t("nation").select(F.col("n_nationkey").cast("bigint").alias("seed")), 8, 6)
    area = cells.groupBy("seed").agg(F.sum(F.col("rowspan") * F.col("colspan")).alias("covered"))
    twice = tables.span_problems(cells, "seed").groupBy("seed").agg(F.count("*").alias("twice"))
    pages = sheets.table_pages(cells).select("seed", F.explode(tables.cells_of("markup")).alias("c")).select("seed", "c.row", "c.col", "c.rowspan", "c.colspan", "c.text")
    matched = cells.select("seed", "row", "col", "rowspan", "colspan", "text").join(pages, ["seed", "row", "col", "rowspan", "colspan", "text"], "full_outer").groupBy("seed").agg(F.count("*").alias("n"))
    same = matched.join(cells.groupBy("seed").agg(F.count("*").alias("m")), "seed").select("seed", (F.col("n") == F.col("m")).alias("same"))
    return area.join(twice, "seed", "left").join(same, "seed").select("seed", "covered", F.coalesce("twice", F.lit(0)).cast("bigint").alias("twice"), "same")


@query("""
SELECT l_orderkey, l_linenumber, '{"file_name":"t' || l_orderkey || '","task":"table_structure","ground_truth":"<t>","structure_tokens":["<td>","</td>"],"cells":[{"tokens":["x"],"bbox":[[[' || x0 || ',1.0],[' || x1 || ',1.0],[' || x1 || ',3.0],[' || x0 || ',3.0]]]}],"n_cells":1}' AS record
FROM (SELECT l_orderkey, l_linenumber, round(l_quantity * 0.5, 1) AS x0, round((l_quantity + 4) * 0.5, 1) AS x1 FROM lineitem)
""")
def structure_records(t, spark):
    box = sheets.quad(F.col("l_quantity"), F.lit(2.0), F.lit(4.0), F.lit(4.0), 0.5)
    cells = F.array(F.struct(F.array(F.lit("x")).alias("tokens"), F.array(box).alias("bbox")))
    record = sheets.structure_record(F.concat(F.lit("t"), F.col("l_orderkey").cast("string")), F.array(F.lit("<td>"), F.lit("</td>")), cells, F.lit("<t>"))
    return t("lineitem").select("l_orderkey", "l_linenumber", record.alias("record"))
