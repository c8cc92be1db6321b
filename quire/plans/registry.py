"""Every query of the library proper, and the SQL that says what it returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup
from ..functions import text as T
from ..operators import align, documents, images, invoices, records, sampling, stats, tables
from ..sources import files
from . import planning

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function of a table reader under its name, with the SQL of its result."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- drift of a mix ---

_PAIRS = """
WITH p AS (SELECT lang AS value, count(*) / (SELECT count(*) FROM documents)::DOUBLE AS p FROM documents GROUP BY lang),
t AS (SELECT source, count(*) AS draws FROM documents GROUP BY source),
s AS (SELECT source, lang AS value, count(*) AS n FROM documents GROUP BY ALL),
g AS (SELECT t.source, p.value, t.draws, p.p, coalesce(s.n, 0) AS n FROM t CROSS JOIN p LEFT JOIN s ON s.source = t.source AND s.value = p.value)
"""


@query(_PAIRS + """
SELECT source, draws, distance, noise, draws >= 30 AS judged, draws >= 30 AND distance > 0.15 + noise AS drifted FROM (
SELECT source, max(draws) AS draws, round(0.5 * sum(abs(n / draws::DOUBLE - p)), 6) AS distance,
       round(0.5 * sum(CASE WHEN p > 0 AND p < 1 THEN sqrt(2 * p * (1 - p) / (pi() * draws)) ELSE 0 END), 6) AS noise FROM g GROUP BY source)
""")
def drift_lang_by_source(t, spark):
    return stats.drift(t("documents"), "source", "lang")


@query(_PAIRS + "SELECT source, value, round(p * draws, 6) AS expected FROM g WHERE n = 0 AND round(p * draws, 6) >= 5")
def drift_never_drawn(t, spark):
    return stats.never_drawn(t("documents"), "source", "lang")


@query(_PAIRS + """
SELECT source, value, gap, place::INT AS place FROM (
SELECT source, value, gap, row_number() OVER (PARTITION BY source ORDER BY abs(gap) DESC, value) AS place
FROM (SELECT source, value, round(n / draws::DOUBLE - p, 6) AS gap FROM g)) WHERE place <= 3
""")
def drift_top_gaps(t, spark):
    return stats.top_gaps(t("documents"), "source", "lang")


@query("SELECT lang, max(n) AS draws FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang")
def run_draws_paired(t, spark):
    return stats.run_draws(t("documents"), "lang", "source", True)


@query("SELECT lang, count(*) AS draws FROM documents GROUP BY lang")
def run_draws_independent(t, spark):
    return stats.run_draws(t("documents"), "lang", "source", False)


@query("SELECT source, lang AS value, count(*) AS n, sum(count(*)) OVER (PARTITION BY source)::BIGINT AS draws, count(*) / sum(count(*)) OVER (PARTITION BY source)::DOUBLE AS share FROM documents GROUP BY source, lang")
def shard_shares(t, spark):
    return stats.shares(t("documents"), "lang", ["source"])


# --- text kernels ---

_TOKENS = r"[x FOR x IN regexp_split_to_array(lower(text), '[^\p{L}\p{N}_.,\-]+') IF regexp_matches(x, '[\p{L}\p{N}_]')]"


@query(f"SELECT doc_id, len({_TOKENS})::INT AS n_tokens, len(list_distinct({_TOKENS}))::INT AS n_distinct FROM documents")
def token_counts(t, spark):
    x = t("documents").select("doc_id", T.tokens(F.col("text")).alias("t"))
    return x.select("doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_distinct"))


@query("SELECT doc_id, strip_accents(replace(replace(text, 'đ', 'd'), 'Đ', 'D')) AS folded FROM documents")
def ascii_fold_docs(t, spark):
    return t("documents").select("doc_id", T.ascii_fold("text").alias("folded"))


@query("SELECT lang, count(*) AS n, round(avg(CASE WHEN regexp_matches(text, '[áàãéèíìóòõúùýâêôÁÀÃÉÈÍÌÓÒÕÚÙÝÂÊÔăđơưĂĐƠƯ]') THEN 1.0 ELSE 0.0 END), 6) AS share FROM documents GROUP BY lang")
def diacritic_share(t, spark):
    return t("documents").groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(T.has_diacritics(F.col("text")).cast("double")), 6).alias("share"))


@query("""
SELECT o_orderkey, replace(format('{:,}', round_even(o_totalprice, 0)::BIGINT), ',', '.') AS dot, format('{:,}', round_even(o_totalprice, 0)::BIGINT) AS comma,
       CASE WHEN o_totalprice < 0 THEN '-' ELSE '' END || format('{:,}', round_even(abs(o_totalprice), 0)::BIGINT) || ' VND' AS signed FROM orders
""")
def money_styles(t, spark):
    x = F.col("o_totalprice")
    return t("orders").select("o_orderkey", T.money(x, "dot").alias("dot"), T.money(x, "comma").alias("comma"), T.money(x, "comma", suffix=" VND").alias("signed"))


@query("SELECT o_orderkey, round_even(o_totalprice, 0) AS amount FROM orders")
def money_read_back(t, spark):
    return t("orders").select("o_orderkey", T.amount(T.money(F.col("o_totalprice"), "dot"), "dot").alias("amount"))


_THREE = "printf('%.3f', v)"
_WHOLE = f"format('{{:,}}', trunc(split_part({_THREE}, '.', 1)::DOUBLE)::BIGINT)"


@query(f"""
SELECT l_orderkey, l_linenumber, format('{{:,}}', round_even(v, 0)::BIGINT) AS cents, replace({_WHOLE}, ',', '.') || ',' || split_part({_THREE}, '.', 2) AS dot,
       {_WHOLE} || '.' || split_part({_THREE}, '.', 2) AS comma
FROM (SELECT l_orderkey, l_linenumber, (l_quantity * 1234 - 20000) * (1 + l_discount) / 4 AS v FROM lineitem)
""")
def quantity_text(t, spark):
    v = (F.col("l_quantity") * 1234 - 20000) * (1 + F.col("l_discount")) / 4
    return t("lineitem").select("l_orderkey", "l_linenumber", T.quantity(v, "cents").alias("cents"), T.quantity(v, "dot", 3).alias("dot"), T.quantity(v, "comma", 3).alias("comma"))


@query("SELECT o_orderkey, CASE WHEN v < 0 THEN '-' ELSE '' END || '$' || format('{:,.2f}', abs(v) / 100.0) AS dollars FROM (SELECT o_orderkey, o_totalprice * 10 - 900000 AS v FROM orders)")
def money_cents(t, spark):
    return t("orders").select("o_orderkey", T.money(F.col("o_totalprice") * 10 - 900000, "cents", prefix="$").alias("dollars"))


@query("SELECT o_orderkey, round_even(o_totalprice / 500, 0) * 500 AS stepped FROM orders")
def round_to_step(t, spark):
    return t("orders").select("o_orderkey", T.round_to(F.col("o_totalprice"), 500).alias("stepped"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean FROM documents")
def whitespace_clean(t, spark):
    return t("documents").select("doc_id", T.trimmed(F.col("text")).alias("clean"))


@query(r"SELECT doc_id, len(string_split(regexp_replace(replace(text, '.', ' . '), '(( /?[.!?])+ )', '\1' || chr(10), 'g'), chr(10)))::INT AS n_sentences FROM documents")
def sentence_split(t, spark):
    return t("documents").select("doc_id", F.size(T.sentences(F.replace("text", F.lit("."), F.lit(" . ")))).alias("n_sentences"))


@query(r"""
SELECT item_id, CASE WHEN trim(text) = '' THEN 'empty' WHEN regexp_matches(text, '[0-9]') THEN 'digit' WHEN regexp_matches(text, '(^|[^\p{L}])\p{Lu}{2,}([^\p{L}]|$)') THEN 'allcaps'
       WHEN NOT regexp_matches(text, '^[\p{L} .,''-]*$') THEN 'alphabet' END AS reason FROM benchmark
""")
def handwriting_refusal(t, spark):
    return t("benchmark").select("item_id", T.refusal(F.col("text")).alias("reason"))


@query(r"SELECT doc_id, CASE WHEN regexp_replace(text, '[^\x00-\x7F]', '', 'g') = '' THEN '_' ELSE regexp_replace(text, '[^\x00-\x7F]', '', 'g') END AS plain FROM documents")
def non_ascii_removed(t, spark):
    return t("documents").select("doc_id", T.without_non_ascii(F.col("text")).alias("plain"))


@query("""
SELECT p_partkey, (10 - (list_sum([CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END * substr(c, i, 1)::INT FOR i IN range(1, 13)])) % 10) % 10 AS digit
FROM (SELECT p_partkey, lpad((893000000000 + p_partkey)::VARCHAR, 12, '0') AS c FROM part)
""")
def ean13_digit(t, spark):
    twelve = F.lpad((F.lit(893000000000) + F.col("p_partkey")).cast("string"), 12, "0")
    return t("part").select("p_partkey", T.ean13_check(twelve).cast("bigint").alias("digit"))


@query("SELECT p_partkey, printf('#%02x%02x%02x', p_partkey % 256, p_size % 256, (p_partkey * 7) % 256) AS colour, round_even(p_size + (255 - p_size) * 0.25, 0)::INT AS faded FROM part")
def colours(t, spark):
    k, s = F.col("p_partkey"), F.col("p_size")
    return t("part").select("p_partkey", T.hex_colour(k % 256, s % 256, k * 7 % 256).alias("colour"), T.faded(s, F.lit(0.25)).alias("faded"))


@query("SELECT c_custkey, 'Dear ' || c_name || ', ' || c_mktsegment AS letter FROM customer")
def template_filled(t, spark):
    values = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    return t("customer").select("c_custkey", T.filled(F.lit("Dear {name}, {segment}"), values).alias("letter"))


_NAMES = "['không', 'một', 'hai', 'ba', 'bốn', 'năm', 'sáu', 'bảy', 'tám', 'chín']"
#: A group of three digits g: how it is read after a larger group (lead) or as the first.
_GROUP = f"""
concat_ws(' ', CASE WHEN lead OR g >= 100 THEN {_NAMES}[g // 100 + 1] || ' trăm' END,
  CASE WHEN g // 10 % 10 = 0 THEN CASE WHEN g % 10 > 0 AND (lead OR g >= 100) THEN 'lẻ' END WHEN g // 10 % 10 = 1 THEN 'mười' ELSE {_NAMES}[g // 10 % 10 + 1] || ' mươi' END,
  CASE WHEN g % 10 = 0 THEN NULL WHEN g % 10 = 1 AND g // 10 % 10 > 1 THEN 'mốt' WHEN g % 10 = 4 AND g // 10 % 10 > 1 THEN 'tư' WHEN g % 10 = 5 AND g // 10 % 10 > 0 THEN 'lăm' ELSE {_NAMES}[g % 10 + 1] END)
"""


@query(f"""
WITH v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 0.0 ELSE (o_totalprice - 100000) * CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 100003 ELSE 1e7 + 1 END END AS v FROM orders),
n AS (SELECT o_orderkey, v, round_even(abs(v), 0)::BIGINT AS n FROM v),
g AS (SELECT o_orderkey, i, n // (1000 ** i)::BIGINT % 1000 AS g, n >= (1000 ** (i + 1))::BIGINT AS lead FROM n, (SELECT unnest([0, 1, 2, 3, 4]) AS i)),
w AS (SELECT o_orderkey, string_agg(concat_ws(' ', {_GROUP}, nullif(['', 'nghìn', 'triệu', 'tỷ', 'nghìn tỷ'][i + 1], '')), ' ' ORDER BY i DESC) AS w FROM g WHERE g > 0 GROUP BY o_orderkey)
SELECT o_orderkey, CASE WHEN v < 0 THEN 'Âm ' ELSE '' END || CASE WHEN n = 0 THEN 'Không' ELSE upper(left(w, 1)) || substr(w, 2) END || ' đồng' AS words FROM n LEFT JOIN w USING (o_orderkey)
""")
def amount_in_words(t, spark):
    k, x = F.col("o_orderkey"), F.col("o_totalprice") - 100000
    v = F.when(k % 97 == 0, 0.0).otherwise(x * F.when(k % 3 == 0, 1.0).when(k % 3 == 1, 100003.0).otherwise(1e7 + 1))
    return t("orders").select("o_orderkey", T.words_vi(v).alias("words"))


@query(r"""
WITH RECURSIVE parts AS (SELECT item_id, regexp_extract_all(replace(text, '. ', '.   '), '\s+|\S+') AS p FROM benchmark),
fold AS (
    SELECT item_id, p, 1 AS i, []::VARCHAR[] AS lines, '' AS now FROM parts
    UNION ALL
    SELECT item_id, p, i + 1,
        CASE WHEN length(now) + length(p[i]) <= 12 THEN lines WHEN regexp_matches(p[i], '^\s') THEN list_append(lines, regexp_replace(now, '\s+$', ''))
             ELSE list_concat(CASE WHEN regexp_matches(now, '\S') THEN list_append(lines, regexp_replace(now, '\s+$', '')) ELSE lines END, [substr(p[i], k * 12 + 1, 12) FOR k IN range((length(p[i]) - 1) // 12)]) END,
        CASE WHEN length(now) + length(p[i]) <= 12 THEN now || p[i] WHEN regexp_matches(p[i], '^\s') THEN '' ELSE substr(p[i], (length(p[i]) - 1) // 12 * 12 + 1) END
    FROM fold WHERE i <= len(p)
)
SELECT item_id, CASE WHEN regexp_matches(now, '\S') THEN list_append(lines, regexp_replace(now, '\s+$', '')) WHEN len(lines) = 0 THEN [''] ELSE lines END AS lines FROM fold WHERE i = len(p) + 1
""")
def wrapped_lines(t, spark):
    return t("benchmark").select("item_id", T.wrapped(F.replace("text", F.lit(". "), F.lit(".   ")), 12).alias("lines"))


# --- order-free recall and strata ---

_EXPLODED = r"SELECT {key}, unnest([x FOR x IN regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}_.,\-]+') IF regexp_matches(x, '[\p{{L}}\p{{N}}_]')]) AS token FROM {table}"


@query(f"""
WITH turns AS ({_EXPLODED.format(key="conv_id, role", table="conversations")}),
a AS (SELECT conv_id, token, count(*) AS a FROM turns WHERE role = 'assistant' GROUP BY ALL), b AS (SELECT conv_id, token, count(*) AS b FROM turns WHERE role = 'user' GROUP BY ALL)
SELECT conv_id, sum(a)::BIGINT AS wanted, sum(least(a, coalesce(b, 0)))::BIGINT AS found, round(sum(least(a, coalesce(b, 0))) / sum(a)::DOUBLE, 6) AS recall FROM a LEFT JOIN b USING (conv_id, token) GROUP BY conv_id
""")
def token_recall(t, spark):
    turns = t("conversations").select("conv_id", "role", F.explode(T.tokens(F.col("text"))).alias("token"))
    return stats.multiset_recall(turns.where("role = 'assistant'"), turns.where("role = 'user'"), "conv_id")


_RATED = "SELECT source, lang, quality, n_chars::DOUBLE AS v FROM documents JOIN labels USING (doc_id)"


@query(f"""
SELECT source, lang, quality, round(avg(v), 6) AS mean, count(v) AS n, grouping(source, lang, quality)::INT AS grouping FROM ({_RATED})
GROUP BY GROUPING SETS ((source), (lang), (quality), (source, lang))
""")
def recall_strata(t, spark):
    rated = t("documents").join(t("labels"), "doc_id").withColumn("v", F.col("n_chars").cast("double"))
    return stats.strata(rated, "v", ["source", "lang", "quality"], ("source", "lang"))


@query("""
SELECT lang, round(max(m) - min(m), 6) AS spread, max_by(source, (m, source)) AS highest, count(*) AS levels
FROM (SELECT lang, source, avg(n_chars) AS m FROM documents GROUP BY ALL) GROUP BY lang HAVING count(*) > 1
""")
def ageing_spread(t, spark):
    return stats.spread(t("documents"), "lang", "source", "n_chars")


@query("""
WITH m AS (SELECT lang, doc_id % 2 AS half, avg(n_chars) AS v FROM documents GROUP BY ALL)
SELECT a.lang, round(a.v - b.v, 4) AS fall FROM m a JOIN m b ON a.lang = b.lang AND a.half = 0 AND b.half = 1
""")
def compare_reports(t, spark):
    m = t("documents").groupBy("lang", (F.col("doc_id") % 2).alias("half")).agg(F.avg("n_chars").alias("v"))
    a, b = m.where("half = 0").select("lang", F.col("v").alias("a")), m.where("half = 1").select("lang", F.col("v").alias("b"))
    return a.join(b, "lang").select("lang", F.round(F.col("a") - F.col("b"), 4).alias("fall"))


# --- checks ---


@query("""
SELECT l_orderkey, l_linenumber, round(l_quantity * p_retailprice - l_extendedprice, 6) AS off FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE abs(round(l_quantity * p_retailprice - l_extendedprice, 6)) > 0.5
""")
def line_arithmetic(t, spark):
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return records.line_arithmetic(lines, F.col("l_quantity"), F.col("p_retailprice"), F.col("l_extendedprice")).select("l_orderkey", "l_linenumber", "off")


@query("""
SELECT o_orderkey, off FROM (SELECT o_orderkey, round(o_totalprice - coalesce(s, 0), 2) AS off FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)
WHERE abs(off) > 0.5
""")
def order_totals_check(t, spark):
    lines = t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return records.totals(t("orders"), lines, "o_orderkey", "o_totalprice", "l_extendedprice", 0.5).select("o_orderkey", "off")


@query("""
SELECT 'customer' AS kind, c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT DISTINCT 'order', o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
""")
def reference_both_ways(t, spark):
    return records.two_way(t("orders"), t("customer"), "o_custkey", "c_custkey", ("order", "customer"))


@query("""
SELECT conv_id, turn, list_filter([CASE WHEN role NOT IN ('user', 'assistant', 'system') THEN 'role' END, CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' END,
       CASE WHEN length(text) > 1000 THEN 'long' END, CASE WHEN turn < 0 THEN 'turn' END], lambda x: x IS NOT NULL) AS problems FROM conversations
""")
def record_problems(t, spark):
    checks = {"role": ~F.col("role").isin("user", "assistant", "system"), "empty": F.col("text").isNull() | (F.trim("text") == ""), "long": F.length("text") > 1000, "turn": F.col("turn") < 0}
    return t("conversations").select("conv_id", "turn", records.problems(checks).alias("problems"))


@query("SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS leaf FROM events")
def json_leaves(t, spark):
    return records.json_leaves(t("events"), "event_id", "props")


@query("""
SELECT o_orderkey, x.path AS path, x.leaf AS leaf FROM (SELECT o_orderkey, unnest([{'path': 'a.b.c.d.e', 'leaf': o_orderstatus}, {'path': 'a.b.list', 'leaf': o_custkey::VARCHAR}, {'path': 'a.b.list.deep', 'leaf': o_orderpriority}, {'path': 'z', 'leaf': o_orderkey::VARCHAR}]) AS x FROM orders)
""")
def deep_leaves(t, spark):
    deep = F.struct(F.struct(F.struct(F.struct(F.col("o_orderstatus").alias("e")).alias("d")).alias("c"), F.lit("@").alias("list")).alias("b"))
    text = F.to_json(F.struct(deep.alias("a"), F.col("o_orderkey").alias("z")))
    mixed = F.concat(F.lit("["), F.col("o_custkey").cast("string"), F.lit(',[{"deep":"'), F.col("o_orderpriority"), F.lit('"}]]'))
    return records.json_leaves(t("orders").select("o_orderkey", F.replace(text, F.lit('"@"'), mixed).alias("j")), "o_orderkey", "j")


@query("SELECT source, count(*) - count(DISTINCT sha256(text)) AS repeated FROM documents GROUP BY source")
def duplicate_labels(t, spark):
    return t("documents").groupBy("source").agg((F.count("*") - F.countDistinct(F.sha2("text", 256))).alias("repeated"))


@query("""
WITH f AS (SELECT source, unnest([{'field': 'digit', 'there': regexp_matches(text, '[0-9]')}, {'field': 'pipe', 'there': contains(text, '|')}, {'field': 'newline', 'there': contains(text, chr(10))}]) AS x FROM documents)
SELECT source, field, n, missing, share FROM (SELECT source, x.field AS field, count(*) AS n, count(*) FILTER (NOT x.there) AS missing, round(count(*) FILTER (NOT x.there) / count(*)::DOUBLE, 6) AS share FROM f GROUP BY ALL)
WHERE n >= 5 AND share > 0.5
""")
def unprinted_budget(t, spark):
    text = F.col("text")
    rows = t("documents").select("source", text.rlike("[0-9]").alias("digit"), text.contains("|").alias("pipe"), text.contains("\n").alias("newline"))
    return records.unprinted(rows, "source", ["digit", "pipe", "newline"], 0.5)


@query("""
WITH b AS (SELECT l_orderkey, l_linenumber AS i, l_quantity AS x0, l_quantity + 20 AS x1, l_discount * 100 AS y0, l_discount * 100 + 5 AS y1 FROM lineitem)
SELECT l_orderkey, i, j, share FROM (
SELECT a.l_orderkey, a.i, b.i AS j, round((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) / least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0)), 6) AS share
FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND a.i < b.i AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1) WHERE share > 0.3
""")
def pairwise_overlap(t, spark):
    q, d = F.col("l_quantity"), F.col("l_discount") * 100
    boxes = t("lineitem").select("l_orderkey", F.col("l_linenumber").alias("i"), q.alias("x0"), (q + 20).alias("x1"), d.alias("y0"), (d + 5).alias("y1"))
    return records.overlaps(boxes, "l_orderkey", "i")


# --- fingerprints ---


@query("SELECT c_custkey, sha256('{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\",\"c_nationkey\":' || c_nationkey || '}') AS sha FROM customer")
def fingerprint_rows(t, spark):
    return t("customer").select("c_custkey", records.row_hash(["c_name", "c_custkey", "c_nationkey"]).alias("sha"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey >= 1000000 THEN 'added' WHEN c_custkey % 10 = 0 THEN 'missing' ELSE 'differs' END AS change FROM
(SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 7 = 0 UNION ALL SELECT c_custkey + 1000000 FROM customer WHERE c_custkey < 5)
""")
def dataset_diff(t, spark):
    before = t("customer").select("c_custkey", "c_name")
    changed = before.where("c_custkey % 10 <> 0").withColumn("c_name", F.when(F.col("c_custkey") % 7 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")))
    more = before.where("c_custkey < 5").withColumn("c_custkey", F.col("c_custkey") + 1000000)
    return records.diff(before, changed.unionByName(more), "c_custkey", ["c_name"])


@query()
def dataset_digest(t, spark):
    return records.digest(t("orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


# --- plans ---


@query("""
SELECT n_name, pos::INT AS pos, 103 // n + CASE WHEN pos < 103 % n THEN 1 ELSE 0 END AS quota FROM (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos, count(*) OVER () AS n FROM nation)
""")
def quota_split(t, spark):
    return planning.quotas(t("nation"), 103, "n_nationkey").select("n_name", "pos", "quota")


_RUNS = """
WITH q AS (SELECT r_name AS backend, r_regionkey AS b, n_name AS layout, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) - 1 AS pos, n_nationkey % 4 * 3 AS quota FROM nation JOIN region ON n_regionkey = r_regionkey),
runs AS (SELECT backend, layout, 500 + b * 100000 + (row_number() OVER w - 1) * 1000 AS seed, quota AS count, coalesce(sum(quota) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_index FROM q WHERE quota > 0 WINDOW w AS (PARTITION BY backend ORDER BY pos))
"""


def _runs(t):
    from pyspark.sql import Window

    q = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    q = q.select(F.col("r_name").alias("backend"), F.col("r_regionkey").alias("backend_pos"), F.col("n_name").alias("layout"), (F.row_number().over(Window.partitionBy("r_name").orderBy("n_nationkey")) - 1).alias("pos"), (F.col("n_nationkey") % 4 * 3).alias("quota"))
    return planning.runs(q, "backend", 500, False)


@query(_RUNS + "SELECT * FROM runs")
def backend_runs(t, spark):
    return _runs(t)


@query(_RUNS + """
SELECT backend, shard, layout, seed + greatest(first_index, shard * 5) - first_index AS seed, least(first_index + count, (shard + 1) * 5) - greatest(first_index, shard * 5) AS count
FROM (SELECT *, unnest(range(first_index // 5, (first_index + count - 1) // 5 + 1)) AS shard FROM runs)
""")
def shard_runs(t, spark):
    return planning.shards(_runs(t), "backend", 5)


@query("""
SELECT o_custkey, lo, hi, next_lo FROM (SELECT *, lead(lo) OVER (PARTITION BY o_custkey ORDER BY lo, hi) AS next_lo FROM (SELECT o_custkey, o_orderkey AS lo, o_orderkey + 400 AS hi FROM orders)) WHERE next_lo < hi
""")
def seed_overlap(t, spark):
    ranges = t("orders").select("o_custkey", F.col("o_orderkey").alias("lo"), (F.col("o_orderkey") + 400).alias("hi"))
    return records.adjacent_overlaps(ranges, ["o_custkey"])


@query("""
WITH p AS (SELECT event_type, user_id, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL)
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.n, b.n) AS n, CASE WHEN a.n IS NOT NULL THEN 'click' ELSE 'view' END AS only_in
FROM (FROM p WHERE event_type = 'click') a FULL JOIN (FROM p WHERE event_type = 'view') b ON a.user_id = b.user_id AND a.n = b.n WHERE a.n IS NULL OR b.n IS NULL
""")
def paired_plan_check(t, spark):
    plan = t("events").where(F.col("event_type").isin("click", "view")).groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return planning.unpaired(plan, "click", "view", "event_type", ["user_id", "n"])


@query("SELECT r_regionkey, r_regionkey * 10 + k AS page_seed, (r_regionkey * (r_regionkey - 1)) // 2 + k AS index FROM (SELECT r_regionkey, unnest(range(0, r_regionkey)) AS k FROM region)")
def job_pages(t, spark):
    jobs = t("region").select("r_regionkey", F.col("r_regionkey").cast("bigint").alias("count"), (F.col("r_regionkey") * 10).cast("bigint").alias("seed"))
    return planning.pages(jobs, "r_regionkey").select("r_regionkey", "page_seed", "index")


@query("SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8 AS batch, printf('%s_%03d.jpg', source, doc_id) AS image FROM documents")
def page_split(t, spark):
    return planning.batched(t("documents").select("doc_id", "source"), "source", "doc_id", 8).select("doc_id", "source", "batch", planning.image_name(F.col("source"), F.col("doc_id")).alias("image"))


@query("SELECT n_name, r_name, s AS size FROM nation CROSS JOIN region CROSS JOIN (VALUES ('a4'), ('a5')) v(s)")
def style_product(t, spark):
    return planning.product(t("nation").select("n_name"), t("region").select("r_name"), spark.createDataFrame([("a4",), ("a5",)], "size string"))


# --- constrained sampling ---

#: A small rule space: attribute, id, weight, tags, requires, excludes.
OPTIONS = [
    (0, "document", 0, "bill", 3.0, ["money"], [], []),
    (0, "document", 1, "letter", 1.0, ["prose"], [], []),
    (1, "layout", 0, "grid", 2.0, ["wide"], ["money"], []),
    (1, "layout", 1, "plain", 1.0, [], [], []),
    (1, "layout", 2, "column", 1.0, ["narrow"], ["prose"], ["money"]),
    (2, "visual", 0, "stamp", 1.0, ["red"], ["money"], ["narrow"]),
    (2, "visual", 1, "none", 4.0, [], [], []),
]
_OPTIONS = "WITH o(attr_pos, attr, opt_pos, id, weight, tags, requires, excludes) AS (VALUES " + ", ".join(f"({a}, '{b}', {c}, '{d}', {w}::DOUBLE, {t}::VARCHAR[], {r}::VARCHAR[], {x}::VARCHAR[])" for a, b, c, d, w, t, r, x in OPTIONS) + ")"


def _options(spark):
    return spark.createDataFrame(OPTIONS, sampling.SCHEMA)


@query(_OPTIONS + " SELECT attr, id FROM o WHERE list_has_all(['money', 'wide'], requires) AND NOT list_has_any(['money', 'wide'], excludes)")
def options_allowed(t, spark):
    held = F.array(F.lit("money"), F.lit("wide"))
    return _options(spark).where(sampling.allowed(held, F.col("requires"), F.col("excludes"))).select("attr", "id")


@query(_OPTIONS + " SELECT attr, id, round(weight / sum(weight) OVER (PARTITION BY attr), 6) AS share FROM o")
def option_shares(t, spark):
    return sampling.weight_shares(_options(spark))


@query(_OPTIONS + """
, s0 AS (SELECT ([])::VARCHAR[] AS tags), s1 AS (SELECT DISTINCT list_sort(list_distinct(list_concat(s0.tags, o.tags))) AS tags FROM s0 JOIN o ON attr_pos = 0 AND list_has_all(s0.tags, requires) AND NOT list_has_any(s0.tags, excludes)),
s2 AS (SELECT DISTINCT list_sort(list_distinct(list_concat(s1.tags, o.tags))) AS tags FROM s1 JOIN o ON attr_pos = 1 AND list_has_all(s1.tags, requires) AND NOT list_has_any(s1.tags, excludes))
SELECT 0 AS attr_pos, tags FROM s0 UNION ALL SELECT 1, tags FROM s1 UNION ALL SELECT 2, tags FROM s2
""")
def reachable_tags(t, spark):
    return sampling.reachable(_options(spark))


_U = "(('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967296.0)::DOUBLE"


@query(_OPTIONS + f"""
, r AS (SELECT id, opt_pos, sum(weight) OVER (ORDER BY opt_pos) AS run, sum(weight) OVER () AS total FROM o WHERE attr = 'layout'),
d AS (SELECT doc_id, {_U.format(key="doc_id || ':layout'")} AS u FROM documents)
SELECT doc_id, min_by(id, opt_pos) AS id FROM d JOIN r ON run >= u * total GROUP BY doc_id
""")
def inverse_cdf_draw(t, spark):
    return sampling.draw_one(t("documents").select("doc_id"), _options(spark).where("attr = 'layout'"), "doc_id", sampling.uniform(F.col("doc_id"), F.lit("layout")))


@query()
def sampled_recipes(t, spark):
    out = sampling.sample(t("documents").select(F.col("doc_id").alias("draw")), _options(spark))
    return out.groupBy(F.col("attributes")["document"].alias("document"), F.col("attributes")["layout"].alias("layout"), F.col("attributes")["visual"].alias("visual")).count()


@query("SELECT * FROM (VALUES ('layout', 'lost', 'unsatisfiable'), ('visual', 'idle', 'no weight'), ('visual', 'none', 'duplicate')) AS p(attr, id, problem)")
def invalid_options(t, spark):
    faults = [(1, "layout", 3, "lost", 1.0, [], ["red"], []), (2, "visual", 2, "idle", 0.0, [], [], []), (2, "visual", 3, "none", 1.0, [], [], [])]
    return sampling.invalid(_options(spark).unionByName(spark.createDataFrame(faults, sampling.SCHEMA)))


# --- costs ---

_COST = "SELECT user_id % 4 AS process, event_type AS stage, count(*) AS calls, round(sum(value), 6) AS seconds FROM events GROUP BY ALL"


def _costs(t):
    return stats.stage_cost(t("events").withColumn("process", F.col("user_id") % 4), "process", "event_type", "value").withColumnRenamed("event_type", "stage")


@query(f"SELECT *, round(seconds / calls, 6) AS per_call, round(seconds / sum(seconds) OVER (PARTITION BY process), 6) AS share FROM ({_COST})")
def stage_cost(t, spark):
    return _costs(t)


@query(f"SELECT stage, sum(calls)::BIGINT AS calls, round(sum(seconds), 6) AS seconds, round(sum(seconds) / sum(calls), 6) AS per_call FROM ({_COST}) GROUP BY stage")
def merged_costs(t, spark):
    return stats.merged_costs(_costs(t))


@query(f"""
WITH m AS (SELECT stage, round(sum(seconds) / sum(calls), 6) AS per_call FROM ({_COST}) GROUP BY stage)
SELECT user_id AS job, round(sum(n * per_call) + 1.5, 6) AS seconds FROM (SELECT user_id, event_type AS stage, count(*) AS n FROM events GROUP BY ALL) JOIN m USING (stage) GROUP BY user_id
""")
def predicted_cost(t, spark):
    work = t("events").groupBy(F.col("user_id").alias("job"), F.col("event_type").alias("stage")).agg(F.count("*").alias("n"))
    return stats.predicted(stats.merged_costs(_costs(t)).select("stage", "per_call"), work, 1.5)


_MONTHS = ", ".join(f"round(100 * coalesce(sum(value) FILTER (user_id % 3 = {i}), 0) / (SELECT sum(value) FROM events WHERE user_id % 3 = {i}), 4) AS \"p{i}\"" for i in range(3))


@query(f"SELECT event_type, {_MONTHS} FROM events GROUP BY event_type")
def percent_table(t, spark):
    df = t("events").withColumn("p", F.concat(F.lit("p"), F.col("user_id") % 3))
    return stats.percent_table(df, "event_type", "p", ["p0", "p1", "p2"], "value")


@query("""
WITH p AS (SELECT user_id % 6 AS process, 'run/' || event_type AS path, sum(value) AS v FROM events GROUP BY ALL), r AS (SELECT process, sum(v) AS v FROM p GROUP BY process),
l AS (SELECT process, path || '/leaf' AS path, v / 4 AS v FROM p)
SELECT process, path, round(v, 4) AS seconds, round(own, 4) AS own FROM (SELECT process, 'run' AS path, v + 1 AS v, 1.0::DOUBLE AS own FROM r UNION ALL SELECT process, path, v, v * 0.75 FROM p UNION ALL SELECT process, path, v, v FROM l)
""")
def exclusive_seconds(t, spark):
    below = t("events").groupBy((F.col("user_id") % 6).alias("process"), F.concat(F.lit("run/"), "event_type").alias("path")).agg(F.sum("value").alias("seconds"))
    top = below.groupBy("process").agg((F.sum("seconds") + 1).alias("seconds")).select("process", F.lit("run").alias("path"), "seconds")
    leaf = below.select("process", F.concat("path", F.lit("/leaf")).alias("path"), (F.col("seconds") / 4).alias("seconds"))
    return stats.exclusive(below.unionByName(top).unionByName(leaf)).select("process", "path", F.round("seconds", 4).alias("seconds"), F.round("own", 4).alias("own"))


@query("SELECT event_id, user_id, before, value FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE value < before")
def restart_detection(t, spark):
    return stats.restarts(t("events"), "user_id", ["ts", "event_id"], "value").select("event_id", "user_id", "before", "value")


@query("SELECT p_brand, min(p_partkey) AS first FROM part GROUP BY p_brand")
def keep_first(t, spark):
    return stats.ordered_distinct(t("part"), "p_brand", F.col("p_partkey"))


# --- bills ---


@query("SELECT l_orderkey, l_tax, net, round_even(net::DECIMAL(18, 2) * l_tax::DECIMAL(6, 4), 2)::DOUBLE AS tax FROM (SELECT l_orderkey, l_tax, round(sum(l_extendedprice), 2) AS net FROM lineitem GROUP BY ALL)")
def tax_by_rate(t, spark):
    return invoices.tax_by_rate(t("lineitem"), "l_orderkey", "l_tax", F.col("l_extendedprice"))


@query("""
WITH p AS (SELECT l_tax, round(sum(l_quantity), 2) AS net, count(*) AS lines FROM lineitem GROUP BY l_tax)
SELECT r AS l_tax, coalesce(net, 0) AS net, coalesce(lines, 0) AS lines FROM (VALUES (0.0::DOUBLE), (0.05), (0.5)) v(r) LEFT JOIN p ON l_tax = r
UNION ALL SELECT NULL, round(sum(l_quantity), 2), count(*) FROM lineitem
""")
def tax_summary(t, spark):
    return invoices.tax_summary(t("lineitem"), [0.0, 0.05, 0.5], "l_tax", F.col("l_quantity"))


@query("SELECT l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus)::INT AS level, round(sum(l_quantity), 2) AS amount, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def group_headings(t, spark):
    return invoices.headings(t("lineitem"), "l_returnflag", "l_linestatus", "l_quantity")


@query("""
SELECT l_orderkey, l_linenumber, f AS fund, a - f AS copay, CASE WHEN w THEN b ELSE 0 END AS other_pay, a - f + CASE WHEN w THEN 0 ELSE b - a END AS self_pay
FROM (SELECT *, round_even(a * 80 / 100, 0) AS f FROM (SELECT l_orderkey, l_linenumber, round_even(l_extendedprice, 0) AS b, round_even(l_extendedprice * 0.5, 0) AS a, l_returnflag = 'R' AS w FROM lineitem))
""")
def insurance_shares(t, spark):
    full, part = F.bround("l_extendedprice", 0), F.bround(F.col("l_extendedprice") * 0.5, 0)
    return t("lineitem").select("l_orderkey", "l_linenumber", *invoices.insured(full, part, F.lit(80), F.col("l_returnflag") == "R"))


@query("SELECT o_orderkey, (o_orderdate::DATE + k::INT) AS night, (k + 1)::INT AS no FROM (SELECT o_orderkey, o_orderdate, unnest(range(0, o_orderkey % 4)) AS k FROM orders)")
def stay_nights(t, spark):
    stays = t("orders").select("o_orderkey", "o_orderdate", (F.col("o_orderkey") % 4).alias("n"))
    return invoices.nights(stays, "o_orderdate", "n").select("o_orderkey", "night", "no")


# --- table structure and markup ---


@query("""
WITH c AS (SELECT l_orderkey // 10 AS t, l_orderkey AS r, l_linenumber AS c, l_linenumber % 3 AS span FROM lineitem),
rows AS (SELECT t, r, '<tr> ' || string_agg(CASE WHEN span > 1 THEN '<td  colspan="' || span || '" > </td>' ELSE '<td> </td>' END, ' ' ORDER BY c) || ' </tr>' AS s FROM c GROUP BY ALL)
SELECT t, string_agg(s, ' ' ORDER BY r) AS tokens FROM rows GROUP BY t
""")
def structure_tokens(t, spark):
    k = F.col("l_orderkey")
    cells = t("lineitem").select(F.floor(k / 10).alias("t"), k.alias("row"), F.col("l_linenumber").alias("col"), F.lit(1).alias("rowspan"), (F.col("l_linenumber") % 3).alias("colspan"))
    return tables.structure_tokens(cells, "t").select("t", F.array_join("tokens", " ").alias("tokens"))


@query("""
SELECT n_nationkey, unnest([{'tag': 'td', 'row': 0, 'col': 0, 'rowspan': 2, 'colspan': 1, 'text': n_name}, {'tag': 'td', 'row': 0, 'col': 1, 'rowspan': 1, 'colspan': 1, 'text': 'a'}, {'tag': 'td', 'row': 1, 'col': 1, 'rowspan': 1, 'colspan': 1, 'text': 'b'}], recursive := true) FROM nation
""")
def table_cells(t, spark):
    markup = F.concat(F.lit("<table><tr><td rowspan=2>"), F.col("n_name"), F.lit("</td><td>a</td></tr><tr><td>b</td></tr></table>"))
    return t("nation").select("n_nationkey", F.explode(tables.cells_of(markup)).alias("c")).select("n_nationkey", "c.*")


@query()
def labelled_runs(t, spark):
    return t("pages").select("page_id", F.posexplode(tables.labelled_runs("html")).alias("pos", "r")).select("page_id", "pos", "r.*")


# --- alignment, labels and edit metrics ---


@query("SELECT item_id, length(text)::INT AS lcs FROM benchmark")
def lcs_of_spaced(t, spark):
    return t("benchmark").select("item_id", align.lcs("text", F.regexp_replace("text", "e", "eß")).alias("lcs"))


def _noisy(t):
    return t("benchmark").select("item_id", T.trimmed(F.col("text")).alias("gt"), F.translate(T.trimmed(F.col("text")), "t", "ł").alias("noise"))


@query("SELECT item_id, replace(g, 't', '') AS same FROM (SELECT item_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS g FROM benchmark)")
def aligned_common(t, spark):
    pair = _noisy(t).withColumn("p", align.aligned("gt", "noise"))
    both = F.filter(F.arrays_zip(F.split("p.gt", "").alias("a"), F.split("p.noise", "").alias("b")), lambda c: c["a"] == c["b"])
    return pair.select("item_id", F.array_join(F.transform(both, lambda c: c["a"]), "").alias("same"))


@query("SELECT item_id, (length(g) - length(replace(g, 't', '')))::INT AS replaces, length(replace(g, 't', ''))::INT AS matches, 0 AS inserts, 0 AS deletes FROM (SELECT item_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS g FROM benchmark)")
def edit_counts(t, spark):
    e = _noisy(t).withColumn("e", align.edit_counts(align.aligned("gt", "noise")))
    return e.select("item_id", "e.replaces", "e.matches", "e.inserts", "e.deletes")


@query("SELECT item_id, [CASE WHEN i % 3 = 1 THEN 'B-X' ELSE 'O' END FOR i IN range(0, len(string_split(g, ' ')))] AS labels FROM (SELECT item_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS g FROM benchmark)")
def propagated_labels(t, spark):
    n = _noisy(t).select("item_id", F.split("gt", " ").alias("a"), F.split("noise", " ").alias("b"))
    labels = F.transform("a", lambda x, i: F.when(i % 3 == 1, "B-X").otherwise("O"))
    return n.select("item_id", align.propagated(labels, "a", "b").alias("labels"))


@query("""
WITH RECURSIVE e AS (SELECT user_id, ['O', 'B-A', 'I-A', 'I-B', 'B-C'][(event_id * 7 + user_id) % 5 + 1] AS x, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
f AS (SELECT user_id, i, CASE WHEN x LIKE 'I-%' THEN 'B' || substr(x, 2) ELSE x END AS y, CASE WHEN x = 'O' THEN '' ELSE substr(x, 3) END AS open FROM e WHERE i = 1
      UNION ALL SELECT e.user_id, e.i, CASE WHEN x LIKE 'I-%' AND f.open <> substr(x, 3) THEN 'B' || substr(x, 2) ELSE x END, CASE WHEN x = 'O' THEN '' ELSE substr(x, 3) END FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT user_id, string_agg(y, ' ' ORDER BY i) AS labels FROM f GROUP BY user_id
""")
def orphan_label_fix(t, spark):
    raw = F.element_at(F.array(*map(F.lit, ["O", "B-A", "I-A", "I-B", "B-C"])), ((F.col("event_id") * 7 + F.col("user_id")) % 5 + 1).cast("int"))
    rows = t("events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", raw.alias("x")))), lambda e: e["x"]).alias("raw"))
    return rows.select("user_id", F.array_join(align.corrected_labels(F.col("raw")), " ").alias("labels"))


@query("""
WITH t AS (SELECT item_id, unnest(string_split(text, ' ')) AS w FROM benchmark), c AS (SELECT item_id, lower(w) AS l, count(*) AS n FROM t WHERE w <> '' GROUP BY ALL)
SELECT b.item_id, (count(*) FILTER (n = 1))::INT AS n FROM benchmark b LEFT JOIN c USING (item_id) GROUP BY b.item_id
""")
def unique_words(t, spark):
    return t("benchmark").select("item_id", F.size(align.unique_words(F.filter(F.split("text", " "), lambda w: w != ""))).alias("n"))


# --- generated bills, their layout and page images ---


def _bills(t):
    return documents.receipts(t("orders").select(F.col("o_orderkey").alias("seed")))


def _u(name: str) -> str:
    return _U.format(key=f"seed || ':' || {name}")


_GOODS = "[{'name': 'rice', 'price': 18000}, {'name': 'milk', 'price': 32000}, {'name': 'tea', 'price': 25000}, {'name': 'soap', 'price': 14000}, {'name': 'paper', 'price': 6000}, {'name': 'fish', 'price': 76000}]"
#: The bills as the generator draws them, in SQL: i has their items, b their sums.
_BILLS = f"""
WITH g AS (SELECT o_orderkey AS seed, unnest({_GOODS}) AS g FROM orders),
d AS (SELECT seed, g.name AS name, {_u("g.name || ':place'")} AS place, 1 + floor({_u("g.name || ':qty'")} * 9)::BIGINT AS qty, (round_even(g.price * (0.8::DOUBLE + 0.4::DOUBLE * {_u("g.name || ':unit'")}) / 500, 0) * 500)::BIGINT AS unit,
      [0.0, 0.05, 0.1][(1 + floor({_u("g.name || ':rate'")} * 3))::INT]::DOUBLE AS rate, 1 + floor({_u("'n'")} * 6)::INT AS n, [0.0, 0.0, 0.05][(1 + floor({_u("'discount'")} * 3))::INT]::DOUBLE AS off FROM g),
i AS (SELECT *, qty * unit AS price FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY place, name) AS k FROM d) WHERE k <= n),
s AS (SELECT seed, sum(price)::BIGINT AS subtotal, max(off) AS off, round_even(coalesce(sum(price) FILTER (rate = 0.05::DOUBLE), 0)::BIGINT * 0.05::DOUBLE, 0)::BIGINT + round_even(coalesce(sum(price) FILTER (rate = 0.1::DOUBLE), 0)::BIGINT * 0.1::DOUBLE, 0)::BIGINT AS tax FROM i GROUP BY seed),
b AS (SELECT seed, subtotal, round_even(subtotal * off, 0)::BIGINT AS discount, tax, subtotal - round_even(subtotal * off, 0)::BIGINT + tax AS grand FROM s)
"""
_DOTS = "replace(format('{{:,}}', {}), ',', '.')"


@query(_BILLS + f"""
, m AS (SELECT seed, string_agg('{{"nm":"' || name || '","cnt":"' || qty || '","unitprice":"' || {_DOTS.format("unit")} || '","price":"' || {_DOTS.format("price")} || '"}}', ',' ORDER BY k) AS menu FROM i GROUP BY seed)
SELECT seed, '{{"store":{{"name":"store ' || seed % 17 || '"}},"menu":[' || menu || '],"total":{{"subtotal":"' || {_DOTS.format("subtotal")} || CASE WHEN discount > 0 THEN '","discount":"' || {_DOTS.format("discount")} ELSE '' END || '","total":"' || {_DOTS.format("grand")} || '"}}}}' AS label FROM b JOIN m USING (seed)
""")
def generated_receipts(t, spark):
    return documents.ground_truth(_bills(t))


@query("SELECT o_orderkey AS seed, CASE WHEN o_orderkey % 35 = 0 THEN ['subtotal', 'change'] WHEN o_orderkey % 5 = 0 THEN ['subtotal', 'grand'] ELSE ['grand', 'change'] END AS problems FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0")
def receipt_problems(t, spark):
    k = F.col("seed")
    bills = _bills(t).withColumn("subtotal", F.col("subtotal") + (k % 5 == 0).cast("int")).withColumn("grand", F.col("grand") + (k % 7 == 0).cast("int"))
    return documents.receipt_problems(bills)


@query(_BILLS + f"""
SELECT seed, k::INT AS row FROM i WHERE length(name || ' x' || qty) > 13 - length({_DOTS.format('price')})
UNION ALL SELECT seed, n + 1 FROM b JOIN (SELECT seed, max(n)::INT AS n FROM i GROUP BY seed) USING (seed) WHERE length('total') > 13 - length({_DOTS.format('grand')})
""")
def layout_overflow(t, spark):
    return documents.cell_overflow(documents.cells(_bills(t), 13), 13).select("seed", "row")


@query()
def image_effects(t, spark):
    page = F.rpad(F.lit("").cast("binary"), 64 * 48, F.lit(bytearray([230])))
    rows = t("nation").select("n_nationkey", page.alias("image"))
    out = rows.select("n_nationkey", *[documents.degraded(n)(F.col("image"), F.lit(64), F.col("n_nationkey")).alias(n) for n in documents.EFFECTS])
    return out.select("n_nationkey", *[F.sha2(n, 256).alias(n) for n in documents.EFFECTS])


@query()
def image_chains(t, spark):
    """A page with a dark part, through chains that hold every action at least once."""
    page = F.concat(*[F.rpad(F.lit("").cast("binary"), n, F.lit(bytearray([v]))) for n, v in ((640, 230), (320, 20), (576, 230))])
    chains = {n: [(n, {})] for n in images.ACTIONS} | {"aged": [("ink_decay", {"level": 5}), ("show_through", {}), ("gaussian_blur", {"radius": 1}), ("overlay_weighted", {"background": images.ORIGINAL, "alpha": 0.7, "beta": 0.3})]}
    rows = t("nation").select("n_nationkey", page.alias("image"))
    out = rows.select("n_nationkey", *[images.chained(c)(F.col("image"), F.lit(64), F.col("n_nationkey")).alias(n) for n, c in chains.items()])
    return out.select("n_nationkey", *[F.sha2(n, 256).alias(n) for n in chains])


_CLEAN = "SELECT item_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS g FROM benchmark"


def _gaps(t):
    return align.gap_runs(_noisy(t).withColumn("p", align.aligned("gt", "noise")), "p")


@query(f"SELECT item_id, 0 AS \"insert\", 0 AS \"delete\", len(regexp_extract_all(g, 't+'))::INT AS replace, 0 AS spacing FROM ({_CLEAN})")
def gap_stats(t, spark):
    return align.gap_stats(_gaps(t), "item_id")


@query(f"SELECT src, replace(src, 't', 'ł') AS target, count(*) AS n FROM (SELECT unnest(regexp_extract_all(g, 't+')) AS src FROM ({_CLEAN})) GROUP BY src")
def substitutions(t, spark):
    return align.substitutions(_gaps(t))


@query("SELECT conv_id, string_agg(coalesce(text, ''), ' ' ORDER BY turn DESC, role) AS page FROM conversations GROUP BY conv_id")
def reading_order(t, spark):
    lines = F.array_sort(F.collect_list(F.struct((-F.col("turn")).alias("top"), "role", F.coalesce("text", F.lit("")).alias("text"))))
    return t("conversations").groupBy("conv_id").agg(lines.alias("lines")).select("conv_id", files.reading_order(F.col("lines"), F.lit("")).alias("page"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(url, '^.*/', ''), '(.)\.[^.]*$', '\1') AS stem FROM pages")
def file_stems(t, spark):
    return t("pages").select("page_id", files.stem(F.col("url")).alias("stem"))


@query("SELECT c_mktsegment AS backend, count(*) AS n, count(DISTINCT c_custkey) AS seeds, count(DISTINCT sha256(c_name)) AS labels FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1) GROUP BY 1")
def assembled_shards(t, spark):
    records = t("customer").select(F.col("c_nationkey").alias("shard"), F.col("c_mktsegment").alias("backend"), F.col("c_custkey").alias("seed"), "c_name")
    planned = t("nation").select(F.col("n_nationkey").alias("shard"), "n_regionkey")
    done, _ = files.finished(planned.where("n_regionkey <> 1"), planned)
    return files.assembled(records, done, "c_name")[1]


# --- markup of sheets ---

_ESC = """replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;')"""


@query(f"""SELECT doc_id, CASE WHEN regexp_matches(text, '[^\\t\\n\\x0B\\f\\r ]') THEN '<span data-kind="text">' || {_ESC.format('text')} || '</span>' ELSE '' END AS markup FROM documents""")
def labelled_markup(t, spark):
    return t("documents").select("doc_id", markup.labelled(F.lit("text"), F.col("text")).alias("markup"))


@query("""SELECT l_orderkey, l_linenumber, '<td data-cell="item" data-row="' || l_linenumber || '" data-col="0"' || CASE WHEN l_linenumber > 1 THEN ' colspan="' || l_linenumber || '"' ELSE '' END || '>' || l_returnflag || '</td>' AS cell FROM lineitem""")
def cell_markup(t, spark):
    n = F.col("l_linenumber")
    return t("lineitem").select("l_orderkey", "l_linenumber", markup.table_cell("td", n, F.lit(0), F.col("l_returnflag"), F.lit("item"), n).alias("cell"))


@query("""SELECT c_custkey, '<div class="f dot"><span class="k"><span data-kind="invoice.field.label">' || c_mktsegment || '</span></span><span class="v"><span data-kind="invoice.field">' || c_name || '</span></span></div>' AS line FROM customer""")
def field_lines(t, spark):
    return t("customer").select("c_custkey", markup.field_line(F.col("c_mktsegment"), F.col("c_name"), dotted=True).alias("line"))


_SHEET = "SELECT o_custkey AS sheet, o_orderkey AS pos, (o_orderkey % 13)::INT AS width FROM orders"


def _sheet(t):
    return t("orders").select(F.col("o_custkey").alias("sheet"), F.col("o_orderkey").alias("pos"), (F.col("o_orderkey") % 13).cast("int").alias("width"))


@query(f"""
WITH w AS (SELECT *, CASE WHEN width = 0 THEN greatest(76 - sum(width) OVER (PARTITION BY sheet), 8) ELSE width END AS w FROM ({_SHEET})),
u AS (SELECT *, sum(w) OVER (PARTITION BY sheet ORDER BY pos) AS u, pos = max(pos) OVER (PARTITION BY sheet) AS ends FROM w)
SELECT sheet, pos, width, least(u - w + 2, 78)::INT AS col0, (CASE WHEN ends THEN 78 ELSE least(u + 2, 78) - 3 END)::INT AS col1 FROM u
""")
def column_spans(t, spark):
    return markup.column_spans(_sheet(t), "sheet", "pos", "width", 80, 3, 2)


@query(f"""
WITH f AS (SELECT *, sum(width) OVER (PARTITION BY sheet) AS fixed, count(*) FILTER (width = 0) OVER (PARTITION BY sheet) AS free FROM ({_SHEET})),
p AS (SELECT *, CASE WHEN width = 0 THEN 100.0::DOUBLE * greatest(80 - fixed, free * 8) / free / 80 ELSE 100.0::DOUBLE * width / 80 END AS p FROM f)
SELECT sheet, pos, width, round(p + CASE WHEN pos = min(CASE WHEN width = 0 THEN pos END) OVER (PARTITION BY sheet) THEN 100 - sum(p) OVER (PARTITION BY sheet) ELSE 0 END, 6) + 0.0 AS pct FROM p
""")
def column_percents(t, spark):
    return markup.column_percents(_sheet(t), "sheet", "pos", "width", 80).withColumn("pct", F.round("pct", 6) + 0.0)
