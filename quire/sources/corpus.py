"""Word lists by language and profile: goods, catalogues, shops, footers, people, streets, wards, payments.

Lines are trimmed; blank ones and # comments go, and of tab-separated files the lines with another number
of columns. A table's name says its file: ``items_<profile>.txt`` and so on, in a folder per language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of each kind of list; those of a profile come as <kind>_<profile>.txt.
COLUMNS = {"items": "name, low, high", "catalogue": "name, low, high", "shops": "name, branch", "footers": "line", "people": "name", "streets": "name", "wards": "ward, district, city", "payments": "label, method"}
SHARED, PROFILED = ("streets", "wards", "payments", "people"), ("items", "shops", "footers")


def lists(spark: SparkSession, root: str) -> DataFrame:
    """(lang, kind, profile, line_no, parts): every list under root, read once; a shared list's profile is empty."""
    raw = spark.read.text(f"{root}/*/*.txt", wholetext=True).select(F.input_file_name().alias("path"), "value")
    name = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    lines = raw.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("lang"), F.substring_index(name, "_", 1).alias("kind"), F.when(name.contains("_"), F.regexp_extract(name, "_(.*)$", 1)).otherwise("").alias("profile"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    line = F.trim("line")
    return lines.where((line != "") & ~line.startswith("#")).select("lang", "kind", "profile", "line_no", F.transform(F.split(line, "\t"), lambda x: F.trim(x)).alias("parts"))


def table(all_lists: DataFrame, kind: str, lang: str, profile: str = "") -> DataFrame:
    """One list with the columns of its kind. A shop may have no branch; low and high are whole numbers."""
    names = COLUMNS[kind].split(", ")
    own = all_lists.where((F.col("kind") == kind) & (F.col("lang") == lang) & (F.col("profile") == profile))
    size = F.size("parts")
    if kind == "shops":
        tabbed = own.agg(F.max(size)).first()[0] or 0
        own = own.where(size == (2 if tabbed > 1 else 1))
    else:
        own = own.where(size == len(names)) if len(names) > 1 else own.withColumn("parts", F.array(F.array_join("parts", "\t")))
    out = own.orderBy("line_no").select("line_no", *[F.get("parts", i).alias(n) for i, n in enumerate(names)])
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("low", "high") if c in names})


def languages(all_lists: DataFrame) -> DataFrame:
    return all_lists.select("lang").distinct().orderBy("lang")


def problems(all_lists: DataFrame) -> DataFrame:
    """(lang, list, problem): shared lists that a language lacks, lists that a profile lacks (items make a profile), and
    lists without a usable line."""
    wide = {k: len(c.split(", ")) for k, c in COLUMNS.items()}
    least = F.create_map(*[x for k, n in wide.items() for x in (F.lit(k), F.lit(1 if k == "shops" or n == 1 else n))])
    fits = F.when(F.col("kind") == "shops", F.size("parts") <= 2).when(F.try_element_at(least, F.col("kind")) == 1, True).otherwise(F.size("parts") == F.try_element_at(least, F.col("kind")))
    have = all_lists.groupBy("lang", "kind", "profile").agg(F.count_if(fits).alias("usable"))
    langs = all_lists.select("lang").distinct()
    profiles = have.where("kind = 'items'").select("lang", "profile")
    named = lambda kinds: F.explode(F.array(*map(F.lit, kinds))).alias("kind")
    wanted = langs.select("lang", named(SHARED), F.lit("").alias("profile")).unionByName(profiles.select("lang", named(PROFILED), "profile"))
    name = F.concat_ws("_", "kind", F.nullif("profile", F.lit("")))
    lacking = wanted.join(have, ["lang", "kind", "profile"], "left").select("lang", name.alias("list"), F.when(F.col("usable").isNull(), "missing").when(F.col("usable") == 0, "no usable line").alias("problem")).where("problem is not null")
    bare = langs.join(profiles, "lang", "left_anti").select("lang", F.lit("items").alias("list"), F.lit("no profile").alias("problem"))
    return lacking.unionByName(bare)
