"""Files in and out: JSON lines, TSV, IOB, word lists, job lists and split outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUAD = "array<array<double>>"
METADATA = f"file_name string, ground_truth string, recipe struct<seed:bigint,attributes:map<string,string>,tags:array<string>>, boxes array<struct<kind:string,text:string,quad:{QUAD}>>"
JOB = "layout string, seed bigint, count bigint, force map<string,string>"


def read_records(spark: SparkSession, path: str, schema: str = METADATA) -> DataFrame:
    """JSON lines of a fixed schema; a bad line stops the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lenient(spark: SparkSession, path: str) -> DataFrame:
    """(value, v): lines and what they parse to, null where one is torn."""
    return spark.read.text(path).where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))


def write_records(df: DataFrame, path: str, bad: str = "problems") -> None:
    """JSON lines; refuses rows whose problems column isn't empty, before anything is written."""
    if df.where(F.size(bad) > 0).limit(1).count():
        raise ValueError("records with problems aren't written")
    df.drop(bad).write.json(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of jobs. Unknown keys, missing seeds or counts and empty lists are errors."""
    raw = spark.read.option("multiLine", True).json(path)
    unknown = set(raw.columns) - {"layout", "seed", "count", "force"}
    if unknown or not {"seed", "count"} <= set(raw.columns):
        raise ValueError(f"jobs need seed and count, and have no {sorted(unknown)}")
    jobs = spark.read.option("multiLine", True).schema(JOB).json(path)
    if not jobs.limit(1).count() or jobs.where("seed is null or count is null").limit(1).count():
        raise ValueError("a job without seed or count, or no job at all")
    return jobs


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines; blank ones and # comments go."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> '' and not startswith(value, '#')")


def read_columns(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Tab-separated lines; those with another number of columns go. Quotes mean nothing."""
    parts = read_lines(spark, path).select(F.split("value", "\t").alias("p")).where(F.size("p") == len(names))
    return parts.select(*[F.trim(F.col("p")[i]).alias(n) for i, n in enumerate(names)])


def iob(files: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sent, pos, token, label) of IOB texts: a blank line ends a sentence."""
    lines = files.select(key, F.posexplode(F.split(text, "\n")).alias("line", "value"))
    blank = (F.trim("value") == "").cast("int")
    by = Window.partitionBy(key).orderBy("line")
    rows = lines.withColumn("sent", F.coalesce(F.sum(blank).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.trim("value") != "")
    parts = F.split("value", "\t")
    pos = F.row_number().over(Window.partitionBy(key, "sent").orderBy("line")) - 1
    return rows.select(key, F.col("sent").cast("int").alias("sent"), pos.alias("pos"), F.get(parts, 0).alias("token"), F.coalesce(F.get(parts, 1), F.lit("O")).alias("label"))


def to_iob(tokens: DataFrame, key: str) -> DataFrame:
    """(key, value): the text of tokens (key, sent, pos, token, label); sentences are parted by a blank line."""
    lines = tokens.groupBy(key, "sent").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token", "label"))), lambda t: F.concat_ws("\t", t["token"], t["label"])), "\n").alias("s"))
    return lines.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sent", "s"))), lambda x: x["s"]), "\n\n").alias("value"))


def write_split(df: DataFrame, path: str, index: str, names: list[str]) -> None:
    """Rows dealt to named splits by index, one folder each."""
    df.withColumn("split", F.element_at(F.array(*map(F.lit, names)), (F.col(index) % len(names) + 1).cast("int"))).write.partitionBy("split").json(path)


def without_blank_edge(text: Column, last: bool = False) -> Column:
    """The text without its first (or last) line if that is blank and isn't the only one."""
    lines = F.split(text, "\n")
    rest = F.slice(lines, 1, F.size(lines) - 1) if last else F.slice(lines, 2, F.size(lines))
    blank = F.trim(F.element_at(lines, -1 if last else 1)) == ""
    return F.when((F.size(lines) > 1) & blank, F.array_join(rest, "\n")).otherwise(text)


def reading_order(lines: Column, text: Column) -> Column:
    """The texts of lines (array of struct(text, top)) from the top, joined by blanks; equal tops keep their order.
    Without lines, text."""
    placed = F.array_sort(F.transform(lines, lambda x, i: F.struct(x["top"].alias("top"), i.alias("i"), x["text"].alias("text"))))
    return F.when(F.size(lines) > 0, F.array_join(F.transform(placed, lambda x: x["text"]), " ")).otherwise(text)


def stem(path: Column) -> Column:
    """A file's name without folder and last ending."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def paired(left: DataFrame, right: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """Rows of two sets of files that go by one stem, and the paths on the left that have no partner."""
    a, b = left.withColumn("stem", stem(F.col(path))), right.withColumn("stem", stem(F.col(path))).drop(path)
    return a.join(b, "stem"), a.join(b, "stem", "left_anti").select(path)


def finished(marks: DataFrame, planned: DataFrame, shard: str = "shard") -> tuple[DataFrame, DataFrame]:
    """Planned shards that have a completion mark, and those that have none."""
    done = marks.select(shard).distinct()
    return planned.join(done, shard, "left_semi"), planned.join(done, shard, "left_anti")


def assembled(records: DataFrame, done: DataFrame, label: str, shard: str = "shard", by: str = "backend") -> tuple[DataFrame, DataFrame]:
    """Records of finished shards, and per backend how many they are, of how many distinct seeds and labels."""
    rows = records.join(done.select(shard).distinct(), shard, "left_semi")
    return rows, rows.groupBy(by).agg(F.count("*").alias("n"), F.count_distinct("seed").alias("seeds"), F.count_distinct(F.sha2(label, 256)).alias("labels"))
