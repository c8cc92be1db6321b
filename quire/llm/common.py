"""What several operators of this subpackage need."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters; ``bytes.split()`` cuts at just these.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A key is hot if it has more than this part of all rows; then it is joined in so many parts. So few rows in all are
#: work for one task whatever their keys.
HOT, PARTS, FEW = 1024, 32, 20_000

#: Whether Spark deletes a query's shuffles when it ends; else they stay until the driver happens to collect garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows of one Arrow batch. Texts may be long, so it is far below Spark's default of 10,000.
BATCH_ROWS = 512


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tune(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches of the Python operators in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where Spark itself runs in one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="quire-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Queries that run in the block delete their shuffles when they end."""
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)


def cut(df: DataFrame, folder: str | None = None) -> DataFrame:
    """df written to the shared folder and read from there: its lineage ends, and a lost executor costs nothing.

    checkpoint() would end the lineage too, but keep the planner's estimate of the size. A join multiplies its sides'
    estimates, so in a loop over joins the estimate's digits double with each turn, until the driver's memory is full
    of them. What is read from files has their size. The shuffles behind df are deleted once it is written.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    with cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A cut() whose files are deleted at the end of the block. What outlives the block mustn't read them."""
    folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield lambda df: cut(df, folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcast if it has at most so many (short) rows; otherwise as it is, for a shuffled join.

    It is counted, so pass what is already cut or cheap.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def salted_join(rows: DataFrame, side: DataFrame, key: str, counted: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """rows joined with side on key, a key that holds many of the rows in PARTS parts.

    Fewer than HOT keys can be hot, so only so many are broadcast. Rows of a hot key are dealt by the hash of
    all they hold, and side's rows of it are repeated for each part. counted: rows of the same keys that are
    cheaper to count than rows are. counts: (key, n), where the keys have been counted already. Null keys find nothing.
    """
    counted = rows if counted is None else counted
    total = counted.count()
    if total <= FEW:
        return rows.join(side, key)
    counts = counted.groupBy(key).agg(F.count("*").alias("n")) if counts is None else counts
    hot = F.broadcast(counts.where(F.col("n") * HOT > total).select(key, F.lit(True).alias("_hot")))
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    mine = F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(PARTS)).cast("int")).otherwise(F.lit(0))
    left = rows.join(hot, key, "left").select(*rows.columns, mine.alias("_part"))
    right = side.join(hot, key, "left").select(*side.columns, F.explode(parts).alias("_part"))
    return left.join(right, [key, "_part"]).drop("_part")
