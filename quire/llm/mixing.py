"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame functions only.

Every source gets a target number of words. The mix is a sequence of slots of equal length; slot i
belongs to the source in whose share of the unit interval the i-th golden-ratio point falls, so any
stretch of the mix holds the sources in nearly their shares. A source's documents are shuffled by the
MD5 of their id, laid end to end (again and again where the target is above the source's size), and
cut into blocks of a slot's length; the block of rank r goes to the source's slot of rank r.

No window holds a whole source: ranks and offsets are sums over chunks plus a rank inside a chunk.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, bounded_broadcast, cut

WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its words.
REPEATS = 3
#: frac of the golden ratio, and of 2**20 times it; slot numbers are split there so that doubles stay exact enough.
PHI, PHI_HIGH, HALF = 0.6180339887498949, 0.9103900894050673, 1 << 20
#: Slots of one rank window, and cells that the unit interval is cut into for the join of points and shares.
CHUNK, CELLS = 1 << 14, 1024
#: Source tables of at most so many rows are broadcast; larger ones are joined by a shuffle.
SMALL = 5_000


def block_words(total: int) -> int:
    """Words of a slot: small enough for a million slots, and never above 4096."""
    return max(1, min(4096, total >> 20))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): size is the number of words, 0 for a null text."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(src, source, source_size, target): src counts the sources by code point, null last.

    The total of all sizes is shared by weight; what is above repeats times a source's size goes to
    the others by weight, until none is above. That is one level of water: sorted by the level at
    which they are full, sources fill up until the level that remains is below the next one's.
    """
    w = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = w.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = w.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")).cast("double"))
    w = w.withColumn("cap", F.col("source_size") * repeats).withColumn("full", F.col("cap") / F.col("w"))
    by = Window.orderBy("full", "src")
    before, every = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    w = w.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    w = w.withColumn("open", F.col("full") > F.col("level"))
    w = w.withColumn("level", F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.struct("full", "src"))).over(every))
    return w.select("src", "source", "source_size", F.when(F.col("open"), F.col("w") * F.col("level")).otherwise(F.col("cap").cast("double")).alias("target"))


def schedule(shares: DataFrame, slots: int) -> DataFrame:
    """(slot, src, rank): the source of each slot and the slot's rank among that source's.

    shares (src, lo, hi, total): the source's part [lo, hi) of the whole [0, total), in words.
    """
    spark = shares.sparkSession
    slot = spark.range(slots).withColumnRenamed("id", "slot")
    high = F.floor(F.col("slot") / HALF).cast("double") * PHI_HIGH
    x = (high - F.floor(high)) + (F.col("slot") % HALF).cast("double") * PHI
    points = slot.withColumn("x", x - F.floor(x)).withColumn("cell", F.floor(F.col("x") * CELLS))
    cell = lambda c: F.floor(F.col(c).cast("double") * CELLS / F.col("total"))
    cells = shares.where("hi > lo").select("src", "lo", "hi", "total", F.explode(F.sequence(cell("lo") - 1, cell("hi") + 1)).alias("cell"))
    cells = cells if slots == 0 else bounded_broadcast(cells, CELLS + 3 * SMALL)
    p = F.col("x") * F.col("total")
    owned = points.join(cells, "cell").where((p >= F.col("lo")) & (p < F.col("hi"))).select("slot", "src", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    owned = owned.withColumn("r", F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1)
    runs = owned.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    runs = runs.select("src", "chunk", F.coalesce(F.sum("n").over(Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return owned.join(runs, ["src", "chunk"]).select("slot", "src", (F.col("before") + F.col("r")).alias("rank"))


@dataclass
class Mix:
    sources: DataFrame  # src, source, source_size, target
    documents: DataFrame  # doc_id, src, size, start (of the document in its source's shuffled words), no
    schedule: DataFrame  # slot, src, rank
    pieces: DataFrame  # slot, src, rank, no, doc_id, start, from_word, to_word (in the repeated document)
    words: int  # of a slot


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> Mix:
    """The mix of docs (doc_id, source, text).

    Null sources are one source, the last. Null and empty texts have size 0 and give no words. A table
    without words gives no slots. Repeated rows are documents of their own; ties in the shuffle (equal
    ids) go by size, and rows equal in that too are interchangeable. Reruns give the same mix.
    """
    raw = cut(measured(docs).withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    sources = cut(targets(raw, weights, repeats))
    total = sources.agg(F.coalesce(F.sum(F.floor("target")), F.lit(0))).first()[0]
    words = block_words(total)
    small = bounded_broadcast(sources, SMALL)
    sized = raw.join(small.select("src", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "src", "size", "key", F.substring("key", 1, 3).alias("bin"))
    bins = sized.groupBy("src", "bin").agg(F.sum("size").alias("n"))
    bins = bins.select("src", "bin", F.coalesce(F.sum("n").over(Window.partitionBy("src").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("src", "bin").orderBy("key", "doc_id", "size")
    sized = sized.withColumn("s", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("no", F.row_number().over(inside))
    placed = cut(sized.join(bins, ["src", "bin"]).select("doc_id", "src", "size", (F.col("before") + F.col("s")).alias("start"), F.concat_ws(":", "bin", "no").alias("no")))

    hi = F.sum(F.floor("target").cast("long")).over(Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0))
    shares = sources.select("src", (hi - F.floor("target")).alias("lo"), hi.alias("hi"), F.lit(total).alias("total"))
    slots = -(-total // words)
    plan = cut(schedule(shares, slots))
    # A share below a slot may hold no point: such a source gets a slot after all others, cut at its target.
    without = shares.where("hi > lo").join(plan.select("src").distinct(), "src", "left_anti")
    late = without.select((F.row_number().over(Window.orderBy("src")) - 1 + slots).cast("bigint").alias("slot"), "src", F.lit(0).cast("bigint").alias("rank"))
    plan = cut(plan.unionByName(late))
    taken = plan.groupBy("src").agg(F.count("*").alias("slots"), F.max(F.col("slot") >= slots).alias("late"))
    words_of = F.when(F.col("late"), F.floor("target")).otherwise(F.col("slots") * words)
    limits = bounded_broadcast(cut(sources.join(taken, "src").select("src", "source_size", F.least(words_of, F.col("source_size") * repeats).alias("end"))), SMALL)
    laps = placed.where("size > 0").join(limits, "src").select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("lap"))
    laps = laps.withColumn("a", F.col("lap") * F.col("source_size") + F.col("start")).where("a < end").withColumn("z", F.least(F.col("a") + F.col("size"), "end"))
    blocks = laps.select("*", F.explode(F.sequence(F.floor(F.col("a") / words), F.floor((F.col("z") - 1) / words))).alias("rank"))
    cutout = blocks.select(
        "src", "rank", "no", "doc_id", "start",
        (F.greatest("a", F.col("rank") * words) - F.col("a") + F.col("lap") * F.col("size")).alias("from_word"),
        (F.least("z", (F.col("rank") + 1) * words) - F.col("a") + F.col("lap") * F.col("size")).alias("to_word"),
    )
    return Mix(sources, placed, plan, cutout.join(plan, ["src", "rank"]), words)


def amounts(m: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per document: the words that the mix takes of it."""
    taken = m.pieces.groupBy("src", "no").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("n"))
    rows = m.documents.join(taken, ["src", "no"], "left").join(bounded_broadcast(m.sources, SMALL), "src")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("n", F.lit(0)).alias("taken"))


def resampled(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """docs as the mix takes them: each whole document as many times as its words go into the words taken, rounded.

    Documents of which less than half is taken, and those without words, go. Rows that share a doc_id
    are taken alike; rows with a null doc_id share one key too.
    """
    copies = amounts(mix(docs, weights, repeats)).groupBy("doc_id").agg(F.sum("taken").alias("t"), F.sum("size").alias("n"))
    copies = copies.where("2 * t >= n and n > 0").select(F.col("doc_id").alias("of"), F.round(F.col("t") / F.col("n")).cast("int").alias("copies"))
    rows = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("of")))
    return rows.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select(docs.columns)
