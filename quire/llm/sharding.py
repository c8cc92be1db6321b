"""Sharding through fixed virtual slots.

A record's hash names one of some thousand slots, for ever. A versioned map says which shard holds
which slot. The map is made from the slots' bytes so that shards are nearly equal, and it is edited,
not remade: balancing moves a few slots, growing hands slots to the new shard only.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

SLOTS = 4096
SHARDS = 16


@dataclass(frozen=True)
class SlotMap:
    """slot -> shard. Every edit is a new version that knows what it moved."""

    shard: tuple[int, ...]
    shards: int
    version: int = 1
    moved: tuple[int, ...] = field(default=())

    @classmethod
    def packed(cls, size: list[int], shards: int) -> SlotMap:
        """The largest slot first, each to the shard that has least so far; ties go to the lowest numbers."""
        heap = [(0, s) for s in range(shards)]
        out = [0] * len(size)
        for slot in sorted(range(len(size)), key=lambda i: (-size[i], i)):
            load, s = heapq.heappop(heap)
            out[slot] = s
            heapq.heappush(heap, (load + size[slot], s))
        return cls(tuple(out), shards)

    def loads(self, size: list[int]) -> list[int]:
        out = [0] * self.shards
        for slot, s in enumerate(self.shard):
            out[s] += size[slot]
        return out

    def _with(self, changed: dict[int, int], shards: int) -> SlotMap:
        return SlotMap(tuple(changed.get(i, s) for i, s in enumerate(self.shard)), shards, self.version + 1, tuple(sorted(changed)))

    def rebalanced(self, size: list[int], tolerance: float = 0.02) -> SlotMap:
        """Slots move from the fullest to the emptiest shard until they are within tolerance of the mean, or none helps."""
        load, mean, changed = self.loads(size), sum(size) / self.shards, {}
        at = list(self.shard)
        while True:
            top, low = max(range(self.shards), key=lambda s: load[s]), min(range(self.shards), key=lambda s: load[s])
            gap = load[top] - load[low]
            if gap <= tolerance * mean:
                break
            fit = [i for i, s in enumerate(at) if s == top and 0 < size[i] < gap]
            if not fit:
                break
            best = min(fit, key=lambda i: (abs(gap / 2 - size[i]), i))
            at[best] = changed[best] = low
            load[top] -= size[best]
            load[low] += size[best]
        return self._with({i: s for i, s in changed.items() if s != self.shard[i]}, self.shards)

    def grown(self, size: list[int]) -> SlotMap:
        """One more shard: it takes slots from the fullest shards until it holds the mean; nothing else moves."""
        load, share, changed, new = self.loads(size), sum(size) / (self.shards + 1), {}, 0
        of: dict[int, list[int]] = {s: [] for s in range(self.shards)}
        for i in sorted(range(len(size)), key=lambda i: (size[i], i)):
            of[self.shard[i]].append(i)
        while new < share:
            top = max(range(self.shards), key=lambda s: load[s])
            fit = [i for i in of[top] if new + size[i] <= share * 1.01]
            if not fit:
                break
            best = fit[-1]
            of[top].remove(best)
            changed[best] = self.shards
            load[top] -= size[best]
            new += size[best]
        return self._with(changed, self.shards + 1)

    def column(self, slot: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.shard)), slot + 1)

    def save(self, spark: SparkSession, folder: str) -> None:
        """One file per version; a version that is there already is not written again."""
        row = (self.version, json.dumps({"shards": self.shards, "slots": self.shard, "moved": self.moved}))
        spark.createDataFrame([row], "version int, map string").coalesce(1).write.mode("ignore").parquet(f"{folder}/version={self.version:06d}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str, version: int) -> SlotMap:
        got = json.loads(spark.read.parquet(f"{folder}/version={version:06d}").first()["map"])
        return cls(tuple(got["slots"]), got["shards"], version, tuple(got["moved"]))


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot). Id and text are hashed together, so rows that share an id spread."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.pmod(F.xxhash64("doc_id", text), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes of each slot: as many numbers as there are slots come to the driver, whatever the rows."""
    got = {r[0]: r[1] for r in rows.groupBy("virtual_slot").agg(F.sum("size")).collect()}
    return [got.get(i, 0) for i in range(slots)]


def sharded(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> tuple[DataFrame, SlotMap]:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot) and the map.

    The law is ``bytes``: shards are of nearly equal size. slot is the record's place in its shard,
    from 0 without gaps, by virtual slot, then id, checksum and size. A null text has size 1; a null
    id is hashed as null, with its text. Repeated rows get places of their own. An empty table gives
    no rows.
    """
    rows = cut(slotted(docs, slots))
    m = SlotMap.packed(slot_bytes(rows, slots), shards)
    counts = rows.groupBy("virtual_slot").agg(F.count("*").alias("n")).withColumn("shard", m.column(F.col("virtual_slot")))
    first = counts.select("virtual_slot", "shard", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    out = rows.withColumn("place", place).join(F.broadcast(first), "virtual_slot")  # first has at most one row per slot
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"), m
