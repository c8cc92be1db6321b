"""Progress of a run, from a stream of files with counts, and restarts of its shards."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "shard string, scan bigint, images bigint"


def scans(spark: SparkSession, path: str) -> DataFrame:
    """A stream of JSON lines (shard, scan, images) that land in path."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 64).json(path)


def restarts(stream: DataFrame) -> DataFrame:
    """(shard, scan, before, images) where a shard's count falls: it began anew. The state is one count per shard."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else -1
        rows = pd.concat(list(frames)).sort_values("scan")
        out = []
        for scan, images in zip(rows["scan"], rows["images"], strict=True):
            if images < last:
                out.append((key[0], int(scan), int(last), int(images)))
            last = int(images)
        state.update((int(last),))
        yield pd.DataFrame(out, columns=["shard", "scan", "before", "images"])

    return stream.groupBy("shard").applyInPandasWithState(step, "shard string, scan bigint, before bigint, images bigint", "last bigint", "append", GroupStateTimeout.NoTimeout)


def per_window(events: DataFrame, ts: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events per type and window of a stream; what comes later than the watermark is dropped."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), "event_type").agg(F.count("*").alias("n"))


def pending(plan: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed run has still to do."""
    return plan.join(done.select(key).distinct(), key, "left_anti")
