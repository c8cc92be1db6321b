"""Arithmetic of bills: tax by rate, summaries with all rates, block headings, insurance shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tax_by_rate(lines: DataFrame, key: str, rate: str, amount: Column) -> DataFrame:
    """(key, rate, net, tax): tax is rounded once per rate, half to even, not per line."""
    net = lines.groupBy(key, rate).agg(F.round(F.sum(amount), 2).alias("net"))
    return net.withColumn("tax", F.bround(F.col("net").cast("decimal(18,2)") * F.col(rate).cast("decimal(6,4)"), 2).cast("double"))


def tax_summary(lines: DataFrame, rates: Sequence[float], rate: str, amount: Column) -> DataFrame:
    """(rate, net, lines): every rate of the form, also those without lines, and a total row with a null rate."""
    spark = lines.sparkSession
    form = F.broadcast(spark.createDataFrame([(float(r),) for r in rates], f"{rate} double"))
    per = lines.groupBy(rate).agg(F.round(F.sum(amount), 2).alias("net"), F.count("*").alias("lines"))
    rows = form.join(per, rate, "left").select(rate, F.coalesce("net", F.lit(0.0)).alias("net"), F.coalesce("lines", F.lit(0)).alias("lines"))
    total = lines.agg(F.round(F.sum(amount), 2).alias("net"), F.count("*").alias("lines")).select(F.lit(None).cast("double").alias(rate), "net", "lines")
    return rows.unionByName(total)


def headings(lines: DataFrame, outer: str, inner: str, amount: str) -> DataFrame:
    """(outer, inner, level, amount): block sums as heading rows over their parts, and the grand total."""
    level = F.grouping_id(outer, inner).cast("int")
    return lines.rollup(outer, inner).agg(level.alias("level"), F.round(F.sum(amount), 2).alias("amount"), F.count("*").alias("n"))


def insured(amount_full: Column, amount_allowed: Column, benefit: Column, waived: Column) -> list[Column]:
    """fund, copay, other and own share of a hospital line."""
    fund = F.bround(amount_allowed * benefit / 100, 0)
    copay = amount_allowed - fund
    other = F.when(waived, amount_full).otherwise(0.0)
    own = copay + F.when(waived, 0.0).otherwise(amount_full - amount_allowed)
    return [fund.alias("fund"), copay.alias("copay"), other.alias("other_pay"), own.alias("self_pay")]


def nights(stays: DataFrame, start: str, count: str) -> DataFrame:
    """One row per night of a stay, numbered from 1."""
    days = F.sequence(F.to_date(start), F.date_add(F.to_date(start), F.col(count).cast("int") - 1))
    return stays.where(F.col(count) > 0).select("*", F.posexplode(days).alias("k", "night")).withColumn("no", F.col("k") + 1).drop("k")
