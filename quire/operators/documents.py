"""Seeded bills as nested rows, their layout in character cells, and effects on page images."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .sampling import uniform

GOODS = (("rice", 18000), ("milk", 32000), ("tea", 25000), ("soap", 14000), ("paper", 6000), ("fish", 76000))


def receipts(seeds: DataFrame) -> DataFrame:
    """One bill per seed (seed bigint): the same for the same seed, wherever it is made.

    Draws are hashes of the seed and a name, so a bill is a column expression: nothing leaves the JVM. The goods
    are put in the order of their draws and the first ones taken; unit prices are whole 500s.
    """
    u = lambda name: uniform(F.col("seed"), F.lit(name))
    pick = lambda name, values: F.element_at(F.array(*map(F.lit, values)), (F.floor(u(name) * len(values)) + 1).cast("int"))
    goods = []
    for name, price in GOODS:
        unit = (F.bround(price * (0.8 + 0.4 * u(f"{name}:unit")) / 500, 0) * 500).cast("bigint")
        qty = (F.floor(u(f"{name}:qty") * 9) + 1).cast("bigint")
        goods.append(F.struct(u(f"{name}:place").alias("place"), F.lit(name).alias("name"), qty.alias("qty"), unit.alias("unit"), (qty * unit).alias("price"), pick(f"{name}:rate", (0.0, 0.05, 0.1)).alias("rate")))
    taken = F.slice(F.array_sort(F.array(*goods)), 1, (F.floor(u("n") * len(GOODS)) + 1).cast("int"))
    bills = seeds.select("seed", F.concat(F.lit("store "), F.pmod("seed", F.lit(17)).cast("string")).alias("store"), F.transform(taken, lambda g: F.struct(*[g[c].alias(c) for c in ("name", "qty", "unit", "price", "rate")])).alias("items"), pick("discount", (0.0, 0.0, 0.05)).alias("_off"))
    added = lambda rate: F.aggregate("items", F.lit(0).cast("bigint"), lambda acc, i: acc + F.when(F.lit(rate is None) | (i["rate"] == F.lit(rate or 0.0)), i["price"]).otherwise(0))
    tax = sum((F.bround(added(rate) * rate, 0).cast("bigint") for rate in (0.05, 0.1)), F.lit(0).cast("bigint"))
    bills = bills.withColumn("subtotal", added(None)).withColumn("discount", F.bround(F.col("subtotal") * F.col("_off"), 0).cast("bigint")).withColumn("tax", tax)
    bills = bills.withColumn("grand", F.col("subtotal") - F.col("discount") + F.col("tax")).withColumn("paid", (F.ceil(F.col("grand") / 50000) * 50000).cast("bigint"))
    bills = bills.withColumn("change", F.col("paid") - F.col("grand")).drop("_off")
    # Behind an explode of one row each bill is made once: a filter on its sums would else be pushed below, sums and all.
    return bills.select(F.explode(F.array(F.struct(*bills.columns))).alias("bill")).select("bill.*")


def receipt_problems(bills: DataFrame) -> DataFrame:
    """(seed, problems): sums that don't hold, found again from the rows alone."""
    lines = F.aggregate("items", F.lit(0).cast("bigint"), lambda acc, i: acc + i["price"])
    checks = {
        "line": F.exists("items", lambda i: i["qty"] * i["unit"] != i["price"]),
        "subtotal": lines != F.col("subtotal"),
        "grand": F.col("subtotal") - F.col("discount") + F.col("tax") != F.col("grand"),
        "change": F.col("paid") - F.col("grand") != F.col("change"),
    }
    found = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]), lambda x: x.isNotNull())
    return bills.select("seed", found.alias("problems")).where(F.size("problems") > 0)


def ground_truth(bills: DataFrame) -> DataFrame:
    """(seed, label): the label as JSON, amounts as printed, empty parts left out."""
    money = lambda c: F.translate(F.format_number(c, 0), ",", ".")
    menu = F.transform("items", lambda i: F.struct(i["name"].alias("nm"), i["qty"].cast("string").alias("cnt"), money(i["unit"]).alias("unitprice"), money(i["price"]).alias("price")))
    total = F.struct(money(F.col("subtotal")).alias("subtotal"), F.when(F.col("discount") > 0, money(F.col("discount"))).alias("discount"), money(F.col("grand")).alias("total"))
    return bills.select("seed", F.to_json(F.struct(F.struct(F.col("store").alias("name")).alias("store"), menu.alias("menu"), total.alias("total"))).alias("label"))


def cells(bills: DataFrame, width: int = 40) -> DataFrame:
    """(seed, row, col, text): a bill's lines in character cells, names at the left and amounts at the right."""
    money = lambda c: F.translate(F.format_number(c, 0), ",", ".")
    line = lambda left, right: F.struct(left.alias("left"), right.alias("right"))
    body = F.transform("items", lambda i: line(F.concat(i["name"], F.lit(" x"), i["qty"]), money(i["price"])))
    lines = F.concat(F.array(line(F.col("store"), F.lit(""))), body, F.array(line(F.lit("total"), money(F.col("grand")))))
    rows = bills.select("seed", F.posexplode(lines).alias("row", "x"))
    left = rows.select("seed", "row", F.lit(0).alias("col"), F.col("x.left").alias("text"))
    right = rows.select("seed", "row", (F.lit(width) - F.length("x.right")).alias("col"), F.col("x.right").alias("text")).where("text <> ''")
    return left.unionByName(right)


def cell_overflow(placed: DataFrame, width: int = 40) -> DataFrame:
    """Cells that leave the page or run into the next one of their row."""
    after = F.lead("col").over(Window.partitionBy("seed", "row").orderBy("col"))
    end = F.col("col") + F.length("text")
    return placed.withColumn("end", end).withColumn("next_col", after).where((F.col("end") > width) | (F.col("end") > F.col("next_col")))


Effect = Callable[[np.ndarray, np.random.Generator], np.ndarray]
EFFECTS: dict[str, Effect] = {}


def effect(f: Effect) -> Effect:
    """Registers an effect on a grey image, floats from 0 to 255."""
    EFFECTS[f.__name__] = f
    return f


@effect
def blur(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    p = np.pad(x, 1, mode="edge")
    return sum(p[i : i + x.shape[0], j : j + x.shape[1]] for i in range(3) for j in range(3)) / 9


@effect
def salt_and_pepper(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    u = rng.random(x.shape)
    return np.where(u < 0.01, 0, np.where(u > 0.99, 255, x))


@effect
def binding_shadow(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    return x * (0.6 + 0.4 * np.minimum(1, np.arange(x.shape[1]) / max(1, x.shape[1] // 8)))[None, :]


@effect
def bleed_through(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    return np.minimum(x, 255 - 0.15 * (255 - x[:, ::-1]))


@effect
def faded_ink(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    return 255 - (255 - x) * rng.uniform(0.5, 0.9)


@effect
def holes(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    r, c = rng.integers(0, x.shape[0]), rng.integers(0, x.shape[1])
    i, j = np.ogrid[: x.shape[0], : x.shape[1]]
    return np.where((i - r) ** 2 + (j - c) ** 2 <= 9, 255, x)


def degraded(name: str) -> Callable[[Column, Column, Column], Column]:
    """A column function of (grey bytes, width, seed); what comes out depends on these alone."""
    f = EFFECTS[name]

    def run(image: pd.Series, width: pd.Series, seed: pd.Series) -> pd.Series:
        out = []
        for b, w, s in zip(image, width, seed, strict=True):
            x = np.frombuffer(b, np.uint8).astype(float).reshape(-1, int(w))
            out.append(np.clip(np.round(f(x, np.random.default_rng(int(s)))), 0, 255).astype(np.uint8).tobytes())
        return pd.Series(out)

    return F.pandas_udf(run, BinaryType())


def ink_share(pixels: np.ndarray) -> float:
    """Share of pixels clearly darker than the mean."""
    return float((pixels < pixels.mean() - 25).mean())
