"""Document fingerprints by consistent weighted sampling.

A text is the multiset of its word shingles; a shingle's weight w is how often it occurs. Each of
``samples`` draws picks one (shingle, level) such that two texts pick the same with the probability of
their generalised Jaccard similarity, sum of min(w) over sum of max(w). For a shingle and a draw, r and
c are Gamma(2, 1) and b is uniform, all from the shingle's hash:

    t = floor(ln w / r + b),  ln y = r (t - b),  a = c / (y e^r)

and the least a wins. r (1 - b) and r b are independent Exp(1), so V = exp(-r (1 - b)) is uniform and
a = c V exp(-r t): a shingle that occurs once has t = 0 and needs no logarithm. The winning a names
the shingle and the level, so its bits are the sample.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tune

SAMPLES = 128
SHINGLE = 5
#: Texts that are fingerprinted together; their number goes into the top ten bits of a sort key.
TOGETHER = 256
#: The sample of a text without words.
NOTHING = 0xFFFF

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Gamma(2, 1) at the middles of n equal parts, by Newton steps on 1 - (1 + x) e^-x."""
    p = (np.arange(n) + 0.5) / n
    x = np.where(p < 0.2, np.sqrt(2 * p), -np.log1p(-p) + 1)
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), x / 2)
    return x.astype(np.float32)


class Sampler:
    """Holds what a draw needs; the same for every task and run."""

    def __init__(self, samples: int = SAMPLES, shingle: int = SHINGLE):
        self.samples, self.shingle = samples, shingle
        self.seeds = _mix(np.arange(1, samples + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
        self.gamma = _gamma_quantiles()
        byte = np.arange(256)
        self.lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint8)
        self.space = (byte == 32) | (byte >= 9) & (byte <= 13)
        self.base = _U(0xA0761D6478BD642F)
        self.inverse = _U(pow(int(self.base), -1, 1 << 64))

    def shingles(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, key, weight), sorted by text: the distinct shingles of each text that has words."""
        raw = self.lower[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
        gap = self.space[raw]
        edge = np.diff(np.concatenate(([True], gap)).astype(np.int8))
        begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(begin):
            return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64)
        # Hashes of all words: differences of one running polynomial, brought to a common power.
        power = np.cumprod(np.full(len(raw), self.base))
        run = np.concatenate((np.zeros(1, _U), np.cumsum((raw.astype(_U) + _U(1)) * power)))
        down = np.cumprod(np.full(len(raw), self.inverse))
        word = _mix((run[end] - run[begin]) * down[begin] + (end - begin).astype(_U))
        limits = np.cumsum([len(t) + 1 for t in texts])
        of = np.searchsorted(limits, begin, "right")
        first = np.searchsorted(of, np.arange(len(texts)))
        count = np.diff(np.concatenate((first, [len(of)])))
        size = np.minimum(count, self.shingle)
        start = np.flatnonzero(np.arange(len(of)) <= (first + count - size)[of])
        text = of[start]
        key = np.zeros(len(start), _U)
        for j in range(self.shingle):
            there = j < size[text]
            key = np.where(there, (key + word[np.minimum(start + j, len(word) - 1)]) * _U(0x9FB21C651E98DF25) ^ key >> _U(29), key)
        key = np.sort((text.astype(_U) << _U(54)) | (_mix(key) >> _U(10)))
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        weight = np.diff(np.concatenate((new, [len(key)])))
        key = key[new]
        return (key >> _U(54)).astype(np.int64), _mix(key & _U((1 << 54) - 1)), weight

    def signatures(self, texts: list[bytes]) -> np.ndarray:
        """One row of 16-bit samples for each text."""
        out = np.full((len(texts), self.samples), NOTHING, np.uint16)
        for at in range(0, len(texts), TOGETHER):
            part = out[at : at + TOGETHER]
            text, key, weight = self.shingles(texts[at : at + TOGETHER])
            if not len(text):
                continue
            first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
            many = np.flatnonzero(weight > 1)
            log_w = np.log(weight[many].astype(np.float32))
            x, y, v = np.empty_like(key), np.empty_like(key), np.empty(len(key), np.float32)
            for k, seed in enumerate(self.seeds):
                np.multiply(key, seed, out=x)
                np.right_shift(x, _U(29), out=y)
                np.bitwise_xor(x, y, out=x)
                np.multiply(x, _U(0xD6E8FEB86659FD93), out=x)
                halves = x.view(np.uint32)
                v[:] = halves[1::2]
                v += np.float32(0.5)
                v *= np.float32(2.0**-32)
                a = self.gamma[x.view(np.uint16)[::4]]
                a *= v
                if len(many):
                    up = -np.log(v[many])  # r (1 - b)
                    rest = (_mix(x[many]) >> _U(40)).astype(np.float32)
                    r = up - np.log((rest + np.float32(0.5)) * np.float32(2.0**-24))  # plus r b
                    t = np.floor(log_w / r + (1 - up / r))
                    a[many] *= np.exp(-r * t)
                least = np.minimum.reduceat(a, first).view(np.uint32)
                part[text[first], k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal samples: an estimate of the generalised Jaccard similarity."""
    return float((a == b).mean())


def fingerprint_hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """text with its last floor(n / 2) code points replaced by the first as many, or all, of following."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def _bucket(of: Column, cuts: list[int]) -> Column:
    """How many of the ascending cuts are at most of, by binary search; 0 for null."""
    if not cuts:
        return F.lit(0)
    array = F.array(*map(F.lit, cuts))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda lo, s: F.when((lo + s <= len(cuts)) & (F.get(array, lo + s - 1) <= of), lo + s).otherwise(lo))


def in_order(docs: DataFrame) -> DataFrame:
    """(bucket, tail, doc_id, text): docs in ascending doc_id, in ranges, each range one partition and
    followed by the first row of the next, marked as tail; after the last comes the very first.

    One shuffle. The driver gets two numbers per range. Null ids come first; ties go by text, nulls first.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], F.lit(max(10_000, 50 * n)))).first()[0] or []
    cuts = sorted(set(parts)) if n > 1 else []
    placed = docs.withColumn("bucket", _bucket(F.col("doc_id"), cuts).cast("int"))
    found = placed.groupBy("bucket").agg(F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect()
    found = sorted((r.bucket, None if r.nulls else r.first) for r in found)
    tails = {first: found[i - 1][0] for i, (_, first) in enumerate(found)}
    named = {k: b for k, b in tails.items() if k is not None}
    heads = docs.where(F.col("doc_id").isin(list(named)) if named else F.lit(False))
    lookup = F.create_map(*[F.lit(x) for kb in named.items() for x in kb]) if named else None
    extra = heads.select("doc_id", "text", (F.element_at(lookup, F.col("doc_id")) if named else F.lit(0)).cast("int").alias("bucket"))
    if None in tails:
        extra = extra.unionByName(docs.where("doc_id is null").withColumn("bucket", F.lit(tails[None]).cast("int")))
    rows = placed.withColumn("tail", F.lit(0)).unionByName(extra.withColumn("tail", F.lit(1)))
    return rows.repartitionById(len(cuts) + 1, "bucket").sortWithinPartitions("bucket", "tail", "doc_id", "text").select("bucket", "tail", "doc_id", "text")


def compared(docs: DataFrame, samples: int = SAMPLES, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of docs (doc_id, text, ...).

    One row per row. A null text is the empty one. Texts without words have one fingerprint of their own,
    like each other (1) and unlike any other (0 but for chance in 1 of 65,536 samples). Null ids come
    first; rows that share an id are ordered by text, so repeated rows follow each other. A single row
    is its own next. An empty table gives no rows.
    """
    tune(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples, shingle)
        held: list[tuple[int, str]] = []  # of one bucket, without a follower so far
        bucket, ended, chars = None, True, 0

        def finished(rows: list[tuple[int, str]]) -> pa.RecordBatch:
            """Of all rows but the last, which only follows."""
            texts = [t for _, t in rows]
            changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:], strict=False)]
            sig = sampler.signatures([t.encode() for t in texts] + changed)
            own, new = sig[: len(texts)], sig[len(texts) :]
            m = len(changed)
            columns = [
                [i for i, _ in rows[:m]], [len(t) for t in texts[:m]], [hashlib.sha256(c).hexdigest() for c in changed],
                list(map(fingerprint_hex, own[:m])), list(map(fingerprint_hex, new)),
                (own[:m] == new).mean(axis=1), (own[:m] == own[1:]).mean(axis=1),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for b, tail, i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    bucket, ended, held, chars = b, False, [], 0
                if ended:  # more rows with the id of the first tail
                    continue
                held.append((i, t or ""))
                ended = tail == 1
                chars += len(held[-1][1])
                if ended or len(held) > TOGETHER // 2 or chars > 1 << 20:
                    if len(held) > 1:
                        yield finished(held)
                    held = held[-1:]
                    chars = len(held[0][1])

    return in_order(docs).mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
