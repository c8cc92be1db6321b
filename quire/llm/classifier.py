"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all it learns from; negatives are never shown. With class
prior p and a loss l, the risk of negatives among the unlabelled is R_u(-) - p R_p(-). As it can't be
negative, the non-negative risk p R_p(+) + max(0, R_u(-) - p R_p(-)) is minimised: while the second
part is below zero, the step goes the other way. The prior is estimated first: a classifier of
positives against unlabelled text ranks held-back rows, and the prior is the least ratio, over score
thresholds, of the unlabelled rows above it (with a confidence margin) to the positives above it.

The features are read from the whole text, once: rates of its characters, words and lines, and how often each
class of words and of three bytes in a row occurs, by hash. The model is linear in them, the rates each at
three scales.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tune

#: Most positives, and most unlabelled rows, that the model is fitted on.
ROWS = 4_000
#: The weights of rates, and those of the many classes, are drawn to 0 by so much.
STEPS, RATE, DECAY, CLASS_DECAY = 600, 0.05, 1e-4, 3e-3
#: Classes of words, and of three bytes.
CLASSES = 256
THRESHOLD = 0.7
#: Texts that don't fall in this residue class of the id's CRC-32 may give their label.
PARTS, HELD_OUT = 4, 2
NAMES = ("symbols", "bangs", "capitals", "digits", "word_length", "word_spread", "distinct", "repeated", "duplicate_lines", "long_words", "stops", "log_words", "beyond_ascii", "no_words")


def features(text: bytes | None) -> np.ndarray:
    """Rates of a text as UTF-8, and the roots of the shares of its classes; that without words has zeros but for the
    last rate."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return np.array([0.0] * (len(NAMES) - 1) + [1.0] + [0.0] * 2 * CLASSES, np.float32)
    code = np.fromiter(map(hash_word, words), np.uint64, n)
    return np.concatenate([rates(text, words, code), np.sqrt(np.bincount((code & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES) / n), np.sqrt(byte_classes(text) / max(1, len(text) - 2))]).astype(np.float32)


def byte_classes(text: bytes) -> np.ndarray:
    """How often each class of three bytes in a row occurs; a piece of the text at a time."""
    out = np.zeros(CLASSES)
    for at in range(0, max(0, len(text) - 2), 1 << 20):
        b = np.frombuffer(text, np.uint8, min(len(text) - at, (1 << 20) + 2), at).astype(np.uint32)
        three = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
        out += np.bincount((three * np.uint32(2654435761)) >> np.uint32(24), minlength=CLASSES)
    return out


def rates(text: bytes, words: list[bytes], code: np.ndarray) -> list[float]:
    n = len(words)
    kind = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = np.fromiter(map(len, words), np.float64, n)
    chars = size.sum()
    three = code[:-2] * np.uint64(0x9E3779B97F4A7C15) + code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + code[2:] if n > 2 else code[:0]
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = kind[65:91].sum() + kind[97:123].sum()
    return [
        kind[[35, 36, 37, 38, 42, 60, 62, 124]].sum() / n,
        kind[[33, 63]].sum() / n,
        kind[65:91].sum() / max(1, letters),
        kind[48:58].sum() / chars,
        chars / n / 5,
        size.std() / 3,
        len(np.unique(code)) / n,
        1 - len(np.unique(three)) / max(1, len(three)) if len(three) else 0.0,
        1 - len(set(lines)) / len(lines),
        float((size > 20).mean()),
        kind[[44, 46]].sum() / n,
        np.log1p(n) / 7,
        kind[128:].sum() / chars,
        0.0,
    ]


def hash_word(word: bytes) -> int:
    return zlib.crc32(word) | len(word) << 32


def expand(x: np.ndarray) -> np.ndarray:
    """Each rate at three scales, so that a trace of something counts beside a lot of it; classes as they are."""
    r = x[:, : len(NAMES)].astype(np.float64)
    return np.hstack([np.minimum(r, 1.5), np.minimum(r * 8, 1), np.minimum(r * 50, 1), x[:, len(NAMES) :]])


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (expand(x) - self.mean) / self.scale @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None) -> tuple[np.ndarray, float]:
    """Weights by Adam over all rows. prior None: plain positives against unlabelled, each class with half the weight."""
    d = p.shape[1]
    w, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    decay = np.concatenate([np.full(3 * len(NAMES), DECAY), np.full(max(0, d - 3 * len(NAMES)), CLASS_DECAY), [0.0]])[-d - 1 :]
    p, u = np.hstack([p, np.ones((len(p), 1))]), np.hstack([u, np.ones((len(u), 1))])
    for step in range(1, STEPS + 1):
        zp, zu = p @ w, u @ w
        # The logistic loss log(1 + e^-z) has the slope s(z) - 1; for negatives, log(1 + e^z), s(z).
        up, un, uu = p.T @ (_sigmoid(zp) - 1) / len(p), p.T @ _sigmoid(zp) / len(p), u.T @ _sigmoid(zu) / len(u)
        if prior is None:
            g = (up + uu) / 2
        else:
            rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            g = prior * up + (uu - prior * un) if rest >= 0 else prior * un - uu
        g = g + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """From scores of held-back positives and unlabelled rows, higher meaning positive: see above."""
    cuts = np.unique(np.quantile(p, np.linspace(0, 0.95, 96)))
    above = lambda x: 1 - np.searchsorted(np.sort(x), cuts, "left") / len(x)
    margin = np.sqrt(np.log(20) / (2 * len(u))) + np.sqrt(np.log(20) / (2 * len(p)))
    best = np.argmin((above(u) + margin) / np.maximum(above(p), 1e-9))
    return float(np.clip(above(u)[best] / above(p)[best], 0.05, 0.98))


def train(p: np.ndarray, u: np.ndarray, prior: float | None = None) -> Model:
    """The model of features of positives and unlabelled rows. Of no positives or nothing unlabelled: all score alike."""
    d = 3 * len(NAMES) + 2 * CLASSES
    if not len(p) or not len(u):
        return Model(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 0.5)
    p, u = expand(p), expand(u)
    both = np.vstack([p, u])
    # A class that varies little tells little: its share isn't blown up to the rates' size.
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), np.where(np.arange(d) < 3 * len(NAMES), 1e-2, 1e-1))
    p, u = (p - mean) / scale, (u - mean) / scale
    if prior is None:
        w, b = _fit(p[::2], u[::2], None)
        prior = estimate_prior(p[1::2] @ w + b, u[1::2] @ w + b) if len(p) > 20 and len(u) > 20 else 0.5
    return Model(mean, scale, *_fit(p, u, prior), prior)


def residue(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % PARTS


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features of each whole text, as the bytes of 32-bit floats."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([features(t).tobytes() for t in b.column("b").to_pylist()], pa.binary())], names=["doc_id", "x"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("b")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, x binary")


def fitted(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    """The model that docs (doc_id, text) and labels (doc_id, quality) give.

    Only ids outside the held-out residue class are used. An id is a positive if all its labels are 1. The
    unlabelled rows are drawn from all such documents, whatever their label. Both samples are the rows
    whose id's hash is below a share that gives about ``rows`` rows, so they are the same in each run, and
    a text is read only if its id is in a sample. One task fits the model; the driver gets its weights alone.
    """
    good = labels.where(residue(F.col("doc_id")) != HELD_OUT).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    known = docs.where(F.coalesce(residue(F.col("doc_id")), F.lit(-1)) != HELD_OUT)
    n_good, n_all = good.count(), known.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 20))
    share = lambda n: min(1 << 20, -(-(rows << 20) // max(1, n)))
    kept = known.where(place < max(share(n_good), share(n_all)))
    sample = measured(kept.select("doc_id", "text")).withColumn("place", place).join(good.withColumn("good", F.lit(True)), "doc_id", "left").where((F.col("good") & (F.col("place") < share(n_good))) | (F.col("place") < share(n_all)))
    of_good, of_all = share(n_good), share(n_all)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, at, good_ = [np.zeros((0, len(NAMES) + 2 * CLASSES), np.float32)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for b in batches:
            x.append(np.frombuffer(b"".join(b.column("x").to_pylist()), np.float32).reshape(-1, x[0].shape[1]))
            at.append(b.column("place").to_numpy(zero_copy_only=False))
            good_.append(b.column("good").to_numpy(zero_copy_only=False).astype(bool))
        x, at, good_ = np.concatenate(x), np.concatenate(at), np.concatenate(good_)
        m = train(x[good_ & (at < of_good)], x[at < of_all])
        yield pa.RecordBatch.from_arrays([*[pa.array([v.astype("<f8").tobytes()]) for v in (m.mean, m.scale, m.weight)], pa.array([m.bias]), pa.array([m.prior])], names=["mean", "scale", "weight", "bias", "prior"])

    # Sorted rows that are limited are one partition's.
    first = sample.orderBy("place", "doc_id", F.hash("x")).limit(3 * rows).select("x", F.col("place").cast("bigint").alias("place"), F.coalesce("good", F.lit(False)).alias("good"))
    found = first.mapInArrow(fit, "mean binary, scale binary, weight binary, bias double, prior double").collect()
    if not found:  # an empty table may have no partition
        none = np.zeros((0, len(NAMES) + 2 * CLASSES), np.float32)
        return train(none, none)
    m = found[0]
    return Model(*[np.frombuffer(v, "<f8") for v in (m["mean"], m["scale"], m["weight"])], m["bias"], m["prior"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score), one row per row of docs."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.scores(np.array([features(t) for t in b.column("b").to_pylist()])))], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("b")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of docs (doc_id, text, ...).

    A null text is the empty one; texts without words have a score of their own. A null id is never held
    out and never a label. Repeated rows score alike, and so do equal texts. An empty table gives no rows;
    without positives every score is 0.5.
    """
    out = scored(docs, fitted(docs, labels))
    return out.select("doc_id", F.coalesce(residue(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score THRESHOLD or more, each column as it was.

    The score is a column beside the text in one pass: nothing is joined and nothing shuffled.
    """
    model = fitted(docs, labels)
    tune(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                texts = [None if t is None else t.encode() for t in b.column(names.index("text")).to_pylist()]
                yield b.filter(pa.array(model.scores(np.array([features(t) for t in texts])) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
