"""SimHash near-duplicate detection through a Gray-order hierarchical index.

A fingerprint has 64 bits; bit b is 1 if more than half of the text's shingle hashes have it. Two
fingerprints link if they differ in at most ``limit`` bits, and linked documents form components.

The search is exact. Fingerprints are dealt by masks: 64 bits are cut into blocks, and if two
fingerprints differ in at most ``limit`` bits, they agree in all but ``limit`` of the blocks, hence
in the bits of at least one mask. Within a mask's bucket the fingerprints are sorted by Gray rank,
so neighbours share long bit patterns; groups of eight become nodes that hold the bits on which all
members agree, and nodes become groups again. A search goes down from the root, adds up the
differing bits of each node that its parents don't hold, and drops a whole group once the sum is
above the limit. Buckets yield stars, never all pairs, and nodes that are already known to be in the
query's own component are passed over, so a group of near copies costs no square of its size.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, cleaned, cut, salted_join, scratch, tune
from .components import components

SHINGLE = 4
SEED = 42
LIMIT = 4
FAN = 8
#: Pairs of query and node that one step of the descent holds at most.
FRONTIER = 1_000_000
#: Fingerprints of whole buckets that are indexed together.
BATCH = 200_000


def shingle_hashes(text: bytes | None, words: int, seed: int = SEED) -> np.ndarray:
    """The XXH64 of each word shingle, repeats included; of fewer words, that of the whole sequence; of none, none."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[words - 1 :] if len(found) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[: len(last)].tolist(), last.tolist(), strict=True)), np.uint64, len(last))


def majority(h: np.ndarray) -> int:
    """64 bits, each 1 if more than half of the hashes have it; 0 of none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        part = np.ascontiguousarray(h[at : at + 8192]).astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0]) if len(h) else 0


def simhash(text: bytes | None, words: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of UTF-8 bytes as an unsigned 64-bit number; 0 where there is no word."""
    return majority(shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the signed bigint with the fingerprint's bits. A null text has fingerprint 0."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([simhash(t, words) for t in b.column("b").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("b")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of x in the sequence of Gray codes."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label: each item's smallest known companion. Joins the components of a[i] and b[i]."""
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(jumped := label[label], label):
            label = jumped
    return label


class GrayIndex:
    """The index over fps, which are sorted by bucket and then by Gray rank."""

    def __init__(self, bucket: np.ndarray, fps: np.ndarray, limit: int):
        order = np.lexsort((gray_rank(fps), bucket))
        self.order, self.fps, self.limit = order, fps[order], limit
        b = bucket[order]
        n = len(b)
        at = np.arange(n)
        first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        home = np.cumsum(np.concatenate(([0], (b[1:] != b[:-1]).astype(np.int64))))
        self.levels: list[dict[str, np.ndarray]] = []
        conj, disj, owner, place = self.fps, self.fps, home, at - first[home]
        lo, hi = at, at + 1
        while True:
            cuts = np.flatnonzero(place % FAN == 0)
            ends = np.concatenate((cuts[1:], [len(place)]))
            conj, disj = np.bitwise_and.reduceat(conj, cuts), np.bitwise_or.reduceat(disj, cuts)
            lo, hi = lo[cuts], hi[ends - 1]
            mask = ~(conj ^ disj)
            self.levels.append({"child": cuts, "n": ends - cuts, "mask": mask, "own": mask, "pattern": conj & mask, "lo": lo, "hi": hi})
            owner, place = owner[cuts], place[cuts] // FAN
            if len(owner) == len(first):
                break
        for above, below in itertools.pairwise(self.levels[::-1]):  # a node tests only what its parents leave open
            below["own"] = below["mask"] & ~np.repeat(above["mask"], above["n"])
        self.root = home
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def _down(self, level: int, q: np.ndarray, node: np.ndarray, acc: np.ndarray) -> None:
        v = self.levels[level]
        acc = acc + np.bitwise_count((self.fps[q] ^ v["pattern"][node]) & v["own"][node])
        keep = (acc <= self.limit) & (v["hi"][node] > q + 1) & ~((self.low[level][node] == self.high[level][node]) & (self.low[level][node] == self.label[q]))
        q, node, acc = q[keep], node[keep], acc[keep]
        if not len(q):
            return
        self._open(level, q, node, acc, v["n"][node])

    def _open(self, level: int, q: np.ndarray, node: np.ndarray, acc: np.ndarray, n: np.ndarray) -> None:
        if n.sum() > FRONTIER and len(q) > 1:
            half = len(q) // 2
            self._open(level, q[:half], node[:half], acc[:half], n[:half])
            self._open(level, q[half:], node[half:], acc[half:], n[half:])
            return
        child = np.repeat(self.levels[level]["child"][node] - np.cumsum(n) + n, n) + np.arange(n.sum())
        q = np.repeat(q, n)
        if level:
            self._down(level - 1, q, child, np.repeat(acc, n))
        else:
            hit = (child > q) & (np.bitwise_count(self.fps[q] ^ self.fps[child]) <= self.limit)
            self.pairs.append((q[hit], child[hit]))
            if sum(len(x) for x, _ in self.pairs) > FRONTIER:
                self._fold()

    def _fold(self) -> None:
        if self.pairs:
            self.label = _merge(self.label, *(np.concatenate(x) for x in zip(*self.pairs, strict=True)))
            self.pairs = []

    def link(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the given arrays: items that have a companion, and their component's first item."""
        n = len(self.fps)
        self.label = np.arange(n)
        top, at, step = len(self.levels) - 1, 0, 64
        while at < n:
            q = np.arange(at, min(n, at + step))
            self.low = [np.minimum.reduceat(self.label, v["lo"]) for v in self.levels]
            self.high = [np.maximum.reduceat(self.label, v["lo"]) for v in self.levels]
            self._down(top, q, self.root[q], np.zeros(len(q), np.int64))
            self._fold()
            at, step = at + step, min(2 * step, 16384)
        mine = np.flatnonzero(self.label != np.arange(n))
        return self.order[mine], self.order[self.label[mine]]


def _stars(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, members, firsts) of some buckets at a time. The first two columns name the bucket, and rows come
    sorted by them; the third is the fingerprint. A bucket's rows are held together as numbers."""
    held: list[np.ndarray] = []

    def linked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        new = np.concatenate(([True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)))
        return rows, *GrayIndex(np.cumsum(new), rows[2].view(np.uint64), limit).link()

    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]))
        if sum(x.shape[1] for x in held) >= BATCH:
            rows = np.concatenate(held, axis=1)
            done = int((rows[:2] == rows[:2, -1:]).all(axis=0).argmax())  # the last bucket may go on
            held = [rows[:, done:]]
            if done:
                yield linked(np.ascontiguousarray(rows[:, :done]))
    if sum(x.shape[1] for x in held):
        yield linked(np.concatenate(held, axis=1))


def masks(limit: int, blocks: int) -> list[int]:
    """Bit masks such that any two 64-bit numbers that differ in at most limit bits agree under one of them."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    whole = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]
    return [sum(x) for x in itertools.combinations(whole, blocks - limit)]


def links(fps: DataFrame, limit: int = LIMIT, blocks: int | None = None) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints of fps (fp): those that differ in at most limit bits
    are connected by them. blocks: more of them make smaller buckets and more copies; None chooses by the
    number of fingerprints, which changes the cost alone."""
    if blocks is None:
        n = fps.count()
        blocks = limit + (1 if n < 1 << 23 else 2 if n < 1 << 31 else 3)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(limit, blocks)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, fp), a, b in _stars(batches, ("mask", "bits", "fp"), limit):
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["u", "v"])

    each = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"), F.col("fp")) for i, m in enumerate(signed)]))
    return fps.select(each.alias("x")).select("x.*").repartition("mask", "bits").sortWithinPartitions("mask", "bits").mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, limit: int = LIMIT, words: int = SHINGLE, blocks: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of docs (doc_id, text, ...).

    component_id is the smallest doc_id that links reach. Null and empty texts have fingerprint 0 and
    link like any other. Rows with a null doc_id link too; a component of such rows alone has a null
    id. Repeated rows have one fingerprint and so one component. An empty table gives no rows.
    """
    rows = cut(fingerprints(docs, words))
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(fps.select("fp"), limit, blocks))
    of = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "fp")
    grouped = of.join(fps, "fp")
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = salted_join(of, ids, "root").select("fp", "component_id")
    label = fps.join(named.withColumn("linked", F.lit(True)), "fp", "left").select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    return salted_join(rows, label, "fp").select("doc_id", "fp", "component_id")


#: Words of a long fingerprint, and the share of similar pairs that may escape all tables.
WIDE, MISSED = 4, 0.01
#: Ids of texts to be compared are broadcast if there are so many at most; more are joined by a shuffle.
ASKED = 100_000
#: Words of parities.
PARITY = 8
#: Documents whose shingles are counted, and the most frequent of these shingles that are kept.
SAMPLED, COMMON = 10_000, 200_000


def apart(similarity: float) -> float:
    """The share of bits in which the fingerprints of two texts of that Jaccard similarity differ on average.

    The cosine of two sets of one size is 2 s / (1 + s), and a bit differs with the angle's share of a half turn.
    """
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def tables_for(n: int, similarity: float) -> tuple[int, int]:
    """(tables, bits): patterns long enough that unlike texts seldom meet, tables enough that like ones do once."""
    bits = max(12, math.ceil(math.log2(max(2, n))) - 1)
    return math.ceil(math.log(MISSED) / math.log(1 - (1 - apart(similarity)) ** bits)), bits


#: cut(), or that of a scratch folder.
Cut = Callable[[DataFrame], DataFrame]
#: What tells rows apart: the id, nulls last, and a hash of the text. Rows that agree in it are repeated rows.
KEY = ("no_id", "key_id", "text_hash")


def keyed(docs: DataFrame) -> DataFrame:
    """(KEY, b): b is the text as UTF-8; a null text is the empty one."""
    tune(docs.sparkSession)
    return docs.select(*key_of(docs), F.coalesce("text", F.lit("")).cast("binary").alias("b"))


def key_of(docs: DataFrame) -> list[Column]:
    doc_id = F.col("doc_id").cast("long")
    return [doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("key_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]


def _mapped(docs: DataFrame, columns: str, values: Callable[[list[bytes]], list[pa.Array]]) -> DataFrame:
    """KEY and the columns that values() gives for a batch of texts, one row per row of docs."""
    names = [*KEY, *[c.split()[0] for c in columns.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in KEY], *values(b.column("b").to_pylist())], names=names)

    return keyed(docs).mapInArrow(run, f"no_id boolean, key_id bigint, text_hash bigint, {columns}")


def wide_fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(KEY, sig, w0, w1, ...): long fingerprints of shingle sets; sig is the set's own hash, and the words after
    the first are of remixed shingle hashes."""
    odd = [0x9E3779B97F4A7C15 * (2 * j + 1) % (1 << 64) for j in range(1, WIDE)]

    def values(texts: list[bytes]) -> list[pa.Array]:
        out, sig = [], []
        for t in texts:
            h = np.unique(shingle_hashes(t, words))
            sig.append(xxhash.xxh64_intdigest(h.astype("<u8").tobytes(), SEED))
            row = [majority(h)]
            for o in odd:
                x = (h ^ (h >> np.uint64(31))) * np.uint64(o)
                row.append(majority(x ^ (x >> np.uint64(29))))
            out.append(row)
        fps = np.array(out, np.uint64).reshape(-1, WIDE).view(np.int64)
        return [pa.array(np.array(sig, np.uint64).view(np.int64)), *[pa.array(fps[:, j].copy()) for j in range(WIDE)]]

    return _mapped(docs, "sig bigint, " + ", ".join(f"w{j} bigint" for j in range(WIDE)), values)


def of_heads(found: DataFrame, heads: DataFrame) -> DataFrame:
    """What was found of the rows that stand for heads (id, KEY), by id; rows that are repeated count once."""
    return found.join(heads.select("id", *KEY), list(KEY)).drop(*KEY).dropDuplicates(["id"])


def sketch(h: np.ndarray) -> bytes:
    """Parities as of parities(), of twice as many classes as there are hashes or more: a power of two, 64 at least."""
    n = max(6, (2 * len(h)).bit_length())
    return np.packbits(np.bincount((h >> np.uint64(64 - n)).astype(np.int64), minlength=1 << n) & 1, bitorder="little").tobytes()


def differ(a: bytes, b: bytes) -> int:
    """In so many hashes at least the sets of two sketches differ; the longer one is folded to the classes of the other."""
    x, y = (np.unpackbits(np.frombuffer(s, np.uint8), bitorder="little") for s in (a, b))
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[::2] ^ x[1::2]
    return int(np.count_nonzero(x != y))


def of_pairs(docs: DataFrame, heads: DataFrame, pairs: DataFrame, columns: str, values: Callable[[list[bytes]], list[pa.Array]], cut: Cut) -> DataFrame:
    """pairs (u, v) with the columns that values() gives for u's text, and with v's, whose names begin with _."""
    ids = cut(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct().join(heads.select("id", *KEY), "id"))
    asked = bounded_broadcast(ids.select(*KEY), ASKED)
    texts = docs.select("doc_id", "text", *key_of(docs)).join(asked, list(KEY), "left_semi").select("doc_id", "text")
    found = cut(of_heads(_mapped(texts, columns, values), ids))
    right = found.select(*[F.col(c).alias("v" if c == "id" else f"_{c}") for c in found.columns])
    return salted_join(salted_join(pairs, found.withColumnRenamed("id", "u"), "u"), right, "v", pairs)


def alike(docs: DataFrame, heads: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of heads whose texts' shingle sets have that Jaccard similarity or more.

    Whole sets are larger than the texts, so pairs are first judged by sketches, a thirtieth of the size, which bound
    the difference from below. What they leave is nearly all alike.
    """

    def sketches(texts: list[bytes]) -> list[pa.Array]:
        sets_ = [np.unique(shingle_hashes(t, words)) for t in texts]
        return [pa.array([len(h) for h in sets_], pa.int32()), pa.array([sketch(h) for h in sets_], pa.binary())]

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column("n").to_numpy(zero_copy_only=False).astype(np.int64) + b.column("_n").to_numpy(zero_copy_only=False)
            least = np.array([differ(x, y) for x, y in zip(b.column("odd").to_pylist(), b.column("_odd").to_pylist(), strict=True)], np.int64)
            stay = pa.array(least <= (1 - similarity) / (1 + similarity) * sizes + 1e-6)
            yield b.select(["u", "v"]).filter(stay)

    def sets(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array([np.unique(shingle_hashes(t, words)).view(np.int64) for t in texts], pa.list_(pa.int64()))]

    with scratch(docs.sparkSession) as brief:
        sketched = of_pairs(docs, heads, pairs, "n int, odd binary", sketches, brief)
        near = brief(sketched.mapInArrow(possible, "u bigint, v bigint"))
        both = of_pairs(docs, heads, near, "s array<bigint>", sets, brief)
        common = F.size(F.array_intersect("s", "_s"))
        return cut(both.where(common >= similarity * (F.size("s") + F.size("_s") - common)).select("u", "v"))


def common_shingles(docs: DataFrame, n: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts), sorted by hash: shingles that several of some SAMPLED documents hold, the COMMON most frequent.

    n: documents. It only orders shingles, so that prefixes begin with rare ones; any order finds all pairs.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(shingle_hashes(t, words)) for t in b.column("b").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))], names=["h"])

    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, n // SAMPLED))) == 0).select(F.col("text").cast("binary").alias("b"))
    with cleaned(docs.sparkSession):
        rows = some.mapInArrow(each, "h bigint").groupBy("h").agg(F.count("*").alias("c")).where("c >= 2").orderBy(F.desc("c"), "h").limit(COMMON).toArrow()
    h, c = (rows.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in ("h", "c"))
    h = h.astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], c[order]


def prefix(h: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles of a set, rare ones first: two sets of that similarity or more share one of their prefixes'."""
    if not len(h):
        return h
    n = len(h) - math.ceil(similarity * len(h) - 1e-9) + 1
    count = np.zeros(len(h), np.int64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], h), len(common[0]) - 1)
        count = np.where(common[0][at] == h, common[1][at], 0)
    return h[np.lexsort((h, count))[:n]]


def parities(h: np.ndarray) -> np.ndarray:
    """64 * PARITY bits: whether each class of hashes, by their first bits, has an odd number of the set's.

    A hash that only one of two sets holds flips one bit, so the sets differ in as many hashes as bits at least.
    """
    classes = (h >> np.uint64(64 - (64 * PARITY).bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(classes, minlength=64 * PARITY) & 1, bitorder="little").view("<i8")


def prefixes(docs: DataFrame, heads: DataFrame, n: int, words: int, similarity: float) -> DataFrame:
    """(id, n, p0, p1, ..., keys): the size, the parities and the prefix of each head's shingle set. n: how many heads there are."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, n, words))

    def values(texts: list[bytes]) -> list[pa.Array]:
        sets = [np.unique(shingle_hashes(t, words)) for t in texts]
        keys = [prefix(h, shared.value, similarity).view(np.int64) for h in sets]
        odd = np.array([parities(h) for h in sets], np.int64).reshape(-1, PARITY)
        return [pa.array([len(h) for h in sets], pa.int32()), *[pa.array(odd[:, j].copy()) for j in range(PARITY)], pa.array(keys, pa.list_(pa.int64()))]

    return of_heads(_mapped(docs, "n int, " + ", ".join(f"p{j} bigint" for j in range(PARITY)) + ", keys array<bigint>", values), heads)


def shared_places(known: DataFrame, cut: Cut = cut) -> DataFrame:
    """(key, id, n, pos): the places of prefixes at shingles that more than one head has in its own. Most shingles have
    one place only, so this is the one step that deals all of them."""
    rows = known.select("id", "n", F.posexplode("keys").alias("pos", "key"))
    counts = cut(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    side = counts.select("key")
    few = side.limit(ASKED + 1).count() <= ASKED
    return cut(rows.join(F.broadcast(side), "key") if few else salted_join(rows, side, "key", counts=counts))


def meetings(places: DataFrame, known: DataFrame, labels: DataFrame, cut: Cut = cut) -> DataFrame:
    """(key, id, root, n, pos, p0, ...): the places at shingles that heads of unlike labels (id, root) share."""
    rows = places.join(labels, "id")
    mixed = cut(rows.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("z"), F.count("*").alias("n")).where("a < z").select("key", "n"))
    side = mixed.select("key")
    few = side.limit(ASKED + 1).count() <= ASKED
    met = rows.join(F.broadcast(side), "key") if few else salted_join(rows, side, "key", counts=mixed)
    return cut(met.join(known.select("id", *[f"p{j}" for j in range(PARITY)]), "id"))


def _may_be_alike(both: DataFrame, similarity: float) -> DataFrame:
    """(u, v): pairs of heads that meet at a shingle (n, pos and _n, _pos) and whose sizes and places leave the similarity possible."""
    least, most = F.least("n", "_n"), F.greatest("n", "_n")
    # Of the first shingle that two prefixes share, what follows in the shorter rest is all they can share.
    left = F.least(F.col("n") - F.col("pos"), F.col("_n") - F.col("_pos"))
    apart_ = sum((F.bit_count(F.col(f"p{j}").bitwiseXOR(F.col(f"_p{j}"))) for j in range(PARITY)), F.lit(0))
    both_sizes = F.col("n") + F.col("_n")
    near = both.where((least >= similarity * most - 1e-6) & (left >= similarity / (1 + similarity) * both_sizes - 1e-6) & (apart_ <= (1 - similarity) / (1 + similarity) * both_sizes + 1e-6))
    return near.select(F.least("id", "_id").alias("u"), F.greatest("id", "_id").alias("v")).where("u < v").distinct()


_OTHER = ("id", "root", "n", "pos", *[f"p{j}" for j in range(PARITY)])


def hubs(met: DataFrame) -> DataFrame:
    """met with hub: the label that most heads have at each shingle."""
    most = met.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "root"))["root"].alias("hub"))
    return salted_join(met, most, "key")


def stars(met: DataFrame, similarity: float, cut: Cut = cut) -> DataFrame:
    """(u, v): at each shingle each head outside the largest label with one head of that label and one of the others.

    The two are drawn by a hash of head and shingle, so a group of near copies gets other centres at other
    shingles, and nearly all of it is joined by pairs that grow with its size alone.
    """
    places = cut(hubs(met))
    drawn = places.groupBy("key", (F.col("root") == F.col("hub")).alias("inside")).agg(F.min_by(F.struct(*_OTHER), F.xxhash64("id", "key")).alias("c"))
    centre = drawn.select("key", *[F.col(f"c.{x}").alias(f"_{x}") for x in _OTHER])
    return _may_be_alike(salted_join(places.where("root <> hub").drop("hub"), centre, "key").where("root <> _root"), similarity)


def candidates(met: DataFrame, similarity: float, cut: Cut = cut) -> DataFrame:
    """(u, v): heads of unlike labels whose texts may have that similarity; none that have it is left out.

    Pairs are made where prefixes meet, and never inside a label: a group of near copies that is known already
    makes none.
    """
    # At each shingle, what isn't of its largest label meets all the others.
    rest = hubs(met).where("root <> hub").select("key", "hub", *[F.col(x).alias(f"_{x}") for x in _OTHER])
    both = salted_join(met, rest, "key").where("root <> _root and (root = hub or id < _id)")
    return _may_be_alike(both, similarity)


def similar(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, heads, links): each row's KEY and shingle set (sig, w0, ...); a head (id, KEY) for each distinct set,
    which is the row with the smallest KEY that has it; and pairs (u, v) of heads that connect texts whose
    shingle sets have that Jaccard similarity or more.

    Texts that are but 0.8 alike differ in a seventh of the bits, too many for masks that leave none out. So
    the masks are random patterns of a long fingerprint: like texts mostly agree in one of them, and each bucket
    is searched by the same index with a wider limit. What it finds is then compared by whole shingle sets;
    nothing is decided by fingerprints alone. Sets whose hash and fingerprint are equal are copies.

    Patterns miss some pairs, a bucket yields stars, and a star's edge may fail though two of its members are
    alike. So this only finds most groups cheaply. Prefixes of the shingle sets find the rest: stars() joins what is
    left of large groups by few pairs, and candidates() then finds each like pair that is still apart, without
    chance.
    """
    columns = [f"w{j}" for j in range(WIDE)]
    rows = cut(wide_fingerprints(docs, words))
    first = rows.groupBy("sig", *columns).agg(F.min(F.struct(*KEY)).alias("first"))
    heads = cut(first.select(F.monotonically_increasing_id().alias("id"), "first.*", "sig", *columns))
    n = heads.count()
    tables, bits = tables_for(n, similarity)
    p = apart(similarity)
    limit = math.ceil(64 * p + 3 * math.sqrt(64 * p * (1 - p)))
    rng = np.random.default_rng(SEED)
    chosen = np.array([np.sort(rng.choice(64 * WIDE, bits, replace=False)) for _ in range(tables)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in columns], axis=1).astype("<i8")
            bit = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), axis=1, bitorder="little")
            key = np.stack([bit[:, c].astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64)) for c in chosen], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(tables, dtype=np.int32), len(fps))), pa.array(key.ravel()), pa.array(np.repeat(fps[:, 0], tables)), pa.array(np.repeat(b.column("id").to_numpy(zero_copy_only=False), tables))],
                names=["mask", "bits", "fp", "id"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, a, b in _stars(batches, ("mask", "bits", "fp", "id"), limit):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rows[3][a], rows[3][b])), pa.array(np.maximum(rows[3][a], rows[3][b]))], names=["u", "v"])

    # The whole fingerprints of a pair are known to differ in so many bits at most, but for a chance of 1 in 4000.
    wide = math.ceil(64 * WIDE * p + 3.5 * math.sqrt(64 * WIDE * p * (1 - p)))
    of = lambda side: heads.select(F.col("id").alias(side), F.array(*columns).alias(f"{side}_fp"))
    differing = F.aggregate(F.zip_with("u_fp", "v_fp", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda acc, x: acc + x)
    # Files that later steps don't read go as soon as they can: all of them together are several times the input.
    with scratch(docs.sparkSession) as brief:
        dealt = heads.mapInArrow(deal, "mask int, bits bigint, fp bigint, id bigint").repartition("mask", "bits").sortWithinPartitions("mask", "bits")
        near = brief(dealt.mapInArrow(search, "u bigint, v bigint").distinct())
        both = salted_join(salted_join(near, of("u"), "u"), of("v"), "v", near)
        found = alike(docs, heads, brief(both.where(differing <= wide).select("u", "v")), words, similarity)
    with scratch(docs.sparkSession) as brief:
        sets = brief(prefixes(docs, heads, n, words, similarity))
        places = shared_places(sets, brief)
        for pairs_of in (stars, candidates):
            known = components(found)
            with scratch(docs.sparkSession) as briefer:
                labels = briefer(heads.join(known, F.col("id") == F.col("node"), "left").select("id", F.coalesce("root", "id").alias("root")))
                more = cut(pairs_of(meetings(places, sets, labels, briefer), similarity, briefer))
            found = known.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(alike(docs, heads, more, words, similarity))
    return rows, heads, found


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without near duplicates: of each component of similar() one row stays, that with the smallest doc_id.

    Rows are told apart by id and text, so rows that share an id but not a text are judged as any others. A null
    id is larger than any other; rows of one id go by a hash of their texts; of repeated rows one stays,
    any one if they differ in other columns. Null and empty texts, and all without a word, are copies of each
    other. Columns are as they were, whatever their names. An empty table gives no rows.
    """
    names = docs.columns
    rows, heads, links_ = similar(docs, words, similarity)
    grouped = heads.select("id", F.struct(*KEY).alias("first")).join(components(links_), F.col("id") == F.col("node"), "left")
    best = grouped.groupBy(F.coalesce("root", "id").alias("group")).agg(F.min("first").alias("first")).select("first.*")
    again = cut(rows.groupBy(*KEY).agg(F.count("*").alias("n_rows")).where("n_rows > 1").select(*KEY))
    marked = docs.select(F.struct(*names).alias("row"), *key_of(docs))
    if not again.limit(1).count():
        return marked.join(best, list(KEY), "left_semi").select("row.*")
    # Repeated rows are told apart first, so that a row that is a third of all isn't dealt to one task.
    repeated = bounded_broadcast(again, ASKED)
    out = marked.join(repeated, list(KEY), "left_anti").join(best, list(KEY), "left_semi").select("row.*")
    many = bounded_broadcast(cut(again.join(best, list(KEY), "left_semi")), ASKED)
    return out.unionByName(marked.join(many, list(KEY), "left_semi").groupBy(*KEY).agg(F.first("row").alias("row")).select("row.*"))
