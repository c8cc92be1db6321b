"""URL filters over a sorted digest array.

The rules of an allow and block list are keys: host, then path. Their 64-bit xxhash digests are sorted
into an array in a file, which each executor gets once and maps into memory; the rules' full strings lie
behind it. A URL is asked for by every suffix of its host and every rule length of its path; all
candidates of a batch are looked up by one vectorised binary search, and a hit counts only if the
stored string is the candidate.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, tune

ALLOW, BLOCK = "allow", "block"

#: (verdict, host, path) in no order; of the rules that fit a URL the longest wins.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)

MAGIC = b"digests1"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for a null or one without ://."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class DigestArray:
    """Digests in ascending order, and what they are digests of."""

    keys: np.ndarray  # uint64
    ends: np.ndarray  # int64: where each string ends in text
    block: np.ndarray  # uint8: 1 where the rule blocks
    lengths: tuple[int, ...]  # of the rules' paths, in bytes
    text: np.ndarray  # uint8

    @staticmethod
    def pack(rules: Iterable[tuple[str, str, str]]) -> bytes:
        """The file's bytes. A rule given twice counts once; if its verdicts differ, it blocks."""
        verdicts: dict[bytes, int] = {}
        lengths = set()
        for verdict, host, path in rules:
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"a rule allows or blocks; it can't {verdict!r}")
            key = (host + path).encode()
            verdicts[key] = max(verdicts.get(key, 0), int(verdict == BLOCK))
            lengths.add(len(path.encode()))
        rows = sorted((xxhash.xxh64_intdigest(k), k) for k in verdicts)
        n, sizes = len(rows), sorted(lengths)
        parts = [
            MAGIC, np.array([n, len(sizes)], "<i8").tobytes(), np.array(sizes, "<i8").tobytes(), np.array([h for h, _ in rows], "<u8").tobytes(),
            np.cumsum([len(k) for _, k in rows], dtype="<i8").tobytes(), b"".join(k for _, k in rows), bytes(verdicts[k] for _, k in rows),
        ]
        return b"".join(parts)

    @classmethod
    def map(cls, path: str) -> DigestArray:
        raw = np.memmap(path, np.uint8, "r")
        if raw[:8].tobytes() != MAGIC:
            raise ValueError(f"{path} isn't a digest array")
        n, m = raw[8:24].view("<i8").tolist()
        at = 24
        lengths, at = tuple(raw[at : at + 8 * m].view("<i8").tolist()), at + 8 * m
        keys, at = raw[at : at + 8 * n].view("<u8"), at + 8 * n
        ends, at = raw[at : at + 8 * n].view("<i8"), at + 8 * n
        return cls(keys, ends, raw[len(raw) - n :], lengths, raw[at : len(raw) - n])

    def find(self, wanted: list[bytes]) -> np.ndarray:
        """The place of each wanted string, or -1. Equal digests lie side by side and are all compared."""
        out = np.full(len(wanted), -1)
        if not len(self.keys) or not wanted:
            return out
        h = np.array([xxhash.xxh64_intdigest(w) for w in wanted], np.uint64)
        at = np.searchsorted(self.keys, h)
        near = np.minimum(at, len(self.keys) - 1)
        for i in np.flatnonzero((at < len(self.keys)) & (self.keys[near] == h)).tolist():
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == h[i]:
                if self.string(j) == wanted[i]:
                    out[i] = j
                    break
                j += 1
        return out

    def string(self, j: int) -> bytes:
        return self.text[int(self.ends[j - 1]) if j else 0 : int(self.ends[j])].tobytes()

    def judge(self, hosts: list[str], paths: list[str], default: str = ALLOW) -> tuple[list[str | None], list[str]]:
        """The rule and verdict of each URL. Of two rules of one length the longer host wins."""
        wanted: list[bytes] = []
        spans = []
        for host, path in zip(hosts, paths, strict=True):
            begin, p = len(wanted), path.encode()
            starts = [p[:n] for n in self.lengths if n <= len(p)]
            labels = host.split(".")
            wanted += [".".join(labels[i:]).encode() + s for i in range(len(labels)) for s in starts] if host else []
            spans.append((begin, len(wanted)))
        place = dict.fromkeys(wanted)
        distinct = list(place)
        place = dict(zip(distinct, self.find(distinct).tolist(), strict=True))
        rule: list[str | None] = []
        verdict: list[str] = []
        for begin, end in spans:
            hits = [w for w in wanted[begin:end] if place[w] >= 0]
            best = max(hits, key=len) if hits else None  # candidates begin with the longest host
            rule.append(best.decode() if best is not None else None)
            verdict.append((BLOCK if self.block[place[best]] else ALLOW) if best is not None else default)
        return rule, verdict


def publish(spark, rules: Iterable[tuple[str, str, str]]) -> str:
    """The array as a file that Spark hands to every executor, also to those that join later; its name."""
    packed = DigestArray.pack(rules)
    name = f"digests-{hashlib.sha256(packed).hexdigest()[:16]}.bin"
    if any(f.endswith(f"/{name}") for f in spark.sparkContext.listFiles):  # the name says what is in it
        return name
    folder = os.path.realpath(tempfile.mkdtemp(prefix="quire-"))  # the driver's own; Spark's file server reads it
    with open(f"{folder}/{name}", "wb") as f:
        f.write(packed)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def judged(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of pages (page_id, url, ...).

    A rule fits its host and all subdomains, if the URL's path starts with the rule's; the longest rule
    wins. Where none fits, rule is null and the verdict is default: what no list names is let through. A
    null URL, or one without ://, has an empty host and path, which no rule fits. Repeated rows are judged
    alike; an empty table gives no rows.
    """
    tune(pages.sparkSession)
    name = publish(pages.sparkSession, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray.map(SparkFiles.get(name))
        for b in batches:
            rule, verdict = array.judge(b.column("host").to_pylist(), b.column("path").to_pylist(), default)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def allowed(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, default: str = ALLOW) -> DataFrame:
    """page_id of the pages that may stay."""
    return judged(pages, rules, default).where(F.col("verdict") == ALLOW).select("page_id")
