"""The classifier's risk, prior and features; shares of sources and loads of shards on a table with hot rows."""

import collections
import random

import numpy as np
from pyspark.sql import functions as F

from quire.llm import classifier, mixing, sharding


def test_byte_classes_against_a_loop():
    for text in (b"", b"ab", b"abc", b"the cat sat on the mat", bytes(range(256)) * 3, b"x" * 5000):
        want = np.zeros(classifier.CLASSES)
        for i in range(len(text) - 2):
            three = text[i] | text[i + 1] << 8 | text[i + 2] << 16
            want[(three * 2654435761 % (1 << 32)) >> 24] += 1
        assert (classifier.byte_classes(text) == want).all()


def test_byte_classes_of_a_long_text_in_pieces():
    r = random.Random(1)
    text = bytes(r.randrange(97, 103) for _ in range((1 << 20) + 77))
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    three = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    assert (classifier.byte_classes(text) == np.bincount((three * np.uint32(2654435761)) >> np.uint32(24), minlength=classifier.CLASSES)).all()


def test_features_of_any_text_have_one_shape():
    for text in (None, b"", b"  \n", b"a", "日本 é".encode(), b"a b c " * 1000):
        x = classifier.features(text)
        assert x.shape == (len(classifier.NAMES) + 2 * classifier.CLASSES,) and np.isfinite(x).all()


def test_prior_of_a_known_mix():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.9):
        p, u = rng.normal(2, 1, 4000), np.concatenate([rng.normal(2, 1, int(4000 * share)), rng.normal(-2, 1, 4000 - int(4000 * share))])
        assert abs(classifier.estimate_prior(p, u) - share) < 0.06


def test_negative_risk_is_not_below_zero():
    """The risk of negatives among the unlabelled stays at or above zero, up to a step; no negative is ever shown."""
    rng = np.random.default_rng(1)
    d = 4
    p = rng.normal(1, 1, (600, d))
    u = np.vstack([rng.normal(1, 1, (400, d)), rng.normal(-1, 1, (200, d))])
    w, b = classifier._fit(p, u, 2 / 3)
    rest = np.logaddexp(0, u @ w + b).mean() - 2 / 3 * np.logaddexp(0, p @ w + b).mean()
    assert rest > -0.02
    score = classifier._sigmoid(u @ w + b)
    assert (score[:400] > 0.5).mean() > 0.9 and (score[400:] < 0.5).mean() > 0.85


def table(spark, n=3000):
    """A hot source, equal texts that are a third of all rows, nulls, empty and long texts."""
    rows = []
    for i in range(n):
        text = "same words here " * 5 if i % 3 == 0 else None if i % 100 == 1 else "" if i % 100 == 2 else "w " * (i % 50 + 1) + ("long " * 3000 if i % 500 == 4 else "")
        rows.append((i if i % 50 else None, text, "hot" if i % 3 < 2 else f"s{i % 7}" if i % 11 else None))
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)


def test_sources_come_near_their_targets(spark):
    got = mixing.amounts(mixing.mix(table(spark)))
    rows = got.collect()
    assert len(rows) == 3000 and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in rows:
        taken[(r["target"], r["source_size"])] += r["taken"]
        target[(r["target"], r["source_size"])] = r["target"]
        size[(r["target"], r["source_size"])] += r["size"]
    assert all(abs(taken[k] - t) <= max(50, 0.02 * t) for k, t in target.items()), [(taken[k], t) for k, t in target.items()]
    assert abs(sum(target.values()) - sum(size.values())) < 1 and all(t <= 3 * size[k] + 1e-6 for k, t in target.items())
    again = mixing.amounts(mixing.mix(table(spark).repartition(3)))
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["size"], r["taken"])
    assert sorted(map(key, rows), key=str) == sorted(map(key, again.collect()), key=str)


def test_sources_below_a_slot_are_not_lost(spark, monkeypatch):
    monkeypatch.setattr(mixing, "block_words", lambda total: 700)
    rows = [(i, "big words " * 60, "big") for i in range(200)] + [(1000 + i, "one two three", f"tiny{i}") for i in range(6)]
    got = mixing.amounts(mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))).where("doc_id >= 1000").collect()
    assert len(got) == 6 and all(r["taken"] > 0 and r["taken"] <= 9 for r in got)
    assert sum(r["taken"] == int(r["target"]) for r in got) >= 5


def test_shards_are_balanced(spark):
    df, _ = sharding.sharded(table(spark))
    rows = df.collect()
    load = collections.Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert len(rows) == 3000 and set(load) == set(range(16)) and {r["law"] for r in rows} == {"bytes"} and all(r["grown_shard"] is None for r in rows)
    mean, largest = sum(load.values()) / 16, max(r["size"] for r in rows)
    assert max(load.values()) - min(load.values()) <= largest and max(load.values()) < mean + largest
    again = sharding.sharded(table(spark).repartition(2))[0]
    assert sorted(map(str, df.select("doc_id", "size", "text_crc32", "shard").collect())) == sorted(map(str, again.select("doc_id", "size", "text_crc32", "shard").collect()))
    assert df.groupBy("shard").agg((F.max("slot") + 1 == F.count("*")).alias("x")).where("not x").count() == 0
