"""The classifier is fitted by a task: neither its rows nor their copies go to the driver."""

import os

import numpy as np

from quire.llm import classifier


def rows_of(spark):
    docs = [(i, f"word{i % 7} and some {'!' * (i % 3)} more text {i}") for i in range(400)]
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 400, 2)], "doc_id bigint, quality int")


def test_a_task_fits(spark, monkeypatch):
    docs, labels = rows_of(spark)
    here = os.getpid()

    def train(p, u):
        return classifier.Model(np.zeros(1), np.ones(1), np.zeros(1), float(os.getpid()), float(len(p) + len(u)))

    monkeypatch.setattr(classifier, "train", train)
    got = classifier.fitted(docs, labels)
    assert got.bias != here and got.prior > 300


def test_its_weights_are_those_of_a_fit_on_the_driver(spark):
    docs, labels = rows_of(spark)
    got = classifier.fitted(docs, labels)
    good = {r.doc_id for r in labels.collect() if r.quality}
    place = docs.select("doc_id", "text", classifier.residue(docs["doc_id"]).alias("part"), classifier.F.pmod(classifier.F.xxhash64("doc_id", classifier.F.lit(9)), classifier.F.lit(1 << 20)).alias("place"))
    rows = [r for r in sorted(place.collect(), key=lambda r: (r.place, r.doc_id)) if r.part != classifier.HELD_OUT]
    x = np.array([classifier.features(r.text.encode()) for r in rows])
    want = classifier.train(x[[r.doc_id in good for r in rows]], x)
    assert np.allclose(got.weight, want.weight) and np.allclose(got.mean, want.mean) and np.isclose(got.bias, want.bias) and np.isclose(got.prior, want.prior)


def test_nothing_to_fit(spark):
    docs, labels = rows_of(spark)
    assert classifier.judged(docs.limit(0), labels.limit(0)).count() == 0
    assert {r.score for r in classifier.judged(docs, labels.limit(0)).collect()} == {0.5}
