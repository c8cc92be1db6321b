"""Lattices and samples against enumeration; ways of computing that may differ only in cost."""

import collections
import itertools
import math
import random

import numpy as np
import pytest

from quire.llm import pieces, queries


@pytest.fixture(scope="module")
def vocabulary():
    v = pieces.Vocabulary.load(queries.MODEL)
    return v, v.tables()


def paths(word, v):
    """Every segmentation of a word into pieces, with its log-probability."""
    known = {p: i for i, p in enumerate(v.pieces) if not np.isnan(v.log_prob[i]) and not (p.startswith("<0x") and len(p) == 6)}
    out = {(): 0.0} if not word else {}
    for n in range(1, len(word) + 1):
        p = word[:n]
        if p in known:
            out |= {(known[p], *rest): v.log_prob[known[p]] + lp for rest, lp in paths(word[n:], v).items()}
        elif n == 1:
            ids = tuple(int(v.byte_id[b]) for b in p.encode())
            out |= {(*ids, *rest): len(ids) * v.log_prob[v.byte_id[0]] + lp for rest, lp in paths(word[n:], v).items()}
    return out


@pytest.mark.parametrize("text", ["a", "the cat", "x\ty", "no. 7\nyes", "  a", "日本 é"])
def test_first_samples_follow_the_probabilities(vocabulary, text):
    v, t = vocabulary
    of = [paths(w, v) for w in pieces.words_of(text)]
    every = {tuple(itertools.chain(*(p for p, _ in c))): sum(lp for _, lp in c) for c in itertools.product(*(x.items() for x in of))}
    z = math.log(sum(map(math.exp, every.values())))
    n = 3000
    got = pieces.encode_samples([text] * n, list(range(n)), v, t, 2)
    first = collections.Counter(tuple(g[0][0].tolist()) for g in got)
    assert set(first) <= set(every)
    assert all(abs(first[k] / n - math.exp(every[k] - z)) < 0.04 for k in every)
    assert all(abs(g[0][1] - (every[tuple(g[0][0].tolist())] - z)) < 1e-9 for g in got[:100])
    assert all(len({tuple(s[0].tolist()) for s in g}) == len(g) == min(2, len(every)) for g in got)
    assert all(g[0][2] >= g[-1][2] for g in got)
    if len(every) > 2:
        assert abs(np.mean([sum(math.exp(s[1] - s[3]) for s in g) for g in got]) - 1) < 0.05


def test_words(vocabulary):
    r = random.Random(1)
    odd = ["", " ", "\n", "a", "a b", " a", "a  b", "a \n b", "▁", "x▁ ▁", "_▁", "a\tb", "\n\n", "trailing ", *["".join(r.choice("ab \n▁") for _ in range(30)) for _ in range(50)]]
    for texts in (odd, [*odd, "a\0b", "\0"]):
        words, count = pieces.all_words(texts)
        assert words.to_pylist() == [w for x in texts for w in pieces.words_of(x)]
        assert count.tolist() == [len(pieces.words_of(x)) for x in texts]
    words, count = pieces.all_words([])
    assert len(words) == 0 and len(count) == 0


def test_walks_by_number_and_by_array_agree(vocabulary, monkeypatch):
    v, t = vocabulary
    r = random.Random(2)
    texts = [" ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 30))) for _ in range(r.randint(0, 40))) for _ in range(30)]
    a = pieces.encode_samples(texts, list(range(30)), v, t, 3)
    monkeypatch.setattr(pieces, "FEW", 0)
    monkeypatch.setattr(pieces, "WINDOW", 2)
    b = pieces.encode_samples(texts, list(range(30)), v, t, 3)
    assert [[(s[0].tolist(), s[2]) for s in x] for x in a] == [[(s[0].tolist(), s[2]) for s in x] for x in b]


def test_long_words_and_texts(vocabulary):
    v, t = vocabulary
    r = random.Random(3)
    texts = ["".join(r.choice("abcdé") for _ in range(50_000)), "word " * 60_000, "\n" * 500, ""]
    d = v.decoder()
    for text, samples in zip(texts, pieces.encode_samples(texts, [1, 2, 3, 4], v, t, 2), strict=True):
        assert all(d(s[0]) == text for s in samples)
        ids = [s[0] for s in samples]
        assert d.utf8(np.concatenate(ids).astype(np.int32), np.cumsum(list(map(len, ids)))) == [text.encode()] * len(samples)
