"""Near-dedup against brute force where a passage is shared and where shingles repeat."""

import itertools
import random

import pytest

from quire.llm import common, simhash


def words(n, r):
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n)]


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_force(rows, similarity=0.8):
    """The ids that stay of (doc_id, text)."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if sets[a] == sets[b] or n >= similarity * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [i for i in sorted(root) if find(i) == i]


def kept(spark, rows):
    return sorted(r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())


@pytest.mark.parametrize("few", [-1, 20_000])
def test_pairs_inside_a_family(spark, monkeypatch, few):
    """Texts that share a passage, 0.5 to 0.7 alike, and pairs among them that are 0.85 alike."""
    monkeypatch.setattr(common, "FEW", few)
    r = random.Random(1)
    passage, texts = words(150, r), []
    for i in range(120):
        own = words(r.choice((40, 60, 70)), r)
        texts.append(passage + own)
        if i % 4 == 0:
            twin = passage + own
            for at in (155, 165, 175):
                twin[at] = words(1, r)[0]
            texts.append(twin)
    r.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = brute_force(rows)
    assert len(want) == 120
    assert kept(spark, rows) == want


def test_repeated_passages(spark):
    """A passage that occurs once in one text and often in its twin; and unlike texts that one repeated shingle outweighs."""
    r = random.Random(2)
    texts = []
    for _ in range(30):
        passage, own = words(24, r), words(100, r)
        texts += [" ".join(own + passage), " ".join(own + passage * 4)]
    same = " ".join(["again"] * 200)
    texts += [f"{same} {' '.join(words(60, r))}" for _ in range(6)]
    rows = list(enumerate(texts))
    want = brute_force(rows)
    assert len(want) == 36
    assert kept(spark, rows) == want


def test_rows_of_one_id(spark):
    """Rows that share an id but not a text are judged as any others; null ids and repeated rows too."""
    r = random.Random(3)
    a, b, c = (" ".join(words(60, r)) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "y"), (None, c, "z"), (None, c, "z"), (None, a, "z"), (3, None, "n"), (4, "", "n"), (5, " \n", "n"), (1, b, "x"), (7, "one two", "s"), (8, "ONE  two", "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, no_id string")
    got = sorted(map(tuple, simhash.keep_one(df).collect()), key=repr)
    assert got == sorted([(1, a, "x"), (1, b, "x"), (None, c, "z"), (3, None, "n"), (7, "one two", "s")], key=repr)
    assert simhash.keep_one(df.limit(0)).count() == 0 and simhash.keep_one(df).columns == df.columns


def edited(text, share, r):
    w = list(text)
    for at in r.sample(range(len(w)), max(1, int(share * len(w)))):
        w[at] = words(1, r)[0]
    return w


def test_recall_over_edits(spark):
    """Copies with any share of words changed, of texts of all lengths, with repeated halves and shared passages."""
    r = random.Random(4)
    passages = [words(50, r) for _ in range(4)]
    texts = []
    for i in range(150):
        base = words(r.choice((3, 6, 20, 60, 200, 600)), r)
        if i % 3 == 0:
            base = base + r.choice(passages)
        if i % 5 == 0:
            base = base * r.randint(2, 6)
        texts.append(base)
        for _ in range(r.randint(0, 3)):
            texts.append(edited(base, r.choice((0.0, 0.005, 0.01, 0.02, 0.03, 0.05)), r))
    r.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = brute_force(rows)
    assert len(want) < len(rows) - 50
    assert kept(spark, rows) == want
