"""The suffix array of a host's pages against brute force, and that every page goes through it."""

import random
from collections import defaultdict

import numpy as np

from quire.llm import common, html


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_array_is_sorted_and_finds_all_shared_runs():
    r = random.Random(3)
    for run in (1, 3, 5, 8):
        for size in (1, 2, 40):
            pages = [np.array([r.randrange(3) for _ in range(r.randrange(size + 1))], np.uint32) for _ in range(9)]
            pages += [np.tile(np.array([1, 2], np.uint32), 30)] * 2
            x = np.concatenate(pages).astype(np.int64)
            order, long = html.suffix_array(x, run)
            ends = [x[i:].tolist() for i in order]
            assert ends == sorted(ends)
            assert long.tolist() == [len(a) >= run and a[:run] == b[:run] for a, b in zip(ends, ends[1:])]
            want = defaultdict(set)
            for i, p in enumerate(pages):
                for j in range(len(p) - run + 1):
                    want[int(html.windows(p[j : j + run], run)[0])].add(i)
            key, n = html.shared_runs(pages, run)
            assert dict(zip(key.tolist(), n.tolist())) == {k: len(v) for k, v in want.items()}


def rows_of(spark, pages):
    return spark.createDataFrame([(i, f"http://h.com/{i}", p) for i, p in enumerate(pages)], "page_id bigint, url string, html string")


def test_shares_are_exact_over_groups(spark, monkeypatch):
    """Runs on 2, 5, 9, 10, 20 and 39 of 40 pages, in groups of about three: a quarter is ten."""
    monkeypatch.setattr(html, "GROUP", 3)
    lines = {k: prose(12, 1000 + k) for k in (2, 5, 9, 10, 20, 39)}
    pages = ["".join(f"<div>{t}</div>" for k, t in lines.items() if i * 7 % 40 < k) + f"<p>{prose(30, i)}</p>" for i in range(40)]
    got = {r.page_id: r.text for r in html.extracted(rows_of(spark, pages + pages[:5])).collect()}
    assert got == {i: " ".join([t for k, t in lines.items() if i % 40 * 7 % 40 < k and k < 10] + [prose(30, i % 40)]) for i in range(45)}


def test_named_pages_are_judged_by_their_host(spark):
    """A notice that most pages name as such goes from the articles that a template put it into, too; a line of the articles' own stays."""
    notice, own = prose(12, 7), prose(12, 8)
    pages = [f'<div class="cookie">{notice}</div><article><p>{prose(30, i)}</p><p>{own}</p></article>' for i in range(9)]
    pages += [f"<article><div>{notice}</div><p>{prose(30, i)}</p><p>{own}</p></article>" for i in range(9, 12)]
    got = {r.page_id: r.text for r in html.extracted(rows_of(spark, pages)).collect()}
    assert got == {i: f"{prose(30, i)} {own}" for i in range(12)}


def test_joins_without_broadcast(spark, monkeypatch):
    """Too many hosts or keys to broadcast: the same texts."""
    menu = "<div>home about contact shop blog news jobs help login</div>"
    rows = [(i, f"http://{'big' if i < 40 else i}.com/{i}", menu + f"<p>{prose(30, i)}</p>") for i in range(50)] + [(50, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    want = {r.page_id: r.text for r in html.extracted(df).collect()}
    assert want == {i: prose(30, i) if i < 40 else f"home about contact shop blog news jobs help login {prose(30, i)}" if i < 50 else "" for i in range(51)}
    for module, name in ((html, "HOSTS"), (html, "KEYS"), (common, "FEW")):
        monkeypatch.setattr(module, name, 0)
    monkeypatch.setattr(html, "GROUP", 7)
    assert {r.page_id: r.text for r in html.extracted(df).collect()} == want
