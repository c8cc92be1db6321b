"""Small fixtures with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from conftest import DATA, same
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import chat, classifier, components, cws, html, mixing, pieces, queries, rules, sharding, simhash, sql, urls

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = "fp bigint, size bigint, bucket int, src int, slot int, page string, key string, t string, n bigint"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ing", "ed", "er"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(120, 1)
    texts = [base, base, base.replace("alpha", "Alpha", 1), prose(200, 2), prose(80, 3), "", None, "one two", "  \n\n ", prose(5000, 4), "日本語 é ▁ \U0001F600 x", "dup\ndup\ndup", prose(60, 5) + " ### $$$ %%% &&&" * 20]
    rows = [(i, t, "en", f"s{i % 3}" if i != 4 else None, 0) for i, t in enumerate(texts)]
    rows += [rows[3], (None, prose(30, 6), "en", "s1", 0)]
    extra = (1, 2, 3, 4, 5, "p", "k", "t", 9)
    return spark.createDataFrame([r + extra for r in rows], f"{SCHEMA}, {EXTRA}")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(name, spark, duck):
    df = queries.QUERIES[name](spark, DATA)
    if name in sql.ORACLES:
        got, want = same(df, duck, sql.ORACLES[name])
        assert got == want
    else:
        assert df.count() > 0


def test_cws(spark, docs, none):
    got = cws.compared(docs).collect()
    rows = sorted([(r.doc_id, r.text or "") for r in docs.collect()], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = collections.Counter()
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1], strict=True):
        import hashlib

        k = len(a) // 2
        want[(i, len(a), hashlib.sha256((a[: len(a) - k] + b[:k]).encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[1].fingerprint and by[5].fingerprint == by[6].fingerprint != by[7].fingerprint
    assert cws.compared(none).count() == 0


def test_cws_is_generalised_jaccard():
    s = cws.Sampler(2048)
    a, b = ("a b c d e f g " * 6 + "x y z w v u " * 9).encode(), ("a b c d e f g " * 3 + "x y z w v u " * 9).encode()

    def bag(t):
        w = t.split()
        return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))

    x, y = bag(a), bag(b)
    assert abs(cws.likeness(*s.signatures([a, b])) - sum((x & y).values()) / sum((x | y).values())) < 0.04


def test_urls(spark):
    pages = spark.createDataFrame([(1, "https://a.Example.com/en/1", "x"), (2, None, "x"), (3, "no", "x"), (4, "http://x.net/fr/?q", "x"), (4, "http://x.net/fr/?q", "x"), (5, "ftp://net/es", "x"), (6, "http://www.example.com/en/", "x"), (7, "http://com", "x")], "page_id bigint, url string, host string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages).collect())
    assert got == [(1, "a.example.com", "/en/1", "example.com/en/", "block"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "x.net", "/fr/", "net/fr/", "block"), (4, "x.net", "/fr/", "net/fr/", "block"), (5, "net", "/es", None, "allow"), (6, "www.example.com", "/en/", "www.example.com/en/", "allow"), (7, "com", "", None, "allow")]
    assert urls.judged(pages.limit(0)).count() == 0


def test_digest_array_confirms_strings(tmp_path):
    rules_ = [("block", f"h{i}.com", "/") for i in range(500)] + [("allow", "h7.com", "/")]
    (tmp_path / "a").write_bytes(urls.DigestArray.pack(rules_))
    a = urls.DigestArray.map(str(tmp_path / "a"))
    assert [a.string(i) for i in a.find([b"h3.com/", b"h499.com/"])] == [b"h3.com/", b"h499.com/"] and a.find([b"h3.com"]).tolist() == [-1]
    assert a.judge(["h7.com", "x.h9.com", "h9.org"], ["/", "/q", "/"]) == (["h7.com/", "h9.com/", None], ["block", "block", "allow"])


def test_simhash_matches_brute_force(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def fp(t):
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(range(len(rows)), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= 4:
            root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    want = collections.Counter((i, fps[k], min((x for x in least[find(k)] if x is not None), default=None)) for k, (i, _) in enumerate(rows))
    got = collections.Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 3, 4, 5, 7, 9, 10, 11, 12]


def test_gray_index_finds_every_link():
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in r.choice(64, r.integers(0, 7), replace=False)) for _ in range(900)], np.uint64)
    fps = np.unique(np.concatenate([base, base[r.integers(0, 300, 900)] ^ flips]))
    a, b = simhash.GrayIndex(np.zeros(len(fps), np.int64), fps, 4).link()
    got = np.arange(len(fps))
    got[a] = b
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    want = np.arange(len(fps))
    while True:
        new = np.array([want[near[i]].min() for i in range(len(fps))])
        if (new == want).all():
            break
        want = new
    assert len(set(zip(got.tolist(), want.tolist(), strict=True))) == len(set(got.tolist())) == len(set(want.tolist()))


def test_masks_cover_every_pair():
    r = random.Random(1)
    m = simhash.masks(4, 5)
    for _ in range(300):
        x = sum(1 << b for b in r.sample(range(64), 4))
        assert any(x & k == 0 for k in m)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (40, 50), (7, 7), (None, 3)], "u bigint, v bigint")
    assert {(r.node, r.root) for r in components.components(edges).collect()} == {(i, 0) for i in range(1, 21)} | {(50, 40)}


def test_html():
    page = """<html><head><title>T</title></head><body><header>Top</header><nav><ul><li>a<li>b</ul></nav><div class="cookie-notice">We use</div>
    <article><header><h1>Head &amp; co</h1></header><p>One <b>tw</b>o<p class=ad>buy<p>three &lt;x&gt; 1 < 2<div id="comments"><p>nice</div><form>f</form>
    <aside>s</aside><script>var x = "</p>";</script><!-- c --><ul><li>p<li>q</ul></article><footer>f</footer></body></html>"""
    assert html.main_text(page) == "Head & co One two three <x> 1 < 2 p q"
    assert html.main_text("") == "" and html.main_text("<p>a<br>b  c") == "a b c" and html.main_text("<article><p>x</article") == "x"


def test_html_host_boilerplate(spark):
    menu = "<div>home about contact shop blog news jobs help login</div>"
    pages = [(i, f"http://h.com/{i}", f"{menu}<p>{prose(30, i)}</p><div>all rights kept by the owners of this small site</div>", "z") for i in range(4)]
    pages += [(9, None, None, "z"), (10, "http://h.com/0", pages[0][2], "z"), (11, "http://alone.com/", pages[1][2], "z")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, starts string")
    got = {r.page_id: r.text for r in html.extracted(df).collect()}
    assert all(got[i] == prose(30, i) for i in range(4)) and got[10] == got[0] and got[9] == ""
    assert got[11].startswith("home about") and html.extracted(df.limit(0)).count() == 0


def test_mixing(spark, docs, none):
    m = mixing.mix(docs)
    rows = mixing.amounts(m).collect()
    assert len(rows) == docs.count() and all(r.taken <= 3 * r.size for r in rows)
    by = {r.source: r for r in m.sources.collect()}
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").encode().split())
    assert {s: r.source_size for s, r in by.items()} == dict(sizes) and by[None].src == 3
    assert math.isclose(sum(r.target for r in by.values()), sum(sizes.values()), rel_tol=1e-9)
    assert all(r.target <= 3 * r.source_size + 1e-6 for r in by.values())
    taken = collections.Counter()
    for r in m.pieces.join(m.sources, "src").collect():
        taken[r.source] += r.to_word - r.from_word
    assert all(abs(taken[s] - r.target) <= 4 * m.words + 1 for s, r in by.items())
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.amounts(mixing.mix(docs)).collect()), key=str)
    assert mixing.amounts(mixing.mix(none)).count() == 0
    assert mixing.resampled(docs).columns == docs.columns and mixing.resampled(none).count() == 0


def test_mixing_fills_like_water(spark):
    sized = spark.createDataFrame([(1, "a", 10), (2, "b", 100), (3, "c", 1000), (4, "d", 5)], "doc_id bigint, source string, size bigint")
    got = {r.source: r.target for r in mixing.targets(sized).collect()}
    weight, size = {"a": 5.0, "b": 2.0, "c": 1.0, "d": 5.0}, {"a": 10, "b": 100, "c": 1000, "d": 5}
    want, rest, free = {}, 1115.0, set(weight)
    while True:
        part = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if part[s] > 3 * size[s]}
        if not over:
            break
        want |= {s: 3.0 * size[s] for s in over}
        rest -= sum(3 * size[s] for s in over)
        free -= over
    assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in (want | part).items() if k in want or k in free}


def test_rules(spark, docs, none):
    for r in rules.judged(docs).join(docs.select("doc_id", "text"), "doc_id").dropDuplicates(["doc_id"]).collect():
        t = r.text or ""
        w = t.encode().split()
        three = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(w), len(covered), len(lines) - len(set(lines)))
        assert r.word_chars == sum(len(x.decode()) for x in w) and r.n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert rules.judged(none).count() == 0 and rules.ordered(none) == list(rules.RULES)
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    assert ids(rules.kept(docs)) == ids(rules.judged(docs).where("kept")) and "12" not in ids(rules.kept(docs))


def test_rules_order_does_not_matter(spark, docs):
    text = F.coalesce("text", F.lit(""))
    for order in (rules.RULES, rules.RULES[::-1]):
        v = docs.select(rules.verdict(order, {"text": text}).alias("k")).where("k").count()
        assert v == rules.judged(docs).where("kept").count()


def test_chat_folds_events(spark):
    log = [
        (1, 0, "message", 0, "user", "hi"), (1, 1, "delta", 1, "assistant", "Hel"), (1, 2, "delta", 1, None, "lo"), (1, 3, "message", 2, "user", "more"),
        (1, 4, "message", 3, "assistant", "bad"), (1, 5, "edit", 2, "user", "more please"), (1, 6, "regenerate", 3, "assistant", "go"), (1, 7, "delta", 3, None, "od </s>"),
        (2, 0, "message", 0, "user", "a"), (2, 1, "message", 1, "assistant", "b"), (2, 2, "regenerate", 0, "user", "c\\ <|im_end|>"),
    ]
    df = spark.createDataFrame(log, "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string").repartition(5)
    got = collections.defaultdict(str)
    for r in sorted(chat.formatted(df).collect(), key=lambda r: (r.conv_id, r.turn_no)):
        got[r.conv_id] += r.segment
    assert [x[:2] for x in chat.parse(got[1])] == [("user", "hi"), ("assistant", "Hello"), ("user", "more please"), ("assistant", "good </s>")]
    assert [x[:2] for x in chat.parse(got[2])] == [("user", "c\\ <|im_end|>")]


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "\\", "\\\\<|im_end|>\\n", "<<|im_end|>", "<<SYS>><</SYS>>", "<", "a\nb"])
def test_chat_round_trip(text):
    s = chat.render(text, text) + chat.render("assistant", text)
    assert [x[:2] for x in chat.parse(s)] == [(text, text), ("assistant", text)] and s.count("<|im_end|>") == 2


def test_chat_nulls(spark):
    df = spark.createDataFrame([(1, 0, "user", None), (1, 0, None, "x"), (None, 0, "assistant", "y"), (1, 0, "user", None)], "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(df).collect()}
    assert got == {1: (3, 0), None: (1, 1)} and chat.digests(df.limit(0)).count() == 0


def test_sharding(spark, docs, none):
    df, m = sharding.sharded(docs)
    rows = df.collect()
    assert len(rows) == docs.count() and {r.shard for r in rows} <= set(range(16))
    per = collections.defaultdict(list)
    for r in rows:
        per[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 1 for r in rows)
    assert sharding.sharded(none)[0].count() == 0


def test_slot_map(spark, tmp_path):
    size = [random.Random(i).randint(1, 100) for i in range(500)]
    m = sharding.SlotMap.packed(size, 16)
    assert max(m.loads(size)) - min(m.loads(size)) <= 100
    g = m.grown(size)
    assert g.version == 2 and g.shards == 17 and all(g.shard[i] == 16 for i in range(500) if g.shard[i] != m.shard[i])
    assert g.loads(size)[16] > 0.9 * sum(size) / 17
    size[0] = 2000
    r = m.rebalanced(size)
    assert max(r.loads(size)) <= max(m.loads(size)) and set(r.moved) == {i for i in range(500) if r.shard[i] != m.shard[i]}
    r.save(spark, str(tmp_path))
    assert sharding.SlotMap.load(spark, str(tmp_path), 2) == r


def test_classifier(spark, docs, none):
    r = random.Random(3)
    good = [(i, prose(r.randint(60, 200), i)) for i in range(300)]
    bad = [(i, prose(100, i).replace(" ", "*** ")) for i in range(300, 400)]
    df = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(0, 400, 2)], "doc_id bigint, quality int")
    rows = classifier.judged(df, labels).collect()
    held = [x for x in rows if x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    assert sum(x.predicted == (x.doc_id < 300) for x in held) >= 0.95 * len(held)
    assert len(classifier.judged(docs, labels).collect()) == docs.count()
    assert classifier.judged(none, labels).count() == 0
    assert {x.score for x in classifier.judged(df.limit(5), labels.limit(0)).collect()} == {0.5}
    kept = classifier.kept(docs, labels)
    assert kept.columns == docs.columns


@pytest.fixture(scope="module")
def vocabulary():
    v = pieces.Vocabulary.load(queries.MODEL)
    return v, v.tables()


def test_pieces_round_trip(spark, docs, none, vocabulary):
    rows = pieces.sampled(docs, queries.MODEL, 3).collect()
    assert all(r.round_trip for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(tuple(r.ids))
    assert by[5] == by[6] == [()] and len(set(by[9])) == 3 and len(set(by[3])) == 3 and len(by[3]) == 6
    assert pieces.sampled(none, queries.MODEL).count() == 0
    v, t = vocabulary
    for text in ["a  b", " a", "\n", " \n ", "▁", "▁ ▁x", "x" * 300, "é\u0000\U0010ffff", "a\tb\r\nc "]:
        for s in pieces.encode_samples([text], [1], v, t, 3)[0]:
            assert v.decoder()(s[0]) == text


def test_pieces_sample_without_replacement(vocabulary):
    v, t = vocabulary
    text = "▁" + "the cat".replace(" ", "▁")
    known = {p: i for i, p in enumerate(v.pieces) if not np.isnan(v.log_prob[i]) and not p.startswith("<0x")}
    paths = {}

    def walk(at, ids, lp):
        if at == len(text):
            paths[ids] = lp
        for n in range(1, 17):
            p = text[at : at + n]
            if len(p) == n and p in known and "▁" not in p.lstrip("▁"):
                walk(at + n, (*ids, known[p]), lp + v.log_prob[known[p]])

    walk(0, (), 0.0)
    z = math.log(sum(math.exp(x) for x in paths.values()))
    p = {k: math.exp(x - z) for k, x in paths.items()}
    n = 4000
    got = pieces.encode_samples(["the cat"] * n, list(range(n)), v, t, 2)
    first = collections.Counter(tuple(g[0][0].tolist()) for g in got)
    for k in sorted(p, key=p.get)[-4:]:
        assert abs(first[k] / n - p[k]) < 0.03
    assert abs(np.mean([sum(math.exp(s[1] - s[3]) for s in g) for g in got]) - 1) < 0.03
    assert all(abs(math.exp(g[0][1]) - p[tuple(g[0][0].tolist())]) < 1e-9 for g in got[:50])
    assert len(pieces.encode_samples(["a"], [1], v, t, 9)[0]) == 2


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        out = stage(spark, docs, DATA)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name.replace(" ", "_")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        assert 0 < docs.count() <= 3 * before
    assert docs.where("not round_trip").count() == 0
