"""Rule files, word lists, configurations and timers, with what they must refuse."""

import time

import pytest
from pyspark.sql import functions as F

from quire.operators import costs, proof
from quire.plans import more, runs
from quire.sources import corpus, rules

FLAT = {"options": [{"id": "a"}, {"id": "b"}]}


@pytest.mark.parametrize(
    "parsed",
    [
        {"_order": {"order": []}, "x": FLAT}, {"_order": {"order": ["x", "x"]}, "x": FLAT}, {"_order": {"order": ["x", "y"]}, "x": FLAT}, {"_order": {"order": ["x"]}, "x": FLAT, "y": FLAT}, {"x": FLAT},
        {"_order": {"order": ["x"]}, "x": {}}, {"_order": {"order": ["x"]}, "x": {**FLAT, "groups": [{"id": "g", "options": [{"id": "a"}]}]}}, {"_order": {"order": ["x"]}, "x": {"options": [{"id": "a"}, {"id": "a"}]}},
        {"_order": {"order": ["x"]}, "x": {"options": [{"weight": 1}]}}, {"_order": {"order": ["x"]}, "x": {"options": [{"id": "a", "weight": -1}]}}, {"_order": {"order": ["x"]}, "x": {"options": [{"id": "a", "colour": 1}]}},
        {"_order": {"order": ["x"]}, "x": {"groups": [{"id": "g"}]}}, {"_order": {"order": ["x"]}, "x": {"groups": [{"id": "g", "params": {}, "options": [{"id": "a"}]}]}},
    ],
)
def test_refused_rules(spark, parsed):
    with pytest.raises(rules.RuleError):
        rules.table(spark, parsed)


def test_rules_round_trip(spark, tmp_path):
    options, groups = rules.table(spark, more.RULES)
    for name, body in rules.written(options).items():
        (tmp_path / name).write_text(body, encoding="utf-8")
    again, none = rules.read(spark, str(tmp_path))
    names = ["attr_pos", "attr", "opt_pos", "id", "weight", "tags", "requires", "excludes", "params"]
    assert sorted(map(str, options.select(names).collect())) == sorted(map(str, again.select(names).collect())) and none.count() == 0
    assert rules.attributes(options) == ["document", "layout", "augmentation"] and groups.count() == 2
    bare = [{k: v for k, v in o.items() if k != "params"} for o in FLAT["options"]]
    with_params, _ = rules.table(spark, {"_order": {"order": ["x"]}, "x": {"options": bare}}, {"x": {"a": {"k": 1}, "b": None}})
    assert [r["params"] for r in with_params.orderBy("id").collect()] == ['{"k": 1}', "{}"]
    with pytest.raises(rules.RuleError):
        rules.table(spark, {"_order": {"order": ["x"]}, "x": FLAT}, {"x": {"a": {}}})


def test_pins_and_overrides(spark):
    known = ["layout", "augmentation"]
    assert rules.pins(["augmentation = none"], known, "wide") == {"layout": "wide", "augmentation": "none"} and rules.pins(None, known) == {}
    assert rules.pins(["layout=x"], known, "wide") == {"layout": "x"}
    for bad in (["layout"], ["layout="], ["colour=red"]):
        with pytest.raises(rules.RuleError):
            rules.pins(bad, known)
    options = rules.table(spark, more.RULES)[0]
    for bad in ({"layout.wide": 1}, {"layout.none.weight": 1}, {"layout.wide.params": 1}, {"layout.wide.weight": -1}):
        with pytest.raises(rules.RuleError):
            rules.overridden(options, bad)


def test_corpus(spark, tmp_path):
    files = {"vi/items_eatery.txt": "# goods\nphở\t10\t20\n\nbad line\nbún\t5\t6\n", "vi/shops_eatery.txt": "A\n B \n", "vi/footers_eatery.txt": "#\n", "vi/streets.txt": "S 1\nS 2\n", "vi/wards.txt": "a\tb\tc\nx\n", "vi/payments.txt": "cash\n", "en/people.txt": "Ann\n"}
    for name, body in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body, encoding="utf-8")
    lists = corpus.lists(spark, str(tmp_path))
    assert [tuple(r) for r in corpus.table(lists, "items", "vi", "eatery").collect()] == [(1, "phở", 10, 20), (4, "bún", 5, 6)]
    assert [r["name"] for r in corpus.table(lists, "shops", "vi", "eatery").collect()] == ["A", "B"] and [r["name"] for r in corpus.table(lists, "streets", "vi").collect()] == ["S 1", "S 2"]
    assert [r["lang"] for r in corpus.languages(lists).collect()] == ["en", "vi"]
    got = {(r["lang"], r["list"], r["problem"]) for r in corpus.problems(lists).collect()}
    assert got == {("vi", "people", "missing"), ("vi", "payments", "no usable line"), ("vi", "footers_eatery", "missing"), ("en", "streets", "missing"), ("en", "wards", "missing"), ("en", "payments", "missing"), ("en", "items", "no profile")}


@pytest.mark.parametrize(
    "change",
    [
        {"backends": []}, {"backends": "html"}, {"run": {"per_backend": 3}}, {"run": {"out": "o", "per_backend": 0}}, {"shard": {"size": 0}}, {"run": {"out": "o", "per_backend": 1, "pairing": "some"}}, {"run": {"out": "o", "per_backend": 1, "layouts": "a"}},
        {"other": 1}, {"run": {"out": "o", "per_backend": 1, "colour": 1}}, {"overrides": []}, {"run": {"out": "o", "per_backend": 1, "template": "t"}}, {"run": {"out": "o", "per_backend": 1, "workers": "many"}}, {"run": [1]},
    ],
)
def test_refused_configurations(change):
    base = {"run": {"out": "o", "per_backend": 3}, "backends": ["glyph"]}
    assert runs.config(base).shard_size == 250 and runs.config(base).workers >= 1
    if change == {"overrides": []}:
        change = {"overrides": [1]}
    with pytest.raises(runs.ConfigError):
        runs.config({**base, **change}, html_only=("glyph",))


def test_plans(spark):
    c = runs.config(more.CONFIG)
    with pytest.raises(runs.ConfigError):
        runs.build_plan(spark, runs.config({**more.CONFIG, "run": {**more.CONFIG["run"], "per_backend": 3000}}), ["a", "b"]).count()
    with pytest.raises(runs.ConfigError):
        runs.build_plan(spark, runs.config({**more.CONFIG, "run": {**more.CONFIG["run"], "force": ["layout=z"]}}), ["a"])
    plan = runs.build_plan(spark, runs.config({**more.CONFIG, "run": {**more.CONFIG["run"], "force": ["layout = b"]}}), ["a", "b"])
    assert {r["layout"] for r in plan.collect()} == {"b"} and plan.agg(F.sum("count")).first()[0] == 159
    text = runs.plan_json(spark, c, plan).first()["plan"]
    import json

    told = json.loads(text)
    assert told["per_backend"] == 53 and len(told["shards"]) == 9 and sum(s["count"] for s in told["shards"]) == 159
    assert runs.tolerance_of(None) == runs.tolerance_of({"drift_tolerance": "x"}) == runs.tolerance_of({"drift_tolerance": -1}) == runs.TOLERANCE and runs.tolerance_of({"drift_tolerance": 0.3}) == 0.3


def test_timer(spark):
    t = costs.Timer()
    with t.stage("a"):
        time.sleep(0.01)
        with t.stage("b"):
            time.sleep(0.02)
    rows = {r["path"]: r for r in t.report(spark).collect()}
    assert set(rows) == {"a", "a/b"} and rows["a"]["inclusive"] >= rows["a/b"]["inclusive"] and abs(rows["a"]["inclusive"] - rows["a"]["exclusive"] - rows["a/b"]["inclusive"]) < 1e-9
    assert 0 < t.calibrate(100) < 0.01 and not costs.enabled(spark).on
    off = costs.Timer(False)
    with off.stage("x"):
        pass
    assert off.seen == {}
    t.reset()
    assert t.report(spark).count() == 0


def test_markdown(spark):
    lines = [r["line"] for r in proof.markdown(spark.createDataFrame([("b", 1), ("a", None)], "x string, y int"), ["x", "y"]).orderBy("pos").collect()]
    assert lines == ["| x | y |", "| --- | --- |", "| a |  |", "| b | 1 |"]
