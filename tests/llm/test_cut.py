"""What is cut ends its lineage, its estimate and its shuffles; scratch files go."""

import os

import pytest

from quire.llm import common, components


def bits(df):
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


@pytest.mark.parametrize("few", [-1, 20_000])
def test_estimates_stay_small_over_many_steps(spark, monkeypatch, few):
    """Each join multiplies estimates, so a loop of joins once filled the driver with their digits."""
    monkeypatch.setattr(common, "FEW", few)
    cut, seen = common.cut, []

    def watched(df, *folder):
        out = cut(df, *folder)
        seen.append(bits(out))
        return out

    monkeypatch.setattr(common, "cut", watched)
    monkeypatch.setattr(components, "cut", watched)
    got = components.components(spark.range(300).selectExpr("id as u", "id + 1 as v"))
    assert sorted((r.node, r.root) for r in got.collect()) == [(i, 0) for i in range(1, 301)]
    assert len(seen) > 6 and max(seen) < 64 and bits(got) < 64


def test_scratch_files_go(spark):
    with common.scratch(spark) as brief:
        df = brief(spark.range(1000).selectExpr("id % 7 as k", "cast(null as string) as t").groupBy("k", "t").count())
        (folder,) = {os.path.dirname(os.path.dirname(f)) for f in df.inputFiles()}
        kept = common.cut(df.where("k > 2"))
        assert brief(df.limit(0)).count() == 0 and df.columns == ["k", "t", "count"]
    assert kept.count() == 4
    assert not os.path.exists(folder.removeprefix("file://"))
    assert spark.conf.get(common.CLEANED, None) != "true"
