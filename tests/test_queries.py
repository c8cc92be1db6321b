import pytest
from conftest import DATA, same

from quire.plans import more  # noqa: F401 - registers its queries
from quire.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    if name in ORACLES:
        got, want = same(df, duck, ORACLES[name])
        assert got == want
    else:
        assert df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_llm(tmp_path):
    """The rest imports and registers its queries where the llm folder and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "quire", tmp_path / "quire", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 50 and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
