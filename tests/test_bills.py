import random

import duckdb
import pytest
from conftest import same

from quire.operators import tables
from quire.plans import more  # noqa: F401 - registers its queries
from quire.plans.registry import ORACLES, QUERIES



@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    """Orders of sf0.1 that sum to a half, their lines dealt over files, the later ones larger (Spark reads large files first)."""
    root = tmp_path_factory.mktemp("bills")
    con = duckdb.connect()
    con.sql("CREATE TABLE l AS SELECT * FROM read_parquet('/root/testdata/sf0.1/lineitem.parquet') WHERE l_orderkey < 20000")
    con.sql("CREATE TABLE k AS SELECT l_orderkey FROM l GROUP BY 1 HAVING sum(l_extendedprice::DECIMAL(18, 2)) % 1 = 0.5")
    con.sql(f"COPY (SELECT * FROM read_parquet('/root/testdata/sf0.1/orders.parquet') WHERE o_orderkey IN (FROM k)) TO '{root}/orders.parquet' (FORMAT parquet)")
    (root / "lineitem.parquet").mkdir()
    con.sql("CREATE TABLE p AS SELECT l.*, row_number() OVER (PARTITION BY l_orderkey) % 4 AS part FROM l JOIN k USING (l_orderkey)")
    con.sql("CREATE TABLE more AS SELECT p.* REPLACE (-1 AS l_orderkey, r.i AS l_extendedprice) FROM (FROM p LIMIT 1) p, range(1500) r(i)")
    for i in range(4):
        con.sql(f"COPY (SELECT * EXCLUDE part FROM p WHERE part = {i} UNION ALL (SELECT * EXCLUDE part FROM more LIMIT {500 * i})) TO '{root}/lineitem.parquet/{i}.parquet' (FORMAT parquet)")
    return root


@pytest.mark.parametrize("name", ["sheet_blocks", "sheet_items", "grid_framed_totals", "grid_totals"])
def test_sums_in_the_order_of_rows(name, spark, scattered):
    con = duckdb.connect()
    con.sql("SET threads = 1")  # with more, the order of its additions, and its result, differs between runs
    con.sql(f"CREATE VIEW orders AS FROM read_parquet('{scattered}/orders.parquet')")
    con.sql(f"CREATE VIEW lineitem AS FROM read_parquet('{scattered}/lineitem.parquet/*.parquet') WHERE l_orderkey >= 0")
    got, want = same(QUERIES[name](spark, str(scattered)), con, ORACLES[name])
    assert got == want


def test_plain_markup_is_read_as_by_the_parser():
    """Where the shorter way reads at all, it reads what HTMLParser does; sheets are read by it."""
    bits = ["<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", '<td rowspan="2">', '<TD colspan="3" class="r">', "a &amp; b", "5 > 4", '<span data-kind="k">', "<br/>", "<!-- <td> -->", "<title>a &lt; b</title>", "<style>td{}", "</style>", "<td", "&am", "<td rowspan=2>", '<td rowspan="0">']
    draw, read = random.Random(3), 0
    for _ in range(5000):
        x = "".join(draw.choice(bits[: draw.choice((11, 20))]) for _ in range(draw.randint(0, 20)))
        got = tables._plain_cells(x, {})
        if got is not None:
            p = tables._Cells()
            p.feed(x)
            assert [(*c[:-1], "".join(c[-1])) for c in got] == [tuple(c.values()) for c in p.cells], x
            read += 1
    assert read > 500
    assert len(tables._plain_cells('<!doctype html><html><head><meta charset="utf-8"><title>a &lt; b</title><style></style></head><body><table><tr><td data-row="0"><span>1</span></td></tr></table></body></html>', {})) == 1
