"""On pages that name no article, what only two pages of a host share isn't boilerplate."""

import random

from quire.llm import html


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_near_copy_and_quote_stay(spark):
    menu = "<div>home about contact shop blog news jobs help login</div>"
    bodies = [[prose(40, 10 * i + k) for k in range(3)] for i in range(6)]
    bodies[1] = [*bodies[0][:2], prose(40, 99)]  # a second version
    bodies[3] = [bodies[3][0], bodies[2][1], bodies[3][2]]  # a quoted paragraph
    rows = [(i, f"http://h.com/{i}", menu + "".join(f"<p>{p}</p>" for p in b)) for i, b in enumerate(bodies)]
    got = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: " ".join(b) for i, b in enumerate(bodies)}
