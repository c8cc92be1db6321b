"""Table structure: cells, spans, tokens and markup."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

CELL = StructType([StructField(n, StringType() if n in ("tag", "text") else IntegerType()) for n in ("tag", "row", "col", "rowspan", "colspan", "text")])
RUN = StructType([StructField("kind", StringType()), StructField("text", StringType())])


def cell_tokens(rowspan: Column, colspan: Column) -> Column:
    """A plain cell is <td> and </td>; one with spans lists its attributes between <td and >."""
    spans = F.array(F.when(rowspan > 1, F.format_string(' rowspan="%d"', rowspan)), F.when(colspan > 1, F.format_string(' colspan="%d"', colspan)))
    given = F.filter(spans, lambda x: x.isNotNull())
    return F.when(F.size(given) == 0, F.array(F.lit("<td>"), F.lit("</td>"))).otherwise(F.concat(F.array(F.lit("<td")), given, F.array(F.lit(">"), F.lit("</td>"))))


def structure_tokens(cells: DataFrame, table: str) -> DataFrame:
    """(table, tokens) of cells (table, row, col, rowspan, colspan): rows in order, cells by column.

    A table's cells are gathered in one row: tables are pages' parts and small.
    """
    rows = cells.groupBy(table, "row").agg(F.array_sort(F.collect_list(F.struct("col", cell_tokens(F.col("rowspan"), F.col("colspan")).alias("_t")))).alias("_cells"))
    tagged = rows.withColumn("_t", F.concat(F.array(F.lit("<tr>")), F.flatten(F.transform("_cells", lambda c: c["_t"])), F.array(F.lit("</tr>"))))
    return tagged.groupBy(table).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row", "_t"))), lambda r: r["_t"])).alias("tokens"))


def rebuilt(tokens: Column, texts: Column) -> Column:
    """Markup from tokens, with the texts put before each </td> in order."""
    step = lambda acc, t: F.struct(
        F.concat(acc["out"], F.when(t == "</td>", F.coalesce(F.get(texts, acc["n"]), F.lit(""))).otherwise(""), t).alias("out"), (acc["n"] + F.when(t == "</td>", 1).otherwise(0)).alias("n")
    )
    return F.aggregate(tokens, F.struct(F.lit("").alias("out"), F.lit(0).alias("n")), step, lambda acc: acc["out"])


def span_problems(cells: DataFrame, table: str) -> DataFrame:
    """(table, row, col, n): grid places that more than one cell covers."""
    over = cells.select(table, F.explode(F.sequence("row", F.col("row") + F.col("rowspan") - 1)).alias("r"), "col", "colspan").select(table, "r", F.explode(F.sequence("col", F.col("col") + F.col("colspan") - 1)).alias("c"))
    return over.groupBy(table, F.col("r").alias("row"), F.col("c").alias("col")).agg(F.count("*").alias("n")).where("n > 1")


class _Cells(HTMLParser):
    """Cells with their grid places; spans push later cells on."""

    def __init__(self) -> None:
        super().__init__()
        self.cells: list[dict] = []
        self.row, self.taken, self.open = -1, set(), None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.row += 1
        if tag in ("td", "th"):
            a = dict(attrs)
            down, across = max(1, int(a.get("rowspan") or 1)), max(1, int(a.get("colspan") or 1))
            row, col = max(0, self.row), 0
            while (row, col) in self.taken:
                col += 1
            self.taken |= {(row + i, col + j) for i in range(down) for j in range(across)}
            self.open = {"tag": tag, "row": row, "col": col, "rowspan": down, "colspan": across, "text": ""}
            self.cells.append(self.open)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self.open = None

    def handle_data(self, data: str) -> None:
        if self.open is not None:
            self.open["text"] += data


#: A tag without anything odd (after its <), and what HTMLParser reads as text up to its own end tag.
_TAG = re.compile(r'/[A-Za-z][A-Za-z0-9]*|!doctype html|([A-Za-z][A-Za-z0-9]*)((?: [A-Za-z-]+="[^"<>&]*")*)')
_RAW = frozenset(("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"))


def _tag(head: str) -> tuple[str, int, int] | None:
    """(name or /name, rowspan, colspan) of a plain tag, else null."""
    m = _TAG.fullmatch(head)
    if not m:
        return None
    a = dict(re.findall(r'([a-z-]+)="([^"]*)"', (m[2] or "").lower()))
    down, across = a.get("rowspan") or "1", a.get("colspan") or "1"
    if not (down.isdecimal() and across.isdecimal()):
        return None
    return (m[1] or head).lower(), max(1, int(down)), max(1, int(across))


def _plain_cells(markup: str, known: dict[str, tuple[str, int, int] | None]) -> list[tuple] | None:
    """The rows of _Cells (as tuples) of markup that is text and plain tags; null of any other. known: tags read before."""
    cells, starts, taken = [], {}, set()  # starts: a row's first place that may be free
    row, tag, raw = -1, "", ""
    parts = markup.split("<")
    if "&" in parts[-1]:
        return None
    for part in parts[1:]:
        head, closed, data = part.partition(">")
        if not closed:
            return None
        if head not in known:
            known[head] = _tag(head)
        read = known[head]
        if read is None or (raw and read[0] != raw):
            return None
        name, down, across = read
        raw = ""
        if name == "tr":
            row += 1
        elif name == "td" or name == "th":
            r = max(0, row)
            col = starts.get(r, 0)
            while (r, col) in taken:
                col += 1
            starts[r] = col + across
            if down > 1:
                taken.update((r + i, col + j) for i in range(1, down) for j in range(across))
            tag, text = name, []
            cells.append((name, r, col, down, across, text))
        elif name == "/td" or name == "/th":
            tag = ""
        elif name in _RAW:
            if tag or name == "plaintext":
                return None
            raw = "/" + name
        if tag and data:
            text.append(unescape(data) if "&" in data else data)
    return None if raw else cells


@F.arrow_udf(ArrayType(CELL))
def cells_of(markup: pa.Array) -> pa.Array:
    """The cells of each markup: HTMLParser's, by a shorter way where the markup is plain."""
    offsets, columns, known = [0], [[] for _ in CELL], {}
    for x in markup.to_pylist():
        cells = _plain_cells(x or "", known)
        if cells is None:
            p = _Cells()
            p.feed(x)
            cells = [(*[c[n] for n in CELL.names[:-1]], [c["text"]]) for c in p.cells]
        for c in cells:
            for column, v in zip(columns, c, strict=True):
                column.append(v)
        offsets.append(len(columns[0]))
    columns[-1] = ["".join(t) for t in columns[-1]]
    values = [pa.array(v, pa.string() if n in ("tag", "text") else pa.int32()) for n, v in zip(CELL.names, columns, strict=True)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(values, CELL.names))


class _Runs(HTMLParser):
    """Text runs with the tag, or the data-kind, of the innermost element."""

    SKIP = ("script", "style")

    def __init__(self) -> None:
        super().__init__()
        self.stack: list[str] = []
        self.runs: list[dict] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in ("br", "meta", "img", "hr", "input", "link"):
            self.stack.append(tag)
        kind = dict(attrs).get("data-kind")
        if kind:
            self.stack[-1] = f"{tag}:{kind}"

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].split(":")[0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data: str) -> None:
        text = " ".join(data.split())
        kind = self.stack[-1] if self.stack else ""
        if text and kind not in self.SKIP:
            self.runs.append({"kind": kind.partition(":")[2] or kind, "text": text})


@F.pandas_udf(ArrayType(RUN))
def labelled_runs(markup: pd.Series) -> pd.Series:
    def read(x: str | None) -> list[dict]:
        p = _Runs()
        p.feed(x or "")
        return p.runs

    return markup.map(read)
