"""Sheets as markup: a bill's table, totals, signatures and footer as string columns, and made-up tables with spans.

Every run of text carries its kind and every cell its place, so the labels can be read back from the markup
(``tables.cells_of``, ``tables.labelled_runs``). Like the layout, a sheet is an expression over one nested row.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.markup import escaped, field_line, labelled, table_cell
from .layout import let
from .sampling import uniform

_CLASS = {"right": "r", "center": "c"}
HEADER_ROWS = 2


def _join(parts: Column) -> Column:
    return F.array_join(parts, "")


def header_row(columns: Sequence[dict[str, Any]], row: int = 0) -> Column:
    """The titles, one cell a column."""
    cells = [table_cell("th", F.lit(row), F.lit(i), labelled(F.lit("colhdr"), F.lit(c.get("title", ""))), F.lit("colhdr"), css=_CLASS.get(c.get("title_align", c.get("align", "left")), "")) for i, c in enumerate(columns)]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def number_row(columns: Sequence[dict[str, Any]], row: Column) -> Column:
    cells = [table_cell("td", row, F.lit(i), labelled(F.lit("colnum"), F.lit(str(c.get("number", i + 1)))), F.lit("colnum"), css="c") for i, c in enumerate(columns)]
    return F.concat(F.lit('<tr class="colnum">'), *cells, F.lit("</tr>"))


def item_row(entry: Column, row: Column, columns: Sequence[dict[str, Any]], values: dict[str, Any]) -> Column:
    """An entry's fields, one cell a column; values: how a field is printed, by the column's key."""
    cells = [table_cell("td", row, F.lit(i), labelled(F.lit(f"menu.{c['key']}"), values[c["key"]](entry)), F.lit(f"menu.{c['key']}"), css=_CLASS.get(c.get("align", "left"), "")) for i, c in enumerate(columns)]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def wide_row(kind: str, text: Column, row: Column, width: int, css: str = "extra") -> Column:
    """One cell over all columns: a group's heading, a note."""
    return F.concat(F.lit(f'<tr class="{css}">'), table_cell("td", row, F.lit(0), labelled(F.lit(kind), text), F.lit(kind), F.lit(width)), F.lit("</tr>"))


def blank_rows(n: int, first: Column, width: int) -> Column:
    rows = [F.concat(F.lit('<tr class="blank">'), *[table_cell("td", first + k, F.lit(i), F.lit("")) for i in range(width)], F.lit("</tr>")) for k in range(n)]
    return F.concat(*rows) if rows else F.lit("")


def total_rows(totals: Column, grand: Column, first: Column, width: int) -> Column:
    """Totals inside the table: a label over all columns but the last, the amount in the last."""

    def one(e: Column, i: Column) -> Column:
        kind = F.when(i == grand, "total.grand").otherwise("total.line")
        label = F.concat(kind, F.lit(".label"))
        cells = [table_cell("td", first + i, F.lit(0), labelled(label, e["label"]), label, F.lit(width - 1), css="tlabel"), table_cell("td", first + i, F.lit(width - 1), labelled(kind, e["value"]), kind, css="r")]
        return F.concat(F.when(i == grand, '<tr class="grand">').otherwise('<tr class="total">'), *cells, F.lit("</tr>"))

    return _join(F.transform(totals, one))


def items_table(entries: Column, columns: Sequence[dict[str, Any]], values: dict[str, Any], group: Any = None, numbers: bool = False, blanks: int = 0, totals: Column | None = None, grand: Column | None = None) -> Column:
    """The whole table. group: of an entry, its heading, or null where it is an item like any other."""
    width, head = len(columns), header_row(columns)
    at = 1 + int(numbers)
    head = F.concat(head, number_row(columns, F.lit(1))) if numbers else head

    def line(e: Column, i: Column) -> Column:
        plain = item_row(e, i + at, columns, values)
        return plain if group is None else F.when(group(e).isNotNull(), wide_row("menu.group", group(e), i + at, width, "group")).otherwise(plain)

    after = F.size(entries) + at
    body = [_join(F.transform(entries, line)), blank_rows(blanks, after, width)]
    if totals is not None:
        body.append(total_rows(totals, grand if grand is not None else F.lit(-1), after + blanks, width))
    return F.concat(F.lit('<table class="items"><thead>'), head, F.lit("</thead><tbody>"), *body, F.lit("</tbody></table>"))


def totals_block(totals: Column, grand: Column) -> Column:
    """Totals below the table, a label and an amount each."""
    one = lambda e, i: let(F.when(i == grand, "total.grand").otherwise("total.line"), lambda k: F.concat(F.lit('<div class="'), F.when(i == grand, "t grand").otherwise("t"), F.lit('">'), labelled(F.concat(k, F.lit(".label")), e["label"], "k"), labelled(k, e["value"], "v"), F.lit("</div>")))
    return F.concat(F.lit('<div class="totals">'), _join(F.transform(totals, one)), F.lit("</div>"))


def party(title: Column, fields: Column) -> Column:
    body = _join(F.transform(fields, lambda e: F.when(F.coalesce(e["value"], F.lit("")) != "", field_line(e["label"], e["value"])).otherwise("")))
    return F.concat(F.lit('<div class="party">'), labelled(F.lit("parties.title"), title), body, F.lit("</div>"))


def signature_block(entries: Column) -> Column:
    """Titles, hints and names (array of struct(title, hint, name)) side by side; nothing without any."""
    one = lambda e: F.concat(F.lit('<div class="sign">'), labelled(F.lit("sign.title"), e["title"]), labelled(F.lit("sign.hint"), e["hint"]), labelled(F.lit("sign.name"), e["name"]), F.lit("</div>"))
    return F.when(F.size(entries) > 0, F.concat(F.lit('<div class="signs">'), _join(F.transform(entries, one)), F.lit("</div>"))).otherwise("")


def words_block(label: str, text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit('<div class="words">'), labelled(F.lit("invoice.words"), F.concat_ws(" ", F.lit(label), text)), F.lit("</div>"))).otherwise("")


def footer_block(lines: Column) -> Column:
    return F.when(F.size(lines) > 0, F.concat(F.lit('<div class="footer">'), _join(F.transform(lines, lambda x: F.concat(F.lit("<div>"), labelled(F.lit("footer"), x), F.lit("</div>")))), F.lit("</div>"))).otherwise("")


def document(body: Sequence[Column], css: str = "", title: Column | None = None) -> Column:
    """A page of its own; the title is text, the style sheet is written as it is."""
    head = F.concat(F.lit('<!doctype html><html><head><meta charset="utf-8"><title>'), escaped(title if title is not None else F.lit("")), F.lit(f"</title><style>{css}</style></head><body>"))
    return F.concat(head, *body, F.lit("</body></html>"))


# --- made-up tables ---


def span_starts(seed: Column, key: str, extent: int, most: int, longest: int) -> Column:
    """array of struct(start, length): at most ``most`` spans of 2 to ``longest`` places, in order and apart from each other.

    A fold over the places: a place that no span covers begins one with the chance that makes ``most`` of them.
    """
    chance = min(1.0, most / max(1, extent))

    def step(acc: Column, i: Column) -> Column:
        u = lambda what: uniform(seed, F.concat(F.lit(f"{key}:{what}:"), i.cast("string")))
        room = F.least(F.lit(longest), F.lit(extent) - i)
        length = (F.floor(u("length") * (room - 1)) + 2).cast("int")
        begins = (i >= acc["after"]) & (room >= 2) & (F.size(acc["out"]) < most) & (u("begin") < chance)
        return F.struct(F.when(begins, F.concat(acc["out"], F.array(F.struct(i.alias("start"), length.alias("length"))))).otherwise(acc["out"]).alias("out"), F.when(begins, i + length).otherwise(acc["after"]).alias("after"))

    start = F.struct(F.array().cast("array<struct<start:int,length:int>>").alias("out"), F.lit(0).alias("after"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(extent - 1)), start, step, lambda acc: acc["out"])


def is_header(row: Column, col: Column, header_cols: int = 1) -> Column:
    return (row < HEADER_ROWS) | (col < header_cols)


def made_tables(seeds: DataFrame, rows: int, cols: int, most: int = 2, longest: int = 3) -> DataFrame:
    """(seed, row, col, rowspan, colspan, header, text): the cells of one table a seed.

    The first row has spans over columns, and what none of them covers reaches over both rows of the header; the
    first column has spans over rows below it. Covered places have no cell. About log2(rows * cols) body cells are empty.
    """
    seed = F.col("seed")
    base = seeds.select("seed", span_starts(seed, "col", cols, most, longest).alias("across"), span_starts(seed, "row", max(rows - HEADER_ROWS, 1), most, longest).alias("down"))
    grid = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("col"))
    at = lambda spans, place: F.get(F.filter(spans, lambda s: (s["start"] <= place) & (place < s["start"] + s["length"])), 0)
    grid = grid.withColumn("a", at(F.col("across"), F.col("col"))).withColumn("d", at(F.col("down"), F.col("row") - HEADER_ROWS))
    any_across = F.size("across") > 0
    hidden = ((F.col("row") == 0) & F.col("a").isNotNull() & (F.col("a.start") < F.col("col"))) | ((F.col("row") == 1) & any_across & F.col("a").isNull()) | ((F.col("row") >= HEADER_ROWS) & (F.col("col") == 0) & F.col("d").isNotNull() & (F.col("d.start") < F.col("row") - HEADER_ROWS))
    colspan = F.when((F.col("row") == 0) & F.col("a").isNotNull(), F.col("a.length")).otherwise(1)
    rowspan = F.when((F.col("row") == 0) & any_across & F.col("a").isNull(), 2).when((F.col("row") >= HEADER_ROWS) & (F.col("col") == 0) & F.col("d").isNotNull(), F.col("d.length")).otherwise(1)
    place = F.concat_ws(",", F.col("row").cast("string"), F.col("col").cast("string"))
    empty = ~is_header(F.col("row"), F.col("col")) & (uniform(seed, F.concat(F.lit("empty:"), place)) < (rows * cols).bit_length() / (rows * cols))
    number = F.format_number(F.floor(uniform(seed, F.concat(F.lit("value:"), place)) * 100000), 0)
    text = F.when(empty, "").when(is_header(F.col("row"), F.col("col")), F.concat(F.lit("h"), place)).otherwise(number)
    return grid.where(~hidden).select("seed", "row", "col", rowspan.cast("int").alias("rowspan"), colspan.cast("int").alias("colspan"), is_header(F.col("row"), F.col("col")).alias("header"), text.alias("text"))


def table_pages(cells: DataFrame, boxed: bool = True) -> DataFrame:
    """(seed, markup) of made_tables(): rows in order, cells by column. boxed: the cell is what is marked, else its text.

    A table's cells are gathered in one row: tables are small.
    """
    place = F.concat(F.lit(' data-row="'), F.col("row").cast("string"), F.lit('" data-col="'), F.col("col").cast("string"), F.lit('"'))
    spans = F.concat(F.when(F.col("rowspan") > 1, F.format_string(' rowspan="%d"', "rowspan")).otherwise(""), F.when(F.col("colspan") > 1, F.format_string(' colspan="%d"', "colspan")).otherwise(""))
    tag = F.when(F.col("header"), "th").otherwise("td")
    inner = escaped(F.col("text")) if boxed else F.concat(F.lit('<span data-cell="text"'), place, F.lit(">"), escaped(F.col("text")), F.lit("</span>"))
    one = F.concat(F.lit("<"), tag, F.lit(' data-cell="cell"' if boxed else ""), place, spans, F.lit(">"), inner, F.lit("</"), tag, F.lit(">"))
    rows = cells.groupBy("seed", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", one.alias("m")))), lambda c: c["m"]), "").alias("m"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "m"))), lambda r: F.concat(F.lit("<tr>"), r["m"], F.lit("</tr>"))), "")
    return rows.groupBy("seed").agg(F.concat(F.lit("<table>"), body, F.lit("</table>")).alias("markup"))


def structure_record(file_name: Column, tokens: Column, cells: Column, markup: Column) -> Column:
    """A table's record as JSON: its name, structure tokens, and cells (array of struct(tokens, bbox))."""
    return F.to_json(F.struct(file_name.alias("file_name"), F.lit("table_structure").alias("task"), markup.alias("ground_truth"), tokens.alias("structure_tokens"), cells.alias("cells"), F.size(cells).alias("n_cells")))


def quad(x: Column, y: Column, w: Column, h: Column, ratio: float = 1.0) -> Column:
    """The four corners of a rectangle, scaled and rounded to a tenth."""
    at = lambda v: F.round(v * ratio, 1)
    return F.array(F.array(at(x), at(y)), F.array(at(x + w), at(y)), F.array(at(x + w), at(y + h)), F.array(at(x), at(y + h)))
