"""Pages as grids of cells: every section is a column of placed cells, and a page is its sections one below the other.

A document's page depends on nothing but the document, so all of this is column expressions over one nested
row: no shuffle, whatever the number of pages. A section is struct(cells, height); a cell (CELL) has its text,
role, row inside the section, first and last column, alignment, scale and weight. Lines that are drawn rather
than printed are marks (MARK). Chances come from a hash of the document's seed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import fitted, wrapped
from .sampling import uniform

CELL = "struct<text:string,role:string,row:int,col0:int,col1:int,align:string,scale:double,bold:boolean>"
MARK = "struct<kind:string,row0:double,col0:double,row1:double,col1:double,weight:double,tone:double>"
SECTION = f"struct<cells:array<{CELL}>,height:int>"
#: Signs that a printed rule may be made of.
RULES = ("-", "=", "*", ".", "~", "_")


def cell(text: Column, role: str | Column, row: Column | int, col0: Column | int, col1: Column | int, align: str = "left", scale: Column | float = 1.0, bold: Column | bool = False) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(text.alias("text"), lit(role).alias("role"), lit(row).cast("int").alias("row"), lit(col0).cast("int").alias("col0"), lit(col1).cast("int").alias("col1"), F.lit(align).alias("align"), lit(scale).cast("double").alias("scale"), lit(bold).alias("bold"))


def mark(kind: str, row0: Column | float, col0: Column | float, row1: Column | float, col1: Column | float, weight: float = 1.0, tone: float = 1.0) -> Column:
    """A drawn line, frame or fill; rounded, as marks are compared."""
    num = lambda x: F.round((x if isinstance(x, Column) else F.lit(x)).cast("double"), 3)
    return F.struct(F.lit(kind).alias("kind"), num(row0).alias("row0"), num(col0).alias("col0"), num(row1).alias("row1"), num(col1).alias("col1"), num(weight).alias("weight"), num(tone).alias("tone"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def none() -> Column:
    return F.array().cast(f"array<{CELL}>")


def section(cells: Column, height: Column | int) -> Column:
    """Blank cells are left out: they print nothing, but their row stays."""
    return F.struct(F.filter(cells, lambda c: F.trim(F.coalesce(c["text"], F.lit(""))) != "").alias("cells"), (height if isinstance(height, Column) else F.lit(height)).cast("int").alias("height"))


def stacked(lines: Column, role: str, col0: int, col1: int, align: str = "left", scale: Column | float = 1.0, bold: Column | bool = False) -> Column:
    """One row for each of lines."""
    return let(lines, lambda x: section(F.transform(x, lambda t, i: cell(t, role, i, col0, col1, align, scale, bold)), F.size(x)))


def below(sections: Sequence[Column] | Column) -> Column:
    """Sections one below the other, as one section."""
    listed = sections if isinstance(sections, Column) else F.array(*[s.cast(SECTION) for s in sections])
    down = lambda c, by: F.struct(c["text"].alias("text"), c["role"].alias("role"), (c["row"] + by).alias("row"), *[c[n].alias(n) for n in ("col0", "col1", "align", "scale", "bold")])
    start = F.struct(none().alias("cells"), F.lit(0).alias("height"))
    return F.aggregate(listed, start, lambda acc, s: F.struct(F.concat(acc["cells"], F.transform(s["cells"], lambda c: down(c, acc["height"]))).alias("cells"), (acc["height"] + s["height"]).alias("height")))


def beside(*sections: Column) -> Column:
    """Sections that begin in the same row; the highest makes the height."""
    start = F.struct(none().alias("cells"), F.lit(0).alias("height"))
    return F.aggregate(F.array(*[s.cast(SECTION) for s in sections]), start, lambda acc, s: F.struct(F.concat(acc["cells"], s["cells"]).alias("cells"), F.greatest(acc["height"], s["height"]).alias("height")))


def blank(rows: int = 1) -> Column:
    return section(none(), rows)


def when(condition: Column, s: Column) -> Column:
    return F.when(condition, s.cast(SECTION)).otherwise(section(none(), 0).cast(SECTION))


def between(u: Column, low: float, high: float) -> Column:
    return low + u * (high - low)


def rule(seed: Column, key: str, ncols: int, char: str | None = None) -> Column:
    """A centred line of one sign: mostly the page's width, sometimes 0.4 to 0.9 of it."""
    sign = F.lit(char[:1]) if char else F.element_at(F.array(*map(F.lit, RULES)), (F.floor(uniform(seed, F.lit(f"{key}:sign")) * len(RULES)) + 1).cast("int"))
    part = F.floor(ncols * between(uniform(seed, F.lit(f"{key}:part")), 0.4, 0.9)).cast("int")
    width = F.greatest(F.when(uniform(seed, F.lit(f"{key}:full")) < 0.8, F.lit(ncols)).otherwise(part), F.lit(4))
    return section(F.array(cell(F.repeat(sign, width), "sep", 0, 0, ncols, "center")), 1)


def full_rule(ncols: int, char: str = "-") -> Column:
    return section(F.array(cell(F.repeat(F.lit(char[:1] or "-"), F.lit(ncols)), "sep", 0, 0, ncols)), 1)


def junction_rule(positions: Sequence[int], ncols: int, char: str = "-", junction: str = "+") -> Column:
    """A line with a junction at each bar."""
    line = "".join(junction if i in set(positions) else char for i in range(ncols))
    return section(F.array(cell(F.lit(line), "sep", 0, 0, ncols)), 1)


def bars(s: Column, positions: Sequence[int], first: int = 0, last: Column | None = None) -> Column:
    """The section with | at positions, in each of its rows where no cell is in the way."""


    def barred(x: Column) -> Column:
        rows = F.sequence(F.lit(first), F.greatest((last if last is not None else x["height"]) - 1, F.lit(first)))

        def one(r: Column) -> Column:
            free = lambda own: F.filter(F.array(*map(F.lit, positions)), lambda p: ~F.exists(own, lambda c: (c["col0"] <= p) & (p < c["col1"])))
            return let(F.filter(x["cells"], lambda c: c["row"] == r), lambda own: F.transform(free(own), lambda p: cell(F.lit("|"), "sep", r, p, p + 1)))

        return F.struct(F.concat(x["cells"], F.when(x["height"] > first, F.flatten(F.transform(rows, one))).otherwise(none())).alias("cells"), x["height"].alias("height"))

    return let(s, barred)


def columns_of(spec: Sequence[dict[str, Any]], ncols: int, gutter: int = 1, inset: int = 0) -> list[dict[str, Any]]:
    """Columns with col0 and col1: fixed widths, one or more without width that take what is left, a gutter between."""
    rest = max(ncols - 2 * inset - sum(int(c.get("width") or 0) for c in spec), 8)
    out, at = [], inset
    for i, c in enumerate(spec):
        end = min(at + (int(c.get("width") or 0) or rest), ncols - inset)
        out.append({**c, "col0": at, "col1": ncols - inset if i == len(spec) - 1 else end - gutter})
        at = end
    return out


def bar_positions(columns: Sequence[dict[str, Any]], ncols: int) -> list[int]:
    """Where bars stand: the page's edges, and the middle of each gap between two columns."""
    gaps = [a["col1"] + max((b["col0"] - a["col1"]) // 2, 0) for a, b in zip(columns, columns[1:], strict=False)]
    return sorted({p for p in [0, ncols - 1, *gaps] if 0 <= p < ncols})


def reach(entry: dict[str, Any], columns: Sequence[dict[str, Any]], ncols: int) -> tuple[int, int, str]:
    """The columns an entry covers: a span of two, its own, or the whole page."""
    by = {c.get("key"): c for c in columns}
    first, last = (entry.get("span") or (entry.get("col"),) * 2)[:2]
    if first in by and last in by:
        return by[first]["col0"], by[last]["col1"], entry.get("align", "left" if "span" in entry else by[first].get("align", "left"))
    return 0, ncols, entry.get("align", "left")


# --- sections ---


def header(store: Column, title: Column, notes: Sequence[str], ncols: int, seed: Column, spec: dict[str, Any] | None = None) -> Column:
    """The shop's name, its lines, the title and notes, all centred; large print takes two rows."""
    spec = spec or {}
    size = between(uniform(seed, F.lit("header:name")), *spec.get("name_scale", (1.2, 1.6)))
    big = between(uniform(seed, F.lit("header:title")), *spec.get("title_scale", (1.1, 1.4)))
    parts = [section(F.array(cell(store["name"], "store.name", 0, 0, ncols, "center", size, bool(spec.get("name_bold", True)))), F.when(size > 1.25, 2).otherwise(1))]
    for key in ("branch", "address", "address2", "phone", "website"):
        if spec.get(key, True):
            parts.append(when(F.coalesce(store[key], F.lit("")) != "", section(F.array(cell(fitted(store[key], ncols), f"store.{key}", 0, 0, ncols, "center")), 1)))
    if spec.get("title", True):
        parts += [blank(), section(F.array(cell(title, "title", 0, 0, ncols, "center", big, True)), F.when(big > 1.25, 2).otherwise(1))]
    if notes:
        parts.append(stacked(F.array(*map(F.lit, notes)), "note", 0, ncols, "center"))
    return below(parts)


def meta(entries: Column, ncols: int, style: str = "pairs") -> Column:
    """Labels and values (array of struct(label, value)): a pair a row, two to a row where they fit, or all in a run of |."""
    if style == "pipes":
        return stacked(wrapped(F.array_join(F.transform(entries, lambda e: F.concat(e["label"], e["value"])), "|"), ncols), "meta", 0, ncols)
    if style == "two_column":
        return _two_column(entries, ncols)
    split = lambda e: F.greatest(ncols - F.length(e["value"]) - 1, F.lit(ncols // 3))
    row = lambda e, i: F.array(cell(F.substr(e["label"], F.lit(1), split(e)), "meta.label", i, 0, split(e)), cell(e["value"], "meta.value", i, split(e), ncols, "right"))
    return section(F.flatten(F.transform(entries, row)), F.size(entries))


def _two_column(entries: Column, ncols: int) -> Column:
    """A fold: an entry goes right of the one before it if that one is alone in its row and both fit."""
    text = lambda e: F.trim(F.concat_ws(" ", e["label"], e["value"]))

    def step(acc: Column, e: Column) -> Column:
        t = text(e)
        joins = (acc["left"] > 0) & (acc["left"] + F.length(t) + 2 <= ncols)
        row = F.when(joins, acc["row"]).otherwise(acc["row"] + 1)
        new = F.struct(t.alias("t"), row.alias("row"), joins.alias("right"), F.length(t).alias("n"))
        return F.struct(row.alias("row"), F.when(joins, 0).otherwise(F.length(t)).alias("left"), F.concat(acc["out"], F.array(new)).alias("out"))

    start = F.struct(F.lit(-1).alias("row"), F.lit(0).alias("left"), F.array().cast("array<struct<t:string,row:int,right:boolean,n:int>>").alias("out"))
    placed = F.aggregate(entries, start, step, lambda acc: acc["out"])

    def cells(p: Column) -> Column:
        beside_it = lambda x: F.coalesce(F.get(F.transform(F.filter(p, lambda y: (y["row"] == x["row"]) & y["right"]), lambda y: y["n"]), 0), F.lit(0))
        return F.transform(p, lambda x: cell(x["t"], "meta", x["row"], F.when(x["right"], ncols - x["n"]).otherwise(0), F.when(x["right"], F.lit(ncols)).otherwise(ncols - beside_it(x) - 1)))

    return let(placed, lambda p: F.struct(cells(p).alias("cells"), (F.coalesce(F.array_max(F.transform(p, lambda x: x["row"])), F.lit(-1)) + 1).alias("height"))).cast(SECTION)


def column_header(columns: Sequence[dict[str, Any]], bold: bool = False) -> Column:
    """Titles over their columns, wrapped; the highest makes the height."""
    titled = [stacked(wrapped(F.lit(str(c["title"])), c["col1"] - c["col0"]), "colhdr", c["col0"], c["col1"], c.get("title_align", c.get("align", "left")), bold=bold) for c in columns if c.get("title")]
    return beside(*titled) if titled else section(none(), 0)


def column_numbers(columns: Sequence[dict[str, Any]]) -> Column:
    return section(F.array(*[cell(F.lit(str(c.get("number", i + 1))[: c["col1"] - c["col0"]]), "colnum", 0, c["col0"], c["col1"], "center") for i, c in enumerate(columns)]), 1)


def items(entries: Column, values: dict[str, Any], template: Sequence[Sequence[dict[str, Any]]], columns: Sequence[dict[str, Any]], ncols: int, long: Sequence[str] = ("name", "note", "barcode_name")) -> Column:
    """Each entry in the template's rows. values: how an entry's field is printed, by name; fields in long wrap, others are cut.

    A template row without anything to print takes no row of the page; a wrapped field takes as many as it has lines.
    """

    def one(entry: Column) -> Column:
        rows = []
        for row in template:
            parts = []
            for e in row:
                source = e.get("from", e.get("col"))
                c0, c1, align = reach(e, columns, ncols)
                c0 += int(e.get("indent", 0))
                text = F.coalesce(values[source](entry), F.lit(""))
                width = max(c1 - c0, 4)
                lines = wrapped(text, width) if source in long else F.array(fitted(text, width))
                parts.append(when(text != "", stacked(lines, f"menu.{source}", c0, c1, align)))
            rows.append(beside(*parts))
        return below(rows)

    return below(F.transform(entries, one))


def totals(entries: Column, grand: Column, ncols: int, indent: int = 0, scale: Column | float = 1.0) -> Column:
    """A label left and an amount right in each row; the grand total is bold and larger, and may take two rows."""
    left = max(min(indent, ncols - 12), 0)
    size = scale if isinstance(scale, Column) else F.lit(float(scale))

    def one(e: Column, i: Column) -> Column:
        is_grand = i == grand
        role = F.when(is_grand, "total.grand").otherwise("total.line")
        split = F.greatest(ncols - F.length(e["value"]) - 1, F.lit(left + (ncols - left) // 3))
        own = F.when(is_grand, size).otherwise(1.0)
        cells = F.array(cell(F.substr(e["label"], F.lit(1), split - left), F.concat(role, F.lit(".label")), 0, left, split, "left", own, is_grand), cell(e["value"], role, 0, split, ncols, "right", own, is_grand))
        return section(cells, F.when(is_grand & (own > 1.3), 2).otherwise(1))

    return below(F.transform(entries, one))


def framed_totals(entries: Column, grand: Column, ncols: int, split: int) -> Column:
    """Totals in a box: a rule below each, bars at the edges and before the amounts."""
    positions = [0, split - 1, ncols - 1]

    def one(e: Column, i: Column) -> Column:
        is_grand = i == grand
        role = F.when(is_grand, "total.grand").otherwise("total.line")
        cells = F.array(cell(fitted(e["label"], split - 3), F.concat(role, F.lit(".label")), 0, 2, split - 1, bold=is_grand), cell(fitted(e["value"], ncols - split - 3), role, 0, split, ncols - 2, "right", bold=is_grand))
        return below([section(cells, 1), junction_rule(positions, ncols)])

    return bars(below(F.transform(entries, one)), positions)


def footer(lines: Column, ncols: int) -> Column:
    """An empty row and the lines, wrapped and centred; without lines nothing."""
    every = F.flatten(F.transform(lines, lambda x: wrapped(x, ncols)))
    return when(F.size(lines) > 0, below([blank(), stacked(every, "footer", 0, ncols, "center")]))


def leader(text: Column, width: Column, char: str = "") -> Column:
    """The text, and a run of char up to width where there is one."""
    cut = F.substr(text, F.lit(1), width)
    pad = width - F.length(cut) - F.when(F.length(cut) > 0, 1).otherwise(0)
    return cut if not char else F.when(pad > 0, F.concat(cut, F.when(F.length(cut) > 0, " ").otherwise(""), F.repeat(F.lit(char), pad))).otherwise(cut)


def field(label: Column, value: Column, col0: int, col1: int, role: str, char: str = "") -> Column:
    """A label and its value in one row, cut to the columns they have."""
    shown = fitted(F.coalesce(label, F.lit("")), max(col1 - col0 - 4, 1))
    start = col0 + F.length(shown) + F.when(F.length(shown) > 0, 1).otherwise(0)
    text = leader(F.coalesce(value, F.lit("")), F.greatest(col1 - start, F.lit(1)), char)
    return section(F.array(cell(shown, f"{role}.label", 0, col0, start - 1), cell(text, role, 0, start, col1)), 1)


def letterhead(store: Column, invoice: Column, labels: dict[str, str], ncols: int, seed: Column, serial_width: int = 26, framed: bool = False) -> Column:
    """The seller at the left, the invoice's form, series and number at the right, perhaps in a frame; an empty row below."""
    split, left = max(ncols - serial_width, ncols // 2), 2 if framed else 0
    size = between(uniform(seed, F.lit("letterhead")), 1.05, 1.25)
    seller = [stacked(wrapped(store["name"], split - 1 - left), "store.name", left, split - 1, scale=size, bold=True)]
    for key in ("address", "tax_code", "branch", "phone", "account", "website"):
        seller.append(when(F.coalesce(store[key], F.lit("")) != "", field(F.lit(labels.get(key, "")), store[key], left, split - 1, f"store.{key}")))
    papers = [when(F.coalesce(invoice[key], F.lit("")) != "", field(F.lit(labels.get(key, "")), invoice[key], split, ncols - left, f"invoice.{key}")) for key in ("form_no", "serial", "number")]
    body = beside(below(seller), below(papers))
    if framed:
        line = junction_rule([0, ncols - 1], ncols)
        body = below([line, bars(body, [0, ncols - 1]), line])
    return below([body, blank()])


def doctitle(title: Column, subtitle: Column, period: Column, ncols: int, seed: Column) -> Column:
    size = between(uniform(seed, F.lit("doctitle")), 1.25, 1.5)
    there = lambda x: F.coalesce(x, F.lit("")) != ""
    return below([
        stacked(wrapped(title, ncols), "title", 0, ncols, "center", size, True),
        when(there(subtitle), stacked(wrapped(subtitle, ncols), "subtitle", 0, ncols, "center")),
        when(there(period), section(F.array(cell(fitted(period, ncols), "period", 0, 0, ncols, "center", bold=True)), 1)),
        blank(),
    ])


def parties(left: Column, right: Column, ncols: int, split: float = 0.55, gap: int = 2, char: str = "", one_column: bool = False) -> Column:
    """Two lists of fields (array of struct(label, value)) beside each other, or one below the other; an empty row below."""
    at = ncols if one_column else int(ncols * split)
    a = below(F.transform(left, lambda e: field(e["label"], e["value"], 0, ncols if one_column else at - gap, "invoice.field", char)))
    b = below(F.transform(right, lambda e: field(e["label"], e["value"], 0 if one_column else at, ncols, "invoice.field", char)))
    return below([a, b, blank()] if one_column else [beside(a, b), blank()])


def strip(entries: Column, ncols: int, sign: str = "|") -> Column:
    """Fields in a run with a sign between; what doesn't fit begins the next row. A fold over the entries; a rule below."""

    def step(acc: Column, e: Column) -> Column:
        label, value = fitted(F.coalesce(e["label"], F.lit("")), ncols), fitted(e["value"], ncols)
        lead = F.when(F.length(label) > 0, F.length(label) + 1).otherwise(0)
        width = lead + F.length(value)
        breaks = (acc["at"] > 0) & (acc["at"] + len(sign) + 2 + width > ncols)
        begins = breaks | (acc["at"] == 0)
        row = acc["row"] + breaks.cast("int")
        at = F.when(begins, 0).otherwise(acc["at"] + len(sign) + 2)
        new = F.array(cell(F.when(begins, "").otherwise(sign), "sep", row, acc["at"] + 1, acc["at"] + 1 + len(sign)), cell(label, "invoice.field.label", row, at, at + F.length(label)), cell(value, "invoice.field", row, at + lead, at + width))
        return F.struct(F.concat(acc["cells"], new).alias("cells"), row.cast("int").alias("row"), (at + width).cast("int").alias("at"))

    folded = F.aggregate(entries, F.struct(none().alias("cells"), F.lit(0).alias("row"), F.lit(0).alias("at")), step)
    body = let(folded, lambda x: section(x["cells"], x["row"] + F.when(x["at"] > 0, 1).otherwise(0)))
    return when(F.size(entries) > 0, below([body, full_rule(ncols)]))


def table(entries: Column, values: dict[str, Any], template: Sequence[Sequence[dict[str, Any]]], columns: Sequence[dict[str, Any]], ncols: int, numbers: bool = False, row_rules: bool = False, blank_rows: int = 0) -> Column:
    """The items in a frame: rules above and below the titles, bars between columns, and a rule below, or after each item."""
    positions = bar_positions(columns, ncols)
    line = junction_rule(positions, ncols)
    head = [column_header(columns)] + ([column_numbers(columns)] if numbers else [])
    body = below(F.transform(entries, lambda e: below([items(F.array(e), values, template, columns, ncols), line]))) if row_rules else items(entries, values, template, columns, ncols)
    empty = [x for _ in range(blank_rows) for x in ([blank(), line] if row_rules else [blank()])]
    return below([line, bars(below(head), positions), line, bars(below([body, *empty]), positions), *([] if row_rules else [line])])


def words(label: str, text: Column, ncols: int, framed: bool = False) -> Column:
    inset = 2 if framed else 0
    body = stacked(wrapped(F.trim(F.concat_ws(" ", F.lit(label), text)), ncols - 2 * inset - 1), "invoice.words", inset, ncols - inset)
    edges = [0, ncols - 1]
    return when(F.coalesce(text, F.lit("")) != "", below([*([bars(body, edges), junction_rule(edges, ncols)] if framed else [body]), blank()]))


def notes(lines: Column, ncols: int) -> Column:
    every = F.flatten(F.transform(lines, lambda x: wrapped(x, ncols)))
    return when(F.size(lines) > 0, below([stacked(every, "invoice.note", 0, ncols), blank()]))


def signatures(entries: Column, ncols: int, room: int = 3) -> Column:
    """Titles (array of struct(title, hint, name)) side by side in equal parts, room to sign, and the names below."""
    n = F.greatest(F.size(entries), F.lit(1))
    edge = lambda i: F.floor(i * ncols / n).cast("int")
    at = lambda row, key, role, bold=False: F.transform(entries, lambda e, i: cell(F.substr(F.coalesce(e[key], F.lit("")), F.lit(1), edge(i + 1) - edge(i)), role, row, edge(i), edge(i + 1), "center", bold=bold))
    cells = F.concat(at(0, "title", "sign.title", True), at(1, "hint", "sign.hint"), at(2 + room, "name", "sign.name"))
    return when(F.size(entries) > 0, section(cells, 3 + room))


def grid(sections: Sequence[Column], layout: Column, ncols: int) -> Column:
    """struct(layout, ncols, nrows, cells) of a page."""
    return let(below(sections), lambda s: F.struct(layout.alias("layout"), F.lit(ncols).alias("ncols"), s["height"].alias("nrows"), s["cells"].alias("cells")))


def frame_marks(s: Column, ncols: int, top: Column, shade: float = 0.0, border: float = 1.8) -> Column:
    """What a drawn page has around a section that begins in row top: a frame, and a fill where it is shaded."""
    bottom = top + s["height"]
    parts = [F.when(F.lit(border > 1.0), mark("frame", top, 0, bottom, ncols - 1, weight=border)), F.when(F.lit(shade > 0) & (s["height"] > 0), mark("fill", top, 0, bottom, ncols - 1, tone=shade))]
    return F.filter(F.array(*parts), lambda m: m.isNotNull())


def printed(page: Column) -> Column:
    """A page's grid as text lines: each cell's text in its columns, left, right or centred; later cells win."""

    def lines(g: Column) -> Column:
        def put(line: Column, c: Column) -> Column:
            text = F.substr(c["text"], F.lit(1), F.greatest(g["ncols"] - c["col0"], F.lit(0)))
            room = F.greatest(c["col1"] - c["col0"] - F.length(text), F.lit(0))
            at = c["col0"] + F.when(c["align"] == "right", room).when(c["align"] == "center", F.floor(room / 2)).otherwise(0).cast("int")
            return F.concat(F.substr(line, F.lit(1), at), text, F.substr(line, at + F.length(text) + 1, g["ncols"]))

        row = lambda r: F.rtrim(F.aggregate(F.filter(g["cells"], lambda c: c["row"] == r), F.repeat(F.lit(" "), g["ncols"]), put))
        return F.when(g["nrows"] > 0, F.transform(F.sequence(F.lit(0), g["nrows"] - 1), row)).otherwise(F.array().cast("array<string>"))

    return let(page, lines)


def overflow(page: Column) -> Column:
    """Cells whose text is longer than the columns they have, or that reach beyond the page."""
    return let(page, lambda g: F.filter(g["cells"], lambda c: (F.length(c["text"]) > c["col1"] - c["col0"]) & (c["scale"] <= 1.0) | (c["col1"] > g["ncols"]) | (c["col0"] < 0) | (c["row"] >= g["nrows"])))
