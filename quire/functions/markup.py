"""Markup of sheets as string columns, and the widths of their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import ascii_fold

#: What a label reader looks for in the markup, and words that say only that a name is a company's.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
LABEL, VALUE = "invoice.field.label", "invoice.field"
COMPANY_WORDS = ("CONG", "TY", "CO", "PHAN", "TNHH", "MTV", "DOANH", "NGHIEP", "TAP", "DOAN", "CHI", "NHANH", "VA")
#: Characters that a column without a width gets at least.
LEAST = 8


def escaped(text: Column) -> Column:
    """HTML text; null is empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for raw, entity in ENTITIES:
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def _attr(name: str, value: Column, shown: Column) -> Column:
    return F.when(shown, F.concat(F.lit(f' {name}="'), value.cast("string"), F.lit('"'))).otherwise("")


def labelled(kind: Column, text: Column, css: str = "") -> Column:
    """A run that carries its kind; nothing for a blank text."""
    body = F.concat(F.lit('<span data-kind="'), escaped(kind), F.lit('"'), F.lit(f' class="{css}"' if css else ""), F.lit(">"), escaped(text), F.lit("</span>"))
    return F.when(F.coalesce(F.regexp_like(text.cast("string"), F.lit(r"\S")), F.lit(False)), body).otherwise("")


def table_cell(tag: str, row: Column, col: Column, inner: Column, kind: Column | None = None, colspan: Column | None = None, rowspan: Column | None = None, css: str = "") -> Column:
    """A table cell that says where it sits and how far it reaches; spans of one aren't written."""
    one = F.lit(1)
    colspan, rowspan = one if colspan is None else colspan, one if rowspan is None else rowspan
    return F.concat(
        F.lit(f'<{tag} data-cell="'), escaped(F.lit("") if kind is None else kind), F.lit('" data-row="'), row.cast("string"), F.lit('" data-col="'), col.cast("string"), F.lit('"'),
        _attr("colspan", colspan, colspan > 1), _attr("rowspan", rowspan, rowspan > 1), F.lit(f' class="{css}"' if css else ""), F.lit(">"), inner, F.lit(f"</{tag}>"),
    )


def field_line(label: Column, value: Column, dotted: bool = False) -> Column:
    """A label and its value on one line, each a run of its own."""
    return F.concat(F.lit(f'<div class="f{" dot" if dotted else ""}"><span class="k">'), labelled(F.lit(LABEL), label), F.lit('</span><span class="v">'), labelled(F.lit(VALUE), value), F.lit("</span></div>"))


def key_strip(pairs: Column, separator: str = "|") -> Column:
    """One line of keys from pairs (array of struct(label, value)); nothing for none."""
    gap = f' <span class="sep">{dict(ENTITIES).get(separator, separator)}</span> '
    one = F.transform(pairs, lambda p: F.concat(labelled(F.lit(LABEL), p["label"], "k"), F.lit(" "), labelled(F.lit(VALUE), p["value"], "v")))
    return F.when(F.size(pairs) > 0, F.concat(F.lit('<div class="strip">'), F.array_join(one, gap), F.lit("</div>"))).otherwise("")


def align_class(align: Column) -> Column:
    return F.when(align == "right", "r").when(align == "center", "c").otherwise("")


def initials(name: Column, fallback: str = "VN") -> Column:
    """Two capitals: of the last two words that don't only name the kind of company, else of the first."""
    spaced = F.translate(name, "-", " ")
    plain = F.split(F.upper(ascii_fold(spaced)), r"\s+")
    both = F.arrays_zip(F.split(spaced, r"\s+").alias("word"), plain.alias("plain"))
    own = F.transform(F.filter(both, lambda x: ~x["plain"].isin("", *COMPANY_WORDS)), lambda x: x["word"])
    chosen = F.when(F.size(own) >= 2, F.slice(own, F.size(own) - 1, 2)).when(F.size(own) == 1, own).otherwise(F.array(name))
    found = F.substring(F.upper(F.array_join(F.transform(chosen, lambda w: F.substring(w, 1, 1)), "")), 1, 2)
    return F.when(F.coalesce(found, F.lit("")) == "", fallback).otherwise(found)


def column_spans(columns: DataFrame, sheet: str, pos: str, width: str, ncols: int, gutter: int = 1, inset: int = 0) -> DataFrame:
    """columns with col0 and col1, in characters: a column of width 0 takes what the others leave. All but the
    last give a gutter up; none reaches beyond the inset page, at whose edge the last one ends."""
    every, by = Window.partitionBy(sheet), Window.partitionBy(sheet).orderBy(pos)
    end = ncols - inset
    w = F.when(F.col(width) == 0, F.greatest(F.lit(ncols - 2 * inset) - F.sum(width).over(every), F.lit(LEAST))).otherwise(F.col(width))
    until = F.sum("_w").over(by.rowsBetween(Window.unboundedPreceding, 0))
    last = F.lead(F.lit(1)).over(by).isNull()
    out = columns.withColumn("_w", w).withColumn("_until", until)
    col1 = F.when(last, F.lit(end)).otherwise(F.least(F.col("_until") + inset, F.lit(end)) - gutter)
    return out.withColumn("col0", F.least(F.col("_until") - F.col("_w") + inset, F.lit(end)).cast("int")).withColumn("col1", col1.cast("int")).drop("_w", "_until")


def column_percents(columns: DataFrame, sheet: str, pos: str, width: str, ncols: int) -> DataFrame:
    """columns with pct: widths as shares of the page, columns without one sharing the rest; the first of those
    takes what is missing to a hundred."""
    every = Window.partitionBy(sheet)
    free = F.col(width) == 0
    n = F.sum(free.cast("int")).over(every)
    spare = F.greatest(F.lit(ncols) - F.sum(width).over(every), n * LEAST)
    out = columns.withColumn("pct", F.when(free, 100.0 * spare / n / ncols).otherwise(100.0 * F.col(width) / ncols))
    first = F.min(F.when(free, F.col(pos))).over(every) == F.col(pos)
    return out.withColumn("pct", F.col("pct") + F.when(first, 100.0 - F.sum("pct").over(every)).otherwise(0.0))
