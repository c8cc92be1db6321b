"""Scalar text, money and date functions as columns; they stay in the JVM unless the docstring says otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Word characters and the marks that stay inside a token. Java's \\w is ASCII only, so the classes are written out.
TOKEN_BREAK = r"[^\p{L}\p{N}_.,\-]+"
#: Combining marks, the precomposed Vietnamese block, and single accented letters that count as diacritics.
DIACRITIC = "[̀-ͯẠ-ỹăâđêôơưĂÂĐÊÔƠƯáàãéèíìóòõúùýÁÀÃÉÈÍÌÓÒÕÚÙÝ]"


@F.pandas_udf(StringType())
def ascii_fold(text: pd.Series) -> pd.Series:
    """Letters without their marks; đ becomes d. Python, as the JVM functions have no decomposition."""

    def fold(x: str | None) -> str | None:
        if x is None or x.isascii():
            return x
        plain = unicodedata.normalize("NFD", x.replace("đ", "d").replace("Đ", "D"))
        return unicodedata.normalize("NFC", "".join(c for c in plain if unicodedata.category(c) != "Mn"))

    return text.map(fold)


def tokens(text: Column) -> Column:
    """Lower-case tokens; those without a letter or digit are dropped."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t.rlike(r"[\p{L}\p{N}_]"))


def has_diacritics(text: Column) -> Column:
    return F.coalesce(text.rlike(DIACRITIC), F.lit(False))


def trimmed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def sentences(text: Column) -> Column:
    """Cut after spaced sentence punctuation."""
    return F.split(F.regexp_replace(text, r"( /?[.!?])+ ", "$0\n"), "\n")


def without_non_ascii(text: Column, replacement: str = "_") -> Column:
    plain = F.regexp_replace(text, r"[^\x00-\x7F]", "")
    return F.when(F.length(plain) > 0, plain).otherwise(F.lit(replacement))


def refusal(text: Column, alphabet: str = r"^[\p{L} .,'-]*$") -> Column:
    """The first reason why a text can't be written by hand, or null."""
    return (
        F.when(F.trim(text) == "", "empty")
        .when(text.rlike("[0-9]"), "digit")
        .when(text.rlike(r"(^|[^\p{L}])\p{Lu}{2,}([^\p{L}]|$)"), "allcaps")
        .when(~text.rlike(alphabet), "alphabet")
    )


def grouped(value: Column, decimals: int, thousands: str, point: str) -> Column:
    """Half-even rounding, digits in groups of three."""
    return F.translate(F.format_number(value, decimals), ",.", thousands + point)


def money(value: Column, style: str = "dot", prefix: str = "", suffix: str = "") -> Column:
    """Styles: dot (1.234), comma (1,234), comma_2dp (1,234.00) and cents (minor units, 12.34)."""
    size = F.abs(value)
    body = {
        "dot": lambda: grouped(size, 0, ".", ","),
        "comma": lambda: grouped(size, 0, ",", "."),
        "comma_2dp": lambda: grouped(size, 2, ",", "."),
        "cents": lambda: grouped(size / 100, 2, ",", "."),
    }[style]()
    return F.concat(F.when(value < 0, "-").otherwise(""), F.lit(prefix), body, F.lit(suffix))


def quantity(value: Column, style: str = "dot", decimals: int = 0) -> Column:
    """Whole numbers as money. With decimals the whole part as money, then the style's other sign and the decimals.

    cents is a style of money alone: a quantity of 2 is 2, so it borrows comma's signs. A number between -1 and 0
    loses its sign with decimals, as its whole part is 0.
    """
    style = "comma" if style == "cents" else style
    if decimals == 0:
        return money(F.bround(value, 0), style)
    plain = F.translate(F.format_number(value, decimals), ",", "")
    whole = money(F.substring_index(plain, ".", 1).cast("bigint"), style)
    return F.concat(whole, F.lit("," if style == "dot" else "."), F.substring_index(plain, ".", -1))


def amount(text: Column, style: str = "dot") -> Column:
    """A printed amount as a number: the inverse of money()."""
    digits = F.regexp_replace(text, "[^0-9.,]", "")
    plain = F.translate(F.translate(digits, ".", ""), ",", ".") if style == "dot" else F.translate(digits, ",", "")
    return F.when(text.startswith("-"), -1).otherwise(1) * plain.try_cast("double")


def round_to(value: Column, step: float) -> Column:
    return F.bround(value / step, 0) * step


def ean13_check(twelve: Column) -> Column:
    """The check digit of twelve digits: weights 1 and 3 in turn, complement to ten."""
    total = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(0), lambda acc, i: acc + F.substr(twelve, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 3).otherwise(1))
    return (10 - total % 10) % 10


def elapsed(seconds: Column) -> Column:
    return F.when(seconds < 60, F.format_string("%.0fs", seconds)).when(seconds < 3600, F.format_string("%.0fm", seconds / 60)).otherwise(F.format_string("%.1fh", seconds / 3600))


def hex_colour(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02x%02x%02x", r, g, b)


def faded(channel: Column, share: Column) -> Column:
    """A colour channel moved towards white by share."""
    return F.bround(channel + (255 - channel) * share, 0).cast("int")


def filled(template: Column, values: Column) -> Column:
    """{key} replaced by the map's value of that key; unknown keys stay."""
    return F.aggregate(F.map_entries(values), template, lambda acc, e: F.replace(acc, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))


#: White space of any script, and the four ASCII separators.
_SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"


def wrapped(text: Column, width: int) -> Column:
    """Lines of at most width characters that keep the blanks between words, and those before the first.

    A run of blanks that doesn't fit ends its line; a word that doesn't fit begins one, and is cut if it is longer
    than a line. Blanks at a line's end go. Without any line there is one empty line; a width below 1 cuts nothing.
    """
    if width < 1:
        return F.array(text)
    space, word = _SPACE, r"[^\p{IsWhite_Space}\x1c-\x1f]"
    fits, over = rf"(?:.{{0,{width - 1}}}{word})(?={space}|\z)", rf"{space}{{{width + 1}}}"
    # A line: the most whole words that fit, or the beginning of a longer one. Blanks before the first word go if it
    # doesn't fit behind them; those that overfill a line leave an empty one.
    line = rf"(?s)(?:\A(?!{fits}|{over}){space}++)?(\A(?={over})|{fits}|{word}{{{width}}}){space}*+"
    return F.when(F.length(text) <= width, F.array(F.regexp_replace(text, space + "+$", ""))).otherwise(F.regexp_extract_all(text, F.lit(line), F.lit(1)))


def fitted(text: Column, width: int) -> Column:
    """The first width characters."""
    return F.substring(text, 1, width)


def cased(text: Column, upper: bool, fold: bool) -> Column:
    """The text without marks and in capitals, as asked."""
    text = ascii_fold(text) if fold else text
    return F.upper(text) if upper else text


#: The language's digits and the names of the thousands.
DIGITS = ("không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín")
SCALES = ("", "nghìn", "triệu", "tỷ", "nghìn tỷ")


def words_vi(number: Column, unit: str = "đồng") -> Column:
    """An amount in Vietnamese words: rounded half-even, with a capital, the unit, and Âm before negative ones.

    A group after a larger one keeps its zeros (không trăm lẻ năm). Of more than 15 digits the digits are printed.
    """
    size = F.bround(F.abs(number), 0).cast("decimal(38,0)")
    digit = F.array(*map(F.lit, DIGITS))
    name = lambda d: F.get(digit, d.cast("int"))

    def group(value: Column, lead: Column) -> Column:
        hundreds, tens, ones = F.floor(value / 100), F.floor(value / 10) % 10, value % 10
        first = F.when(lead | (hundreds > 0), F.concat(name(hundreds), F.lit(" trăm")))
        second = F.when(tens == 0, F.when((ones > 0) & (lead | (hundreds > 0)), "lẻ")).when(tens == 1, "mười").otherwise(F.concat(name(tens), F.lit(" mươi")))
        third = F.when(ones == 0, None).when((ones == 1) & (tens > 1), "mốt").when((ones == 4) & (tens > 1), "tư").when((ones == 5) & (tens > 0), "lăm").otherwise(name(ones))
        return F.concat_ws(" ", first, second, third)

    digits = F.lpad(size.cast("string"), 15, "0")
    parts = []
    for i in reversed(range(5)):
        value = F.substr(digits, F.lit(13 - 3 * i), F.lit(3)).cast("int")
        parts.append(F.when(value > 0, F.concat_ws(" ", group(value, size >= F.lit(1000 ** (i + 1))), F.nullif(F.lit(SCALES[i]), F.lit("")))))
    spoken = F.when(size == 0, DIGITS[0]).when(size >= F.lit(10**15), grouped(size, 0, ".", ",")).otherwise(F.concat_ws(" ", *parts))
    said = F.concat(F.upper(F.substring(spoken, 1, 1)), F.substr(spoken, F.lit(2)))
    return F.trim(F.concat(F.when(number < 0, "Âm ").otherwise(""), said, F.lit(f" {unit}")))


#: Sentence and word marks that stand alone, or join what is before or after them.
SEPARATORS = r"^/?[.!?]+$"


def is_separator(token: Column) -> Column:
    return F.coalesce(token.rlike(SEPARATORS), F.lit(False))


def is_blank(text: Column) -> Column:
    """Nothing but white space, and not empty."""
    return F.coalesce(text.rlike(f"^{_SPACE}+$"), F.lit(False))


def joined(tokens: Column) -> Column:
    """Tokens as a text, one blank between them; those that are empty or blank are left out."""
    return F.array_join(F.filter(tokens, lambda t: F.trim(t) != ""), " ")


def squeezed(text: Column) -> Column:
    """The text without any white space."""
    return F.regexp_replace(text, _SPACE + "+", "")


def split_like(text: Column, sizes: Column) -> Column:
    """The text without white space, cut into pieces of those sizes; what is left over goes to the last one."""
    bare = squeezed(text)
    ends = F.transform(sizes, lambda n, i: F.aggregate(F.slice(sizes, 1, i + 1), F.lit(0), lambda acc, x: acc + x.cast("int")))
    last = F.size(sizes) - 1
    return F.transform(sizes, lambda n, i: F.substr(bare, F.get(ends, i) - n.cast("int") + 1, F.when(i == last, F.length(bare) + 1).otherwise(n.cast("int"))))


def missing_characters(text: Column, alphabet: Column) -> Column:
    """Characters of the text, sorted, that the alphabet lacks; white space is never missing."""
    return F.array_sort(F.array_distinct(F.array_except(F.split(squeezed(text), ""), F.concat(F.split(alphabet, ""), F.array(F.lit(""))))))


def check_digits(code: Column, weights: tuple[int, ...], modulus: int = 11) -> Column:
    """The weighted digit sum of a code, complemented to the modulus: tax codes, accounts and the like."""
    total = sum((F.substr(code, F.lit(i + 1), F.lit(1)).cast("int") * w for i, w in enumerate(weights)), F.lit(0))
    return (modulus - total % modulus) % modulus
