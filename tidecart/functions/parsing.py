"""Parsers for messy text cells: numbers, money, flags, discounts, null markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers that mean "missing".
CSV_NULL_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
TEXT_NULL_MARKERS = ["NA", "na", "N/A", "", "NULL", "null"]
TRUE_MARKERS = ["true", "True", "TRUE", "t", "T", "1"]
MISSING_TEXT = "Unknown"

# White space: Unicode White_Space plus the four separators 1C-1F.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_WIDE_BLANKS = "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_WORD = r"[\p{L}\p{N}_]"

# A float as text: digits with single underscores between them, a point, an exponent, or infinity.
_DIGITS = r"\d+(?:_\d+)*+"
_FLOAT = (rf"^[\t-\r\x1c-\x20]*+[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
          r"|(?i:inf|infinity))[\t-\r\x1c-\x20]*+\z")


def null_markers_to_null(c: Column) -> Column:
    """Reader-level null markers become null, anything else is kept as is."""
    return F.when(c.isin(CSV_NULL_MARKERS), F.lit(None)).otherwise(c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN counts as missing everywhere: operators take it as null on entry."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: nan_to_null(F.col(f"`{n}`")) for n in floats}) if floats else df


def parse_number(c: Column) -> Column:
    """Lenient number: keep digits, '-' and '.', then cast. ``USD 12`` is 12, ``1e5`` is 15.

    The words for "missing" hold none of these characters, so they turn into an empty text and
    from there into null without a test of their own.
    """
    return F.regexp_replace(c, r"[^0-9\-.]", "").try_cast("double")


def parse_money(c: Column) -> Column:
    """Strict number: only ``, $ € £`` are removed; any other stray character gives null."""
    text = F.translate(c, _WIDE_BLANKS + ",$€£", " " * len(_WIDE_BLANKS))
    return F.when(text.rlike(_FLOAT), F.translate(text, "_", "").try_cast("double"))


def parse_flag(c: Column) -> Column:
    """True for the accepted spellings of true; everything else, null included, is false."""
    return F.coalesce(c.isin(TRUE_MARKERS), F.lit(False))


def parse_discount(c: Column, on_error: str = "fail") -> Column:
    """``$12.34`` -> 12.34. ``on_error='fail'`` stops the job at junk, ``'null'`` blanks it."""
    bare = F.replace(c, F.lit("$"), F.lit(""))
    value = bare.try_cast("double")
    if on_error == "null":
        return value
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    failure = F.raise_error(F.concat(F.lit("not a discount: "), c)).cast("double")
    return F.when(value.isNotNull() | c.isNull(), value).otherwise(failure)


def clean_text(c: Column) -> Column:
    """One space between words, no punctuation at either end, ``Unknown`` for missing text.

    The second pattern goes from the first word character to the end of the text and steps back to
    the last one, so both ends are cut in one pass; without any word character it gives null.
    """
    spaced = F.regexp_replace(c, _SPACE, " ")
    bare = F.regexp_substr(spaced, F.lit(rf"(?s){_WORD}(?:.*{_WORD})?"))
    return F.when(c.isin(TEXT_NULL_MARKERS), F.lit(MISSING_TEXT)).otherwise(F.coalesce(bare, F.lit(MISSING_TEXT)))


def repair_mojibake(c: Column) -> Column:
    """Undo UTF-8 text that was read as latin-1; undecodable bytes become U+FFFD."""
    return F.make_valid_utf8(F.encode(c, "ISO-8859-1").cast("string"))


def latin1_to_cp1252(c: Column) -> Column:
    """Text read as latin-1 whose bytes were cp1252: move 80-9F to the characters meant."""
    undefined = bytes([0x81, 0x8D, 0x8F, 0x90, 0x9D])
    moved = bytes(b for b in range(0x80, 0xA0) if b not in undefined)
    return F.translate(c, moved.decode("latin-1"), moved.decode("cp1252"))
