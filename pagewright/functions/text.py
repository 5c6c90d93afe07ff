"""Scalar text expressions: every function maps columns to one column, without Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that count as white space in the source texts' own tooling.
# Java's ``\s`` knows only six of them and Spark's ``trim`` only one.
SPACES = r"\p{IsWhite_Space}\x1c-\x1f"

# Code point ranges counted as emoji.
EMOJI = (
    r"\x{1F300}-\x{1F5FF}"
    r"\x{1F600}-\x{1F64F}"
    r"\x{1F680}-\x{1F6FF}"
    r"\x{1F900}-\x{1F9FF}"
    r"\x{2600}-\x{26FF}"
    r"\x{2700}-\x{27BF}"
)

# Upper band edges (right-closed) and the label of each band.
PRICE_BANDS = ((100_000.0, "budget"), (500_000.0, "mid"), (1_000_000.0, "upper_mid"), (None, "premium"))
SOLD_BANDS = ((50.0, "low"), (200.0, "medium"), (1_000.0, "high"), (None, "very_high"))
BAND_FLOOR = -1.0

SHORT_REVIEW_CHARS = 20
EXTREME_STARS = (1, 5)

# A number as the source tables' own tooling reads it: ASCII blanks around, no suffix, no words
# other than infinity.
_NUMBER = r"^[ \t-\r]*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))[ \t-\r]*$"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once. A column used several times in an expression is
    repeated in the plan each time, which multiplies when such expressions nest."""
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def sql_strip(value: str) -> str:
    """``strip`` as SQL text."""
    return f"regexp_replace({value}, r'^[{SPACES}]+|[{SPACES}]+$', '')"


def sql_let(value: str, name: str, body: str) -> str:
    """``let`` as SQL text: ``body`` may use ``name`` for the value."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def sql_non_empty(value: str) -> str:
    return f"get(filter(array({value}), v -> v <> ''), 0)"


def non_empty(value: Column) -> Column:
    """The text, or NULL when it is empty."""
    return F.get(F.filter(F.array(value), lambda v: v != ""), F.lit(0))


def text_of(value: Column) -> Column:
    """The value as text, NULL as the empty string."""
    return F.coalesce(value.cast("string"), F.lit(""))


def strip(value: Column) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` knows spaces only)."""
    return F.regexp_replace(value, f"^[{SPACES}]+|[{SPACES}]+$", "")


def squeeze(value: Column) -> Column:
    """Collapse white space runs to one space and trim."""
    return F.trim(F.regexp_replace(value, f"[{SPACES}]+", " "))


def is_blank(value: Column) -> Column:
    """True for NULL and for text made of white space only."""
    return ~text_of(value).rlike(f"[^{SPACES}]")


def normalize_text(value: Column) -> Column:
    return F.lower(squeeze(text_of(value)))


def mask_identifier(value: Column) -> Column:
    """Keep the first and last character of the normalized name, star the rest."""
    name = normalize_text(value)
    n = F.length(name)
    inner = F.concat(F.substring(name, 1, 1), F.repeat(F.lit("*"), n - 2), F.right(name, F.lit(1)))
    return F.when(n <= 2, F.repeat(F.lit("*"), n)).otherwise(inner)


def to_numeric_string(value: Column) -> Column:
    """Trimmed text with every comma turned into a decimal point."""
    return F.translate(strip(text_of(value)), ",", ".")


def stable_hash(value: Column) -> Column:
    return F.sha2(value, 256)


def text_length(value: Column) -> Column:
    """Code points of the raw text."""
    return F.length(text_of(value))


def repeated_char_ratio(value: Column) -> Column:
    """Share of characters inside runs of three or more equal characters, four decimals.

    The share is measured by what deleting the runs takes away, which stays one string
    expression; ``(?d)`` makes only the line feed end a run.
    """
    text = text_of(value)
    n = F.length(text)
    kept = F.length(F.regexp_replace(text, r"(?d)(.)\1{2,}", ""))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.bround((n - kept) / n, 4))


def emoji_count(value: Column) -> Column:
    """Number of emoji *runs*. Text without any character that high skips the costly pattern."""
    text = text_of(value)
    runs = F.regexp_count(text, F.lit(f"[{EMOJI}]+"))
    return F.when(text.rlike(r"[^\x00-\x{25FF}]"), runs).otherwise(F.lit(0))


def exclamation_count(value: Column) -> Column:
    text = text_of(value)
    return F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))


def short_review_flag(value: Column) -> Column:
    return text_length(value) < SHORT_REVIEW_CHARS


def variant_present_flag(value: Column) -> Column:
    return ~is_blank(value)


def extreme_rating_flag(value: Column) -> Column:
    """True for the lowest and highest star of a numeric column; NULL is false."""
    return F.coalesce(value.isin(*EXTREME_STARS), F.lit(False))


def template_key(normalized: Column) -> Column:
    """Normalized text with each digit run replaced, so texts that differ in numbers only meet."""
    return F.regexp_replace(normalized, r"(?U)\d+", "<num>")


def to_number(value: Column) -> Column:
    """Number or NULL. The pattern guards the cast, which also accepts suffixes such as ``5d``."""
    text = value.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def digits_and_dots(value: Column) -> Column:
    return F.regexp_replace(text_of(value), r"(?U)[^\d.]", "")


def band_numeric(value: Column, bands=PRICE_BANDS, floor: float = BAND_FLOOR) -> Column:
    """Label of the right-closed band that holds ``value``; the floor itself belongs to the first
    band, values below it and NULL get NULL. ``bands`` is ((upper edge, label), ...), where an
    edge of None means no upper limit."""

    def label(number: Column) -> Column:
        inside = (number >= floor) & ~F.isnan(number)
        out = None
        for edge, name in bands:
            hit = inside if edge is None else inside & (number <= edge)
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out.otherwise(F.lit(None).cast("string"))

    return let(to_number(value), label)


def price_band(value: Column) -> Column:
    return band_numeric(digits_and_dots(value), PRICE_BANDS)


def sold_band(value: Column) -> Column:
    return band_numeric(digits_and_dots(value), SOLD_BANDS)


def fill_flag(value: Column) -> Column:
    return F.coalesce(value.try_cast("boolean"), F.lit(False))
