"""Scalar column functions. All of them stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsettle.fixed import DUE_DAYS

# --- fixed values: patterns ---
INTEGER_TEXT = r"^[+-]?[0-9]+\z"
PLAIN_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
TYPE_SUFFIX = r"[dDfF]\s*\z"
NOT_FINITE = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*\z"
DATE_PREFIX = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
STRICT_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# white space by code point
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680\u2000\u2001\u2002\u2003"
    "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
FIRST_NON_AMOUNT = r"(?s)^([0-9.]*)[^0-9.]"
CURRENCY_WRAPPER = "[$₹]"
CURRENCY_SIGN = "₹"


def trim_space(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_name(name: Column) -> Column:
    """One-line column name: each line break becomes a blank, ends are trimmed."""
    return trim_space(F.translate(name, "\n\r", "  "))


def document_id(url: Column) -> Column:
    """Id in the last path segment; null where it is not a whole number."""
    segment = F.substring_index(F.regexp_replace(url, r"/\z", ""), "/", -1)
    return F.when(segment.rlike(INTEGER_TEXT), segment.try_cast("bigint"))


def strict_number(text: Column) -> Column:
    """Plain decimal or exponent notation as double, null for all else."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def weak_float(text: Column) -> Column:
    """Like :func:`strict_number`, with 0 for what is not a number."""
    return F.coalesce(strict_number(text), F.lit(0.0))


def minor_units(amount: Column) -> Column:
    """Whole minor units, cut off and not rounded: 19.99 gives 1998."""
    return F.coalesce((amount * F.lit(100.0)).try_cast("bigint"), F.lit(0).cast("bigint"))


def currency_minor_units(text: Column) -> Column:
    """Minor units of an amount with currency marks and thousands commas."""
    bare = F.replace(text, F.lit(CURRENCY_WRAPPER), F.lit(""))
    bare = F.replace(bare, F.lit(CURRENCY_SIGN), F.lit(""))
    bare = trim_space(F.replace(bare, F.lit(","), F.lit("")))
    return minor_units(weak_float(bare))


def due_date(issued: Column, days: int = DUE_DAYS) -> Column:
    """Issue date plus ``days``; text that is no ISO date is passed on as it is."""
    day = F.when(issued.rlike(STRICT_DATE), issued.try_cast("date"))
    return F.coalesce(F.date_add(day, days).cast("string"), issued)


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def or_default(text: Column, default: str | Column) -> Column:
    """``default`` where the text is null or empty."""
    default = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(non_empty(text), default)
