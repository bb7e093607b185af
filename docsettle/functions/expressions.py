"""User-declared expressions: Spark SQL text with ``#n`` column positions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from docsettle.functions import scalars

#: Amounts are exact to six places.
AMOUNT = "DECIMAL(18,6)"
_POSITION = re.compile(r"'(?:[^'\\]|\\.)*'|`[^`]*`|#(\d+)")


@dataclass(frozen=True)
class NamedExpression:
    """One output field and the SQL text that fills it."""

    column_name: str
    expression: str


def resolve_positions(expression: str, columns: Sequence[str]) -> str:
    """Replace ``#n`` by the n-th column name (from 1); quoted text stays as it is."""

    def name(match: re.Match) -> str:
        if match.group(1) is None:
            return match.group(0)
        position = int(match.group(1))
        if not 1 <= position <= len(columns):
            raise ValueError(f"#{position} is outside the {len(columns)} columns")
        return "`" + columns[position - 1].replace("`", "``") + "`"

    return _POSITION.sub(name, expression)


def exact(number: str) -> str:
    """Text of a numeric expression's value as a decimal, which may be a factor of a sum's products."""
    return f"CAST({number} AS {AMOUNT})"


def exact_sum(text: str) -> str:
    """Expression text of the sum of a text expression's numbers, the same in whatever order a cluster adds them up.

    Numbers of up to six places and twelve digits before them are added as decimals. If a group holds any other,
    such as an infinity, its sum is one of doubles.
    """
    number, amount = f"safe_double({text})", f"safe_decimal({text})"
    fits = f"coalesce(CAST({amount} AS DOUBLE) = {number}, {number} IS NULL)"
    return f"CASE WHEN bool_and({fits}) THEN CAST(sum({amount}) AS DOUBLE) ELSE sum({number}) END"


def to_column(expression: str, columns: Sequence[str]) -> Column:
    return F.expr(resolve_positions(expression, columns))


@lru_cache(maxsize=8)
def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions for use inside declared expressions, once per session.

    They are SQL bodies, which Catalyst inlines; no Python runs per row. ``safe_double`` takes
    no type suffixes such as ``1d``, ``safe_decimal`` gives the same numbers to six places, ``safe_ts`` needs a full calendar date, ``strip_first``
    removes the first character that is neither digit nor dot, and ``day_month`` completes
    ``d MMMM`` with a given year; what cannot be read is null.
    """
    double_body = (
        f"CASE WHEN NOT (s RLIKE r'{scalars.TYPE_SUFFIX}' AND NOT s RLIKE r'{scalars.NOT_FINITE}') "
        "THEN try_cast(s AS DOUBLE) END"
    )
    stamp_body = f"CASE WHEN s RLIKE r'{scalars.DATE_PREFIX}' THEN try_cast(s AS TIMESTAMP_NTZ) END"
    strip_body = f"regexp_replace(s, r'{scalars.FIRST_NON_AMOUNT}', '$1')"
    day_body = (
        "try_to_timestamp(concat_ws(' ', initcap(trim(s)), CAST(y AS STRING)), 'd MMMM yyyy')"
    )
    for signature, result, body in [
        ("safe_double(s STRING)", "DOUBLE", double_body),
        ("safe_decimal(s STRING)", AMOUNT, double_body.replace("AS DOUBLE", f"AS {AMOUNT}")),
        ("safe_ts(s STRING)", "TIMESTAMP_NTZ", stamp_body),
        ("strip_first(s STRING)", "STRING", strip_body),
        ("day_month(s STRING, y INT)", "TIMESTAMP", day_body),
    ]:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {result} RETURN {body}"
        )
