import datetime as dt

import pytest
from pyspark.sql import functions as F

from docsettle.functions import scalars
from docsettle.functions.expressions import register_sql_functions


def check(values, function, cases):
    assert values(function, list(cases)) == list(cases.values())


@pytest.fixture
def declared(spark):
    """An expression over the text ``t`` as declared ones are written."""
    register_sql_functions(spark)
    return lambda text: lambda _: F.expr(text)


def test_document_id(values):
    check(
        values,
        scalars.document_id,
        {
            "http://w:8000/documents/73/": 73,
            "http://w:8000/documents/73": 73,
            "http://w:8000/documents/73//": None,
            "73": 73,
            "http://w/documents/73/?x=1": None,
            "/documents/+5/": 5,
            "/documents/-5/": -5,
            "": None,
            "/5\n": None,
            "/99999999999999999999": None,
        },
    )


def test_weak_float(values):
    check(
        values,
        scalars.weak_float,
        {
            "100.50": 100.5, "1,200.00": 0.0, "$5": 0.0, " 7 ": 0.0, "1d": 0.0, "1e2": 100.0,
            "5.": 5.0, ".5": 0.5, "": 0.0, "+5": 5.0, "-3": -3.0, None: 0.0,
        },
    )


def test_minor_units_cut_off(values):
    cases = {"1.15": 114, "100.50": 10050, "19.99": 1998, "-0.5": -50, "1e300": 0}
    check(values, lambda t: scalars.minor_units(scalars.weak_float(t)), cases)


def test_currency_minor_units(values):
    cases = {"₹1,234.50": 123450, "[$₹]1": 100, " 7\t": 700, "₹ 12": 1200, "Rs 5": 0, "": 0}
    check(values, scalars.currency_minor_units, cases)


def test_due_date(values):
    check(
        values,
        scalars.due_date,
        {
            "2023-01-05": "2023-02-04", "2023-1-5": "2023-1-5", "2023-02-30": "2023-02-30",
            "03-DEC-2025": "03-DEC-2025", "2024-02-01": "2024-03-02", "": "",
        },
    )


def test_strip_first(values, declared):
    check(
        values,
        declared("safe_double(strip_first(t))"),
        {
            "-1234.5": 1234.5, "-1,234.5": None, "Rs 12": None, "₹1234": 1234.0,
            "(500)": None, "1234": 1234.0,
        },
    )


def test_safe_double_refuses_type_suffixes(values, declared):
    cases = {"1d": None, "1F": None, "2.5 D ": None, "1e3": 1000.0, " 7 ": 7.0, "x": None}
    check(values, declared("safe_double(t)"), cases)
    assert values(declared("safe_double(t)"), ["inf", "-Infinity"]) == [float("inf"), float("-inf")]


def test_safe_ts_needs_a_full_date(values, declared):
    check(
        values,
        declared("safe_ts(t)"),
        {
            "2026": None, "2026-01": None, "2026-1-2": dt.datetime(2026, 1, 2),
            "2026-01-02 03:04:05+05:30": dt.datetime(2026, 1, 2, 3, 4, 5), "2026-02-30": None,
        },
    )


def test_day_month(values, declared):
    cases = {" 9 February ": dt.datetime(2024, 2, 9), "29 FEBRUARY": dt.datetime(2024, 2, 29), "x": None}
    check(values, declared("day_month(t, 2024)"), cases)
    assert values(declared("day_month(t, 2023)"), ["29 February"]) == [None]


def test_clean_name(values):
    cases = {"a\nb": "a b", "a\r\nb": "a  b", "  a \t\n": "a", "  ": "", "a \nb": "a  b"}
    check(values, scalars.clean_name, cases)


def test_defaults(values):
    assert values(lambda t: scalars.or_default(t, "d"), ["", None, "x"]) == ["d", "d", "x"]
