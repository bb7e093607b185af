"""From sheet rows to the rows of one block: slice, header, empty rows, footers.

Input is one record per physical sheet row, ``(document_id, sheet, row_no, vals)``.
A document may hold any share of all rows, so nothing here groups or joins rows by
document alone: what is known per document is attached to rows by document *and* block
of row numbers, and per-document facts come from aggregates that combine map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle.functions.scalars import clean_name, or_default
from docsettle.sources.config import ImportConfig, PlatformConfig
from docsettle.sources.payloads import has_formula_error
from docsettle.sources.ranges import Range

JOIN_BLOCK_BITS = 16
OWN_COLUMNS = ["document_id", "row_no", "batch_id"]


def assemble_rows(cells: DataFrame) -> DataFrame:
    """Long cells ``(document_id, sheet, row_no, col_no, value)`` to sheet rows.

    A group is one physical row, bounded by the width of a sheet.
    """
    entry = F.struct("col_no", "value")
    rows = cells.groupBy("document_id", "sheet", "row_no").agg(
        F.map_from_entries(F.collect_list(entry)).alias("by_col"),
        F.max("col_no").alias("width"),
    )
    vals = F.transform(F.sequence(F.lit(1), "width"), lambda n: F.col("by_col")[n])
    return rows.select("document_id", "sheet", "row_no", vals.alias("vals"))


def is_blank(values: Column) -> Column:
    return ~F.exists(values, lambda v: F.coalesce(F.length(F.trim(v)) > 0, F.lit(False)))


def sheet_window(rows: DataFrame, sheet: str, window: Range | None) -> DataFrame:
    """Rows of a sheet cut to the window's columns. Rows are not cut here."""
    if sheet:
        rows = rows.where(F.col("sheet") == sheet)
    elif "sheet_no" in rows.columns:
        rows = rows.where(F.col("sheet_no") == 1)
    vals = F.col("vals")
    if window is not None:
        vals = F.slice("vals", F.lit(window.start.column_no), F.lit(window.width))
    return rows.select("document_id", "row_no", vals.alias("vals"))


def between_rows(rows: DataFrame, first: int, last: int | None) -> DataFrame:
    """Literal row bounds, a plain filter that reaches the scan."""
    rows = rows.where(F.col("row_no") >= first)
    return rows if last is None else rows.where(F.col("row_no") <= last)


def slice_range(rows: DataFrame, sheet: str, window: Range) -> DataFrame:
    """Rectangular window as columns ``c1 .. ck``."""
    cut = between_rows(sheet_window(rows, sheet, window), window.first_row, window.last_row)
    return cut.select("document_id", "row_no", *spread(window.column_names))


def spread(names: list[str]) -> list[Column]:
    return [F.get("vals", F.lit(n)).alias(name) for n, name in enumerate(names)]


def extent(rows: DataFrame) -> DataFrame:
    """Greatest row number per document."""
    return rows.groupBy("document_id").agg(F.max("row_no").alias("max_row"))


def clip(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows within ``first_row .. last_row`` of their document, with the bounds' columns.

    Bounds are repeated once per block of rows they cover, so a huge document is
    spread over as many join keys as it has blocks.
    """
    covered = F.sequence(
        F.shiftright("first_row", JOIN_BLOCK_BITS), F.shiftright("last_row", JOIN_BLOCK_BITS)
    )
    pieces = bounds.where("last_row >= first_row").withColumn("block", F.explode(covered))
    return (
        rows.withColumn("block", F.shiftright("row_no", JOIN_BLOCK_BITS))
        .join(pieces, ["document_id", "block"])
        .where("row_no BETWEEN first_row AND last_row")
        .drop("block")
    )


def clean_names(header: DataFrame, window: Range | None) -> DataFrame:
    """``vals`` of header rows as usable column ``names``, as many as the window is wide.

    Blanks get a neutral name; repeats and the landing table's own names get a suffix.
    """
    width = F.size("vals") if window is None else F.lit(window.width)
    cells = F.transform(F.sequence(F.lit(0), width - 1), lambda n: F.get("vals", n))

    def named(value: Column, place: Column) -> Column:
        neutral = F.concat(F.lit("c"), (place + 1).cast("string"))
        return or_default(clean_name(value), neutral)

    def suffixed(name: Column, place: Column) -> Column:
        key = F.get("_keys", place)
        same = F.filter(F.slice("_keys", F.lit(1), place), lambda other: other == key)
        taken = F.size(same) + key.isin(OWN_COLUMNS).cast("int")
        return F.when(taken > 0, F.concat_ws("_", name, taken.cast("string"))).otherwise(name)

    own = F.array(*map(F.lit, OWN_COLUMNS))
    distinct = F.size(F.array_distinct("_keys")) == F.size("_keys")
    usable = distinct & ~F.arrays_overlap("_keys", own)
    return (
        header.select("document_id", F.transform(cells, named).alias("_named"))
        .withColumn("_keys", F.transform("_named", F.lower))
        .withColumn(
            "names",
            F.when(usable, F.col("_named")).otherwise(F.transform("_named", suffixed)),
        )
        .select("document_id", "names")
    )


def literal_header_rows(rows: DataFrame, window: Range | None) -> DataFrame:
    """Header row per document at a literal place, a filter that reaches the scan."""
    first = window.first_row if window is not None else 1
    return rows.where(F.col("row_no") == first).select("document_id", "vals")


def relative_header_rows(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Header row per document at the start of its block; the join keys are single rows."""
    first = bounds.select("document_id", F.col("first_row").alias("row_no"))
    return rows.join(first, ["document_id", "row_no"]).select("document_id", "vals")


def drop_formula_errors(rows: DataFrame) -> DataFrame:
    """Drop every row that holds a formula error in any column."""
    return rows.where(~has_formula_error(F.col("vals")))


def drop_footer(rows: DataFrame) -> DataFrame:
    """Drop the last row of every document; the join keys are single rows."""
    last = extent(rows).withColumnRenamed("max_row", "row_no")
    return rows.join(last, ["document_id", "row_no"], "left_anti")


def needs_bounds(config: PlatformConfig, one: ImportConfig) -> bool:
    """Whether the rows of an import end or start at a place that differs by document."""
    return one.is_relative or config.stops_at_empty(one)
