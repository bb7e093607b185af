"""Bounds of all blocks of a sheet from one pass over its rows, chained relative ones included.

Row numbers are cut into stretches of 1,024. One aggregate per document and stretch, which combines map side, tells
where rows that are not blank begin and end to follow each other; the first row of a stretch also counts for the stretch before,
so that every stretch knows whether its last row goes on. A block's end is then the least gap of the stretches at or after
its first row, which carries over any number of full ones, and a relative import starts from the end of the block
before it. None of this reads the rows again, and no document has to fit into a task.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle.operators.ranges import is_blank
from docsettle.session import staged
from docsettle.sources.config import PlatformConfig
from docsettle.sources.payloads import has_formula_error
from docsettle.sources.ranges import Range

BITS = 10
SIZE = 1 << BITS


def _runs(positions: Column) -> Column:
    """Sets of positions as runs ``s`` to ``e`` (exclusive), in order."""
    after = F.transform(positions, lambda p: p + 1)
    begins = F.array_sort(F.array_except(positions, after))
    ends = F.array_sort(F.array_except(after, positions))
    return F.zip_with(begins, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))


class SheetBlocks:
    """The imports of one platform whose block starts or ends at a place that differs by document.

    ``rows`` are sheet rows, ``documents`` all documents that are asked for. Each sheet is read once, when the first of its
    blocks is needed; what is known of it is a row per 1,024 rows in the shared folder.
    """

    def __init__(self, documents: DataFrame, rows: DataFrame, config: PlatformConfig):
        self.documents = documents.select("document_id").distinct()
        self.rows, self.config = rows, config
        self._stretches: dict[str, DataFrame] = {}
        self._bounds: dict[int, DataFrame] = {}

    @cached_property
    def _windows(self) -> list[tuple[str, tuple[int, int] | None, int | None]]:
        """Sheet, columns and last row of each import."""
        out = []
        for position, one in enumerate(self.config.import_configs):
            window = self.config.window(position)
            out.append((one.sheet, _columns(window), window.last_row if window is not None else None))
        return out

    def stretches(self, position: int) -> DataFrame:
        """``document_id, stretch`` and, by columns of the sheet's windows, runs of rows; by last rows, the greatest row up to it.

        For a platform whose rows a service prepares also the positions of rows, and of those with formula errors.
        """
        sheet = self._windows[position][0]
        if sheet in self._stretches:
            return self._stretches[sheet]
        rows = self.rows
        if sheet:
            rows = rows.where(F.col("sheet") == sheet)
        elif "sheet_no" in rows.columns:
            rows = rows.where(F.col("sheet_no") == 1)
        mine = [w for w in self._windows if w[0] == sheet]
        columns = list(dict.fromkeys(w[1] for w in mine))
        limits = list(dict.fromkeys(w[2] for w in mine))
        cuts = [F.col("vals") if c is None else F.slice("vals", F.lit(c[0]), F.lit(c[1])) for c in columns]
        service = self.config.uses_row_service
        number, offset = F.shiftright("row_no", BITS), F.col("row_no").bitwiseAND(F.lit(SIZE - 1)).cast("int")
        here = F.struct(number.alias("stretch"), offset.alias("at"))
        before = F.struct((number - 1).alias("stretch"), F.lit(SIZE).alias("at"))
        places = F.when((offset == 0) & (number > 0), F.array(here, before)).otherwise(F.array(here))
        flags = [(~is_blank(cut)).alias(f"full_{k}") for k, cut in enumerate(cuts)]
        if service:
            flags += [has_formula_error(cut).alias(f"bad_{k}") for k, cut in enumerate(cuts)]
        # only flags go on: the cells are not shuffled
        placed = rows.select("document_id", "row_no", *flags, F.explode(places).alias("place"))
        at, own = F.col("place.at"), F.col("place.at") < SIZE
        found = [F.collect_set(F.when(F.col(f"full_{k}"), at)).alias(f"full_{k}") for k in range(len(cuts))]
        if service:
            found += [F.collect_set(F.when(own & F.col(f"bad_{k}"), at)).alias(f"bad_{k}") for k in range(len(cuts))]
            found.append(F.collect_set(F.when(own, at)).alias("all"))
        for k, limit in enumerate(limits):
            row = F.col("row_no") if limit is None else F.when(F.col("row_no") <= limit, F.col("row_no"))
            found.append(F.max(row).alias(f"last_{k}"))
        grouped = placed.groupBy("document_id", F.col("place.stretch").alias("stretch")).agg(*found)
        named = {f"full_{k}": _runs(F.col(f"full_{k}")) for k in range(len(cuts))}
        self._stretches[sheet] = staged(grouped.withColumns(named), "stretches")
        return self._stretches[sheet]

    def _names(self, position: int) -> tuple[str, str, str]:
        """Columns of an import's runs, errors and last row."""
        sheet, columns, limit = self._windows[position]
        mine = [w for w in self._windows if w[0] == sheet]
        k = list(dict.fromkeys(w[1] for w in mine)).index(columns)
        return f"full_{k}", f"bad_{k}", f"last_{list(dict.fromkeys(w[2] for w in mine)).index(limit)}"

    def first_rows(self, position: int) -> DataFrame:
        """``document_id, first_row`` for every document."""
        one = self.config.import_configs[position]
        if not one.is_relative:
            window = self.config.window(position)
            first = window.first_row if window is not None else 1
            return self.documents.withColumn("first_row", F.lit(first).cast("bigint"))
        relative = one.relative_range
        first = (F.col("end_row") + relative.rows_offset).cast("bigint")
        return self.ends(relative.relative_config_index).select("document_id", first.alias("first_row"))

    def bounds(self, position: int) -> DataFrame:
        """``document_id, first_row, last_row``; documents without any row of the block at or after its first are absent."""
        if position not in self._bounds:
            self._bounds[position] = self._found(position)
        return self._bounds[position]

    def _found(self, position: int) -> DataFrame:
        one, limit = self.config.import_configs[position], self._windows[position][2]
        stretches = self.stretches(position)
        runs, _, last = self._names(position)
        if one.is_relative:
            first = F.col("first_row")
            seen = stretches.join(self.first_rows(position), "document_id")
        else:
            window = self.config.window(position)
            first = F.lit(window.first_row if window is not None else 1).cast("bigint")
            seen = stretches.withColumn("first_row", first)
        if not self.config.stops_at_empty(one):
            most = seen.groupBy("document_id", "first_row").agg(F.max(last).alias("last_row"))
            return most.where("last_row >= first_row").select("document_id", "first_row", F.col("last_row").cast("bigint"))
        number = F.shiftright("first_row", BITS)
        seen = seen.where(F.col("stretch") >= number)
        begins = F.col("stretch") == number
        at = F.when(begins, F.col("first_row").bitwiseAND(F.lit(SIZE - 1)).cast("int")).otherwise(0)
        low = F.col("stretch") * SIZE
        seen = seen.select("document_id", "first_row", begins.alias("begins"), at.alias("at"), low.alias("low"), F.col(runs).alias("runs"))
        run = F.get(F.filter("runs", lambda r: (r["s"] <= F.col("at")) & (F.col("at") < r["e"])), F.lit(0))
        gap = F.when(run.isNull(), F.col("low") + F.col("at")).when(run["e"] <= SIZE, F.col("low") + run["e"])
        high = F.lit(SIZE) if limit is None else F.lit(limit) - F.col("low")
        some = F.exists("runs", lambda r: (r["e"] > F.col("at")) & (r["s"] <= high) & (F.col("at") <= high))
        ends = seen.groupBy("document_id", "first_row").agg(
            F.bool_or("begins").alias("begins"), F.min(gap).alias("gap"), F.bool_or(some).alias("some")
        )
        end = F.when(F.col("begins"), F.col("gap")).otherwise(F.col("first_row")) - 1
        if limit is not None:
            end = F.least(end, F.lit(limit))
        return ends.where("some").select("document_id", "first_row", end.cast("bigint").alias("last_row"))

    def ends(self, position: int) -> DataFrame:
        """``document_id, end_row``, what a relative import counts from, for every document.

        A closed range ends at its own last row. An open one ends at the last row of the block, and at its first
        row where the block has none. Where a service prepares the rows, the end is counted: the first row, and a
        row for each one that has been landed; the footer counts though it is left out, and without a header one row less.
        """
        one, limit = self.config.import_configs[position], self._windows[position][2]
        if self.config.uses_row_service:
            landed = self.landed(position).withColumnRenamed("rows", "n")
            count = F.coalesce("n", F.lit(0)) - int(bool(one.footer)) * F.coalesce((F.col("n") > 0).cast("int"), F.lit(0))
            count = count - int(not one.has_header) + int(bool(one.footer))
            joined = self.first_rows(position).join(landed, "document_id", "left")
            return joined.select("document_id", (F.col("first_row") + F.greatest(count, F.lit(0))).cast("bigint").alias("end_row"))
        starts = self.first_rows(position)
        if limit is not None:
            return starts.select("document_id", F.lit(limit).cast("bigint").alias("end_row"))
        end = F.greatest(F.coalesce("last_row", "first_row"), "first_row")
        known = self.bounds(position).drop("first_row")
        return starts.join(known, "document_id", "left").select("document_id", end.alias("end_row"))

    def landed(self, position: int) -> DataFrame:
        """``document_id, rows``: rows of the block below its header and without a formula error; absent where it has none."""
        one = self.config.import_configs[position]
        _, bad, _ = self._names(position)
        known = self.bounds(position).withColumn("first_row", F.col("first_row") + int(one.has_header))
        seen = self.stretches(position).join(known, "document_id")
        low = F.col("stretch") * SIZE

        def count(positions: str) -> Column:
            return F.size(F.filter(positions, lambda p: (low + p >= F.col("first_row")) & (low + p <= F.col("last_row"))))

        return seen.groupBy("document_id").agg(F.sum(count("all") - count(bad)).cast("bigint").alias("rows"))


def _columns(window: Range | None) -> tuple[int, int] | None:
    return None if window is None else (window.start.column_no, window.width)


def block_bounds(documents: DataFrame, rows: DataFrame, config: PlatformConfig, position: int) -> DataFrame:
    """:meth:`SheetBlocks.bounds` of one import alone."""
    return SheetBlocks(documents, rows, config).bounds(position)


def range_ends(documents: DataFrame, rows: DataFrame, config: PlatformConfig, position: int) -> DataFrame:
    """:meth:`SheetBlocks.ends` of one import alone."""
    return SheetBlocks(documents, rows, config).ends(position)
