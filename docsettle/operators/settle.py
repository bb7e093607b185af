"""Settlement: declared expressions over landing tables, one row per document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsettle.fixed import (
    SETTLEMENT_AMOUNT,
    SETTLEMENT_COUNT,
    SETTLEMENT_ORDER,
    SETTLEMENT_TEXT,
)
from docsettle.functions.expressions import (
    NamedExpression,
    register_sql_functions,
    resolve_positions,
    to_column,
)
from docsettle.functions.scalars import strict_number
from docsettle.sources.config import ExportConfig

_FIELDS = SETTLEMENT_TEXT + SETTLEMENT_COUNT + SETTLEMENT_AMOUNT
_BY_KEY = {name.replace("_", ""): name for name in _FIELDS}


def positions(landing: DataFrame) -> list[str]:
    """Columns in the order ``#n`` counts: the document id, then the sheet's columns."""
    return [name for name in landing.columns if name not in ("row_no", "batch_id")]


def _is_aggregate(landing: DataFrame, columns: list[Column]) -> bool:
    """Whether the columns hold per document. Only the analyser is asked, no job runs."""
    try:
        landing.groupBy("document_id").agg(*columns).schema  # noqa: B018
    except AnalysisException:
        landing.select(*columns).schema  # noqa: B018
        return False
    return True


def _mentioned(names: Sequence[str], texts: Sequence[str]) -> list[str]:
    """The columns whose name occurs in any of the texts, which are all that they can read."""
    whole = " ".join(texts).lower()
    return [name for name in names if name.replace("`", "``").lower() in whole]


def _evaluate_groups(landing: DataFrame, groups: Sequence[Sequence[NamedExpression]]) -> DataFrame:
    """All groups of expressions in one aggregation per document.

    A group of plain expressions is evaluated on the document's first row only, after
    the aggregation has found it.
    """
    register_sql_functions(landing.sparkSession)
    names = positions(landing)
    aggregates: list[Column] = []
    done, plain = ["document_id"], []
    for number, readers in enumerate(groups):
        columns = [to_column(one.expression, names).alias(one.column_name) for one in readers]
        if _is_aggregate(landing, columns):
            aggregates += columns
            done += [one.column_name for one in readers]
            continue
        texts = [resolve_positions(one.expression, names) for one in readers]
        used = [F.col(f"`{n.replace('`', '``')}`") for n in _mentioned(names[1:], texts)]
        aggregates.append(F.min(F.struct("row_no", *used)).alias(f"_first{number}"))
        plain.append((number, readers, columns))
    result = landing.groupBy("document_id").agg(*aggregates)
    for number, readers, columns in plain:
        waiting = [f"_first{later}" for later, *_ in plain if later > number]
        result = result.select(*done, *waiting, f"_first{number}.*").select(
            *done, *waiting, *columns
        )
        done += [one.column_name for one in readers]
    return result


def evaluate(landing: DataFrame, readers: Sequence[NamedExpression]) -> DataFrame:
    """Named expressions per document: aggregates, or values of the first row."""
    return _evaluate_groups(landing, [readers])


def _typed(name: str, column: Column, data_type: T.DataType) -> Column:
    """A value as the settlement field's type; null where it cannot be read."""
    if name in SETTLEMENT_TEXT:
        return column.cast("string")
    if isinstance(data_type, T.StringType):
        column = strict_number(column)
    return column.cast("double") if name in SETTLEMENT_AMOUNT else column.try_cast("bigint")


def merge_exports(
    documents: DataFrame, landings: Mapping[str, DataFrame], exports: Sequence[ExportConfig]
) -> DataFrame:
    """All exports of a platform in one row per document.

    Exports over one table share one aggregation. A later export overwrites an earlier
    one unless its value is null; fields no export fills are 0 or empty. A table that was
    not created, as no document has its block, fills nothing.
    """
    by_table: dict[str, list[tuple[str, NamedExpression]]] = {}
    order: dict[str, list[str]] = {name: [] for name in _FIELDS}
    for number, export in enumerate(exports):
        if export.table_name not in landings:
            continue
        for place, reader in enumerate(export.reader_configs):
            field = _BY_KEY.get(reader.column_name.replace("_", "").lower())
            if field is None:
                continue
            alias = f"x{number}_{place}_{field}"
            order[field].append(alias)
            renamed = NamedExpression(alias, reader.expression)
            by_table.setdefault(export.table_name, []).append((str(number), renamed))

    merged = documents.select("document_id")
    for table, readers in by_table.items():
        numbers = list(dict.fromkeys(number for number, _ in readers))
        merged = merged.join(
            _evaluate_groups(
                landings[table], [[r for n, r in readers if n == k] for k in numbers]
            ),
            "document_id",
            "left",
        )
    types = {f.name: f.dataType for f in merged.schema}
    fields = []
    for name in _FIELDS:
        values = [_typed(name, F.col(alias), types[alias]) for alias in reversed(order[name])]
        empty = F.lit("") if name in SETTLEMENT_TEXT else F.lit(0)
        kind = "string" if name in SETTLEMENT_TEXT else "double"
        kind = "bigint" if name in SETTLEMENT_COUNT else kind
        fields.append(F.coalesce(*values, empty.cast(kind)).alias(name))
    return merged.select("document_id", *fields)


def finalise(
    settled: DataFrame, platform: str, outlet_name: str, digits: int | None = None
) -> DataFrame:
    """Platform, outlet and final amount, which takes the marketing amount on top.

    ``digits`` rounds the amounts, which makes them independent of the order in which
    a cluster adds them up.
    """
    final = F.col("final_payout_amt") + F.col("marketing_ads_amt")
    done = settled.withColumns(
        {
            "platform": F.lit(platform),
            "outlet_name": F.lit(outlet_name),
            "final_payout_amt": final,
        }
    )
    if digits is not None:
        done = done.withColumns({name: F.round(name, digits) for name in SETTLEMENT_AMOUNT})
    return done.select(*SETTLEMENT_ORDER)


def settle(
    documents: DataFrame,
    landings: Mapping[str, DataFrame],
    exports: Sequence[ExportConfig],
    platform: str,
    outlet_name: str,
    digits: int | None = None,
) -> DataFrame:
    """Settlement records of all given documents of a platform."""
    merged = merge_exports(documents, landings, exports)
    return finalise(merged, platform, outlet_name, digits)
