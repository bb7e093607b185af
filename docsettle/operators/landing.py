"""Landing tables: block rows brought to the columns of their table, and written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docsettle import schemas
from docsettle.operators import ranges
from docsettle.operators.blocks import SheetBlocks
from docsettle.session import staged
from docsettle.sources.config import ImportConfig, PlatformConfig
from docsettle.sources.payloads import block_rows, payload_blocks, row_value
from docsettle.sources.ranges import Range
from docsettle.sources.workbook import readable_rows

BY_NAME, BY_POSITION, REJECTED = "by_name", "by_position", "rejected"
COLUMNS_TABLE = "landing_columns"
Columns = Mapping[str, Sequence[str]]


def in_order(target: Sequence[str]) -> Column:
    """The match of a block without names: its columns in their order."""
    positions = F.sequence(F.lit(1), F.lit(len(target)))
    return F.struct(F.lit(BY_POSITION).alias("how"), positions.alias("source"))


def match_columns(blocks: DataFrame, target: Sequence[str]) -> DataFrame:
    """Adds ``match``: how a block with its ``names`` fits a table, and from which positions.

    Known names only: by name, absent columns stay null. Unknown names but as many
    columns: by position. Anything else is rejected. Names are compared without regard to
    case.
    """
    table = F.array(*[F.lit(name.lower()) for name in target])
    place = F.transform(table, lambda t: F.array_position("_own", t).cast("int"))
    by_name = F.transform(place, lambda n: F.when(n > 0, n))
    found = F.struct(F.lit(BY_NAME).alias("how"), by_name.alias("source"))
    nothing = F.lit(None).cast("array<int>")
    match = (
        F.when(F.size(F.array_except("_own", table)) == 0, found)
        .when(F.size("_own") == len(target), in_order(target))
        .otherwise(F.struct(F.lit(REJECTED).alias("how"), nothing.alias("source")))
    )
    own = F.transform("names", F.lower)
    return blocks.withColumn("_own", own).withColumn("match", match).drop("_own")


def project_rows(rows: DataFrame, target: Sequence[str], match: str = "match") -> DataFrame:
    """``vals`` to the table's columns, by the positions found in ``match``."""
    columns = []
    for number, name in enumerate(target):
        place = F.get(F.col(f"{match}.source"), F.lit(number))
        columns.append(F.get("vals", place - 1).alias(name))
    fitting = rows.where(F.col(f"{match}.how") != REJECTED)
    return fitting.select("document_id", "row_no", *columns)


def first_columns(headers: DataFrame, window: Range | None) -> list[str]:
    """Column names of the first document, which decide the table's columns.

    One header row comes to the driver; its size is bounded by a sheet's width.
    """
    first = headers.agg(
        F.min("document_id").alias("document_id"), F.min_by("vals", "document_id").alias("vals")
    ).where(F.col("document_id").isNotNull())
    found = ranges.clean_names(first, window).first()
    return list(found["names"]) if found else []


def first_payload_columns(payloads: DataFrame) -> list[str]:
    """As :func:`first_columns`: the names of the first payload that has any.

    Mostly that is the first payload, so only its body is read and parsed for it; the least
    id comes from the ids alone.
    """
    least = payloads.agg(F.min("document_id").alias("least")).first()["least"]
    if least is None:
        return []
    first = payloads.where(F.col("document_id") == least)
    for candidates in (first, payloads):
        named = payload_blocks(candidates).where(F.size("names") > 0)
        found = named.agg(F.min_by("names", "document_id").alias("names")).first()
        if found and found["names"]:
            kept: dict[str, str] = {}
            for name in found["names"]:
                kept.setdefault(name.lower(), name)
            return list(kept.values())
    return []


def append(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Append by name where the names are known, else by position at equal width."""
    target = table.columns
    if {name.lower() for name in batch.columns} <= {name.lower() for name in target}:
        return table.unionByName(batch, allowMissingColumns=True)
    if len(batch.columns) == len(target):
        return table.union(batch.toDF(*target))
    raise ValueError(f"columns {batch.columns} fit neither by name nor by position")


def land_payload_blocks(
    blocks: DataFrame, target: Sequence[str], footer: bool | None = None
) -> DataFrame:
    """Payload blocks ``(document_id, names, rows)`` in the table's columns.

    How a block fits the table is found once per payload, not once per row.
    """
    matched = match_columns(blocks, target)
    sources = F.transform("match.source", lambda place: F.get("names", place - 1))
    # no rows instead of a filter, which would parse every body a second time
    kept = F.when(F.col("match.how") != REJECTED, F.col("rows"))
    rows = block_rows(matched.select("document_id", sources.alias("sources"), kept.alias("rows")))
    if footer:
        rows = ranges.drop_footer(rows)
    columns = [
        row_value(F.get("sources", F.lit(number))).alias(name) for number, name in enumerate(target)
    ]
    return rows.select("document_id", "row_no", *columns)


def land_block(
    documents: DataFrame,
    rows: DataFrame,
    config: PlatformConfig,
    position: int,
    target: Sequence[str] | None = None,
    blocks: SheetBlocks | None = None,
) -> DataFrame | None:
    """Landing rows of one import, for all documents at once.

    Without ``target`` the columns are those the configuration declares, else the
    first document's header. Where no document has the block there is nothing to land.
    ``blocks`` is what other imports of the same rows have found of their sheets.
    """
    one = config.import_configs[position]
    window = config.window(position)
    cut = ranges.sheet_window(rows, one.sheet, window)
    if ranges.needs_bounds(config, one):
        bounds = (blocks or SheetBlocks(documents, rows, config)).bounds(position)
        if not one.has_header:
            data = _cleaned(ranges.clip(cut, _kept_bounds(bounds, config, one)), config, one)
            return _spread(data, target or one.columns or _neutral(cut, window))
        headers = (
            ranges.relative_header_rows(cut, bounds)
            if one.is_relative
            else ranges.literal_header_rows(cut, window)
        )
    else:
        first, last = (window.first_row, window.last_row) if window is not None else (1, None)
        data = ranges.between_rows(cut, first + one.has_header, last)
        if not one.has_header:
            data = _cleaned(data, config, one, footer_kept=True)
            return _spread(data, target or one.columns or _neutral(cut, window))
        headers = ranges.literal_header_rows(cut, window)
        bounds = data.groupBy("document_id").agg(F.max("row_no").alias("last_row"))
        bounds = bounds.withColumn("first_row", F.lit(first).cast("bigint"))
    names = list(target or one.columns or first_columns(headers, window))
    if not names:
        if not data_rows(cut, one, window).limit(1).count():
            return None
        names = _neutral(cut, window)
    named = ranges.clean_names(headers, window)
    matches = match_columns(named, names).select("document_id", "match")
    facts = _kept_bounds(bounds, config, one).join(matches, "document_id", "left").withColumn(
        "match", F.coalesce("match", in_order(names))
    )
    data = ranges.clip(cut, facts).where("row_no > first_row")
    return project_rows(_cleaned(data, config, one), names)


def data_rows(cut: DataFrame, one: ImportConfig, window: Range | None) -> DataFrame:
    """Rows that may belong to a block, wherever it starts."""
    first = window.first_row if window is not None and not one.is_relative else 1
    return ranges.between_rows(cut, first, None)


def _neutral(cut: DataFrame, window: Range | None) -> list[str]:
    """Neutral names; without a range the widest row decides, one number for the driver."""
    if window is not None:
        return window.column_names
    width = cut.agg(F.max(F.size("vals")).alias("width")).first()["width"] or 1
    return [f"c{n}" for n in range(1, width + 1)]


def _spread(data: DataFrame, names: Sequence[str]) -> DataFrame:
    return data.select("document_id", "row_no", *ranges.spread(list(names)))


def _kept_bounds(bounds: DataFrame, config: PlatformConfig, one: ImportConfig) -> DataFrame:
    """Bounds that end above the footer, where no row below it can have been dropped."""
    if one.footer and not config.uses_row_service:
        return bounds.withColumn("last_row", F.col("last_row") - 1)
    return bounds


def _cleaned(
    data: DataFrame, config: PlatformConfig, one: ImportConfig, footer_kept: bool = False
) -> DataFrame:
    """Rows without formula errors, for the row service, and without the footer."""
    if config.uses_row_service:
        data = ranges.drop_formula_errors(data)
        footer_kept = True
    return ranges.drop_footer(data) if one.footer and footer_kept else data


def land_workbooks(
    documents: DataFrame,
    rows: DataFrame,
    platform: str,
    config: PlatformConfig,
    columns: Columns | None = None,
    blocks: SheetBlocks | None = None,
) -> dict[str, DataFrame]:
    """All landing tables of a platform. Imports of one table are appended in order.

    ``columns`` are those of tables that exist already. A table none of whose blocks
    exists in any document is not created.
    """
    tables: dict[str, DataFrame] = {}
    blocks = blocks or SheetBlocks(documents, rows, config)
    for position, one in enumerate(config.import_configs):
        name = one.table_for(platform)
        known = tables.get(name)
        target = (columns or {}).get(name) if known is None else known.columns[2:]
        block = land_block(documents, rows, config, position, target, blocks)
        if block is None:
            continue
        tables[name] = block if known is None else append(known, block)
    return tables


def land_payloads(
    payloads: DataFrame, platform: str, config: PlatformConfig, columns: Columns | None = None
) -> dict[str, DataFrame]:
    """As :func:`land_workbooks`, for JSON payloads with an ``import_no`` (from 0)."""
    tables: dict[str, DataFrame] = {}
    for position, one in enumerate(config.import_configs):
        name = one.table_for(platform)
        own = payloads.where(F.col("import_no") == position).select("document_id", "body")
        known = tables.get(name)
        target = (columns or {}).get(name) if known is None else known.columns[2:]
        target = target or one.columns or first_payload_columns(own)
        if not target:
            continue
        landed = land_payload_blocks(payload_blocks(own), target, one.footer)
        tables[name] = landed if known is None else append(known, landed)
    return tables


def payload_faults(
    documents: DataFrame,
    payloads: DataFrame,
    platform: str,
    config: PlatformConfig,
    columns: Columns | None = None,
) -> DataFrame:
    """Why documents cannot be landed from their payloads: ``document_id, import_no, reason``.

    Every import needs a payload that is readable and whose columns fit the table;
    ``columns`` are those of tables that exist already.
    """
    found, targets = [], dict(columns or {})
    for position, one in enumerate(config.import_configs):
        own = payloads.where(F.col("import_no") == position).select("document_id", "body")
        name = one.table_for(platform)
        target = targets.get(name) or one.columns or first_payload_columns(own)
        targets[name] = target
        blocks = match_columns(payload_blocks(own), target or [""])
        reason = F.when(F.col("rows").isNull(), "unreadable payload")
        if target:
            reason = reason.when(F.col("match.how") == REJECTED, "columns do not fit")
        status = blocks.select("document_id", F.coalesce(reason, F.lit("")).alias("reason"))
        status = documents.select("document_id").join(status, "document_id", "left")
        status = status.select(
            "document_id", F.lit(position).alias("import_no"), F.coalesce("reason", F.lit("missing payload")).alias("reason")
        )
        found.append(status.where("reason != ''"))
    return reduce(DataFrame.union, found)


def workbook_faults(documents: DataFrame, rows: DataFrame, config: PlatformConfig) -> DataFrame:
    """Why documents cannot be landed from sheet rows; a sheet without any row counts as missing."""
    first = F.col("sheet_no") == 1 if "sheet_no" in rows.columns else F.lit(True)
    wanted = [
        F.max(F.col("sheet") == one.sheet if one.sheet else first).alias(f"has_{k}")
        for k, one in enumerate(config.import_configs)
    ]
    seen = rows.groupBy("document_id").agg(F.lit(True).alias("has_rows"), *wanted)
    status = documents.select("document_id").join(seen, "document_id", "left")
    unread = status.where("has_rows IS NULL").select(
        "document_id", F.lit(None).cast("int").alias("import_no"), F.lit("missing or unreadable workbook").alias("reason")
    )
    lacking = F.array_compact(
        F.array(*(F.when(~F.col(f"has_{k}"), F.lit(k)) for k in range(len(wanted))))
    )
    sheets = status.where("has_rows").select("document_id", F.explode(lacking).alias("import_no"), F.lit("missing sheet").alias("reason"))
    return unread.union(sheets)


def header_rows(rows: DataFrame, config: PlatformConfig, position: int, blocks: SheetBlocks) -> DataFrame:
    """The header row of one import, for every document that has it."""
    one, window = config.import_configs[position], config.window(position)
    cut = ranges.sheet_window(rows, one.sheet, window)
    if not one.is_relative:
        return ranges.literal_header_rows(cut, window)
    return ranges.relative_header_rows(cut, blocks.bounds(position))


def column_faults(
    documents: DataFrame,
    rows: DataFrame,
    platform: str,
    config: PlatformConfig,
    columns: Columns | None = None,
    blocks: SheetBlocks | None = None,
) -> tuple[list[DataFrame], dict[str, list[str]]]:
    """Documents whose headers do not fit their tables, and the tables' columns.

    ``columns`` are those of tables that exist already, which headers do not change. The
    columns found are for :func:`land_workbooks`, which then asks for no header again.
    """
    found, targets = [], {name: list(own) for name, own in (columns or {}).items()}
    blocks = blocks or SheetBlocks(documents, rows, config)
    for position, one in enumerate(config.import_configs):
        if not one.has_header:
            continue
        name, window = one.table_for(platform), config.window(position)
        headers = header_rows(rows, config, position, blocks)
        target = targets.get(name) or list(one.columns) or first_columns(headers, window)
        if not target:
            continue
        targets[name] = target
        matched = match_columns(ranges.clean_names(headers, window), target)
        # generated and not filtered: a filter would move below the names and repeat their expressions
        reasons = F.when(F.col("match.how") == REJECTED, F.array(F.lit("columns do not fit")))
        found.append(matched.select("document_id", F.lit(position).alias("import_no"), F.explode(reasons).alias("reason")))
    return found, targets


def stored_columns(spark: SparkSession, root: str, batch_id: int) -> dict[str, list[str]]:
    """Columns of the landing tables that earlier batches created; a row per table."""
    rows = earlier_batches(spark, root, COLUMNS_TABLE, schemas.LANDING_COLUMNS, batch_id).collect()
    return {row["table_name"]: list(row["columns"]) for row in rows}


def store_columns(
    spark: SparkSession, tables: Mapping[str, DataFrame], known: Columns, root: str, batch_id: int
) -> None:
    """Keep the columns of the tables that this batch created."""
    fresh = [(name, landed.columns[2:]) for name, landed in tables.items() if name not in known]
    write_table(spark.createDataFrame(fresh, schemas.LANDING_COLUMNS), root, COLUMNS_TABLE, batch_id)


def earlier_batches(
    spark: SparkSession, root: str, table: str, schema: str | StructType, batch_id: int
) -> DataFrame:
    """Rows that the batches before this one wrote to a table; none before the first.

    A batch that runs again does not see what it wrote itself.
    """
    kept = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = StructType([*kept.fields]).add("batch_id", "long")
    try:
        rows = spark.read.schema(whole).parquet(f"{root.rstrip('/')}/{table}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kept)
    return rows.where(F.col("batch_id") < batch_id).select(*kept.fieldNames())


def write_table(df: DataFrame, root: str, table: str, batch_id: int) -> str:
    """Write one batch; writing the same batch again replaces it."""
    path = f"{root.rstrip('/')}/{table}"
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
    return path


def stage_rows(scanned: DataFrame) -> DataFrame:
    """Scanned rows by way of a table in the shared folder, partitioned by platform and sheet.

    Workbooks are decoded once, however many imports read them, each import reads the
    files of its own sheet only, and a lost executor costs no second decoding. Rows of
    undecodable workbooks are left out; the join for that is only made where there are any.
    """
    parts = [name for name in ("platform", "sheet") if name in scanned.columns]
    rows = staged(scanned, "sheet_rows", *parts)
    if rows.where(F.col("error").isNotNull()).limit(1).count():
        return readable_rows(rows)
    return rows.drop("error")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")
