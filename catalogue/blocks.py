"""Block queries: slices, headers, empty rows, relative ranges and footers.

Every 64 consecutive events make up one sheet, so row numbers follow from the data.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query, table
from docsettle.functions.scalars import clean_name
from docsettle.operators import landing, ranges
from docsettle.operators.blocks import SheetBlocks
from docsettle.sources.config import ImportConfig, PlatformConfig, RelativeRange
from docsettle.sources.ranges import Range

SHEET = "Events"


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their sheet's ``document_id`` and their place ``pos`` on it."""
    return table(spark, sf_dir, "events").select(
        F.expr("event_id div 64").alias("document_id"),
        (F.col("event_id") % 64).alias("pos"),
        "event_id",
        "user_id",
        "event_type",
        F.col("value").cast("string").alias("amount"),
        "props",
    )


def sheet(events: DataFrame, first_row: int, values: list[Column]) -> DataFrame:
    return events.select(
        "document_id",
        F.lit(SHEET).alias("sheet"),
        (F.col("pos") + first_row).alias("row_no"),
        F.array(*values).alias("vals"),
    )


def documents_of(rows: DataFrame) -> DataFrame:
    return rows.select("document_id").distinct()


@query(
    "range_slice",
    """
    SELECT event_id // 64 AS document_id, 5 + event_id % 64 AS row_no,
           CAST(value AS VARCHAR) AS c1, props AS c2
    FROM events WHERE 5 + event_id % 64 BETWEEN 10 AND 40
    """,
)
def range_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.col("event_type"), F.col("amount"), F.col("props"), F.col("user_id").cast("string")]
    rows = sheet(event_rows(spark, sf_dir), 5, columns)
    return ranges.slice_range(rows, SHEET, Range.parse("B10:C40"))


@query(
    "range_open_slice",
    """
    SELECT event_id // 64 AS document_id, 5 + event_id % 64 AS row_no, event_type AS c1,
           CAST(value AS VARCHAR) AS c2, props AS c3, CAST(NULL AS VARCHAR) AS c4
    FROM events WHERE 5 + event_id % 64 >= 20
    """,
)
def range_open_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From long cells, open towards the bottom, one column wider than the sheet."""
    cells = event_rows(spark, sf_dir).select(
        "document_id",
        F.lit(SHEET).alias("sheet"),
        (F.col("pos") + 5).alias("row_no"),
        F.posexplode(F.array("event_type", "amount", "props")).alias("pos", "value"),
    )
    cells = cells.withColumn("col_no", F.col("pos") + 1).drop("pos")
    return ranges.slice_range(ranges.assemble_rows(cells), SHEET, Range.parse("A20:D"))


def customer_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 customers to a sheet, header in row 3, with differing headers by sheet."""
    kind = F.expr("(c_custkey div 50) % 5")
    name, segment, balance = F.col("c_name"), F.col("c_mktsegment"), F.col("c_acctbal").cast("string")
    swapped = kind == 3
    header = (
        F.when(swapped, F.array(*map(F.lit, ["x", "Account\nbalance", " Customer", "Segment\r"])))
        .when(kind == 4, F.array(*map(F.lit, ["x", "Name", "Market", "Money"])))
        .otherwise(F.array(*map(F.lit, ["x", "Customer", "Segment", "Account balance"])))
    )
    values = F.when(swapped, F.array(F.lit(None), balance, name, segment)).otherwise(
        F.array(F.lit(None), name, segment, balance)
    )
    place = F.col("c_custkey") % 50
    data = F.struct((place + 4).alias("row_no"), values.alias("vals"))
    top = F.struct(F.lit(3).cast("bigint").alias("row_no"), header.alias("vals"))
    rows = F.when(place == 0, F.array(top, data)).otherwise(F.array(data))
    return table(spark, sf_dir, "customer").select(
        F.expr("c_custkey div 50").alias("document_id"),
        F.lit("Customers").alias("sheet"),
        F.inline(rows),
    )


@query(
    "header_promote",
    """
    SELECT c_custkey // 50 AS document_id, 4 + c_custkey % 50 AS row_no, c_name AS customer,
           c_mktsegment AS segment, CAST(c_acctbal AS VARCHAR) AS balance
    FROM customer
    """,
)
def header_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_sheets(spark, sf_dir)
    config = PlatformConfig("", (ImportConfig("customers", "Customers", "B3:D", header=True),))
    landed = landing.land_block(documents_of(rows), rows, config, 0)
    return landed.select(
        "document_id",
        "row_no",
        F.col("Customer").alias("customer"),
        F.col("Segment").alias("segment"),
        F.col("Account balance").alias("balance"),
    )


@query(
    "stop_at_empty",
    """
    WITH t AS (SELECT event_id // 64 AS d, event_id % 64 AS pos, * FROM events),
         s AS (SELECT d, min(CASE WHEN event_type = 'error' THEN pos END) AS stop
               FROM t GROUP BY d)
    SELECT t.d AS document_id, count(*) AS kept, max(5 + pos) AS last_row,
           round(sum(value), 4) AS total
    FROM t JOIN s ON t.d = s.d WHERE stop IS NULL OR pos < stop GROUP BY t.d
    """,
)
def stop_at_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.col("event_type") == "error"
    columns = [
        F.when(~blank, F.col("event_type")).otherwise(" "),
        F.when(~blank, F.col("amount")).otherwise(""),
        F.when(~blank, F.col("props")),
    ]
    rows = sheet(event_rows(spark, sf_dir), 5, columns)
    config = PlatformConfig(
        "", (ImportConfig("events", SHEET, "A5:C", header=False, stop_at_empty=True),)
    )
    landed = landing.land_block(documents_of(rows), rows, config, 0)
    return landed.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("kept"),
        F.max("row_no").alias("last_row"),
        F.round(F.sum(F.col("c2").cast("double")), 4).alias("total"),
    )


STACKED = PlatformConfig(
    "",
    (
        ImportConfig("unused", "Other", "A1:B", header=True, stop_at_empty=True),
        ImportConfig("charges", SHEET, "A5:C", header=True, stop_at_empty=True),
        ImportConfig(
            "charges",
            SHEET,
            relative_range=RelativeRange(relative_config_index=1, rows_offset=3),
            header=True,
            stop_at_empty=True,
        ),
    ),
)


def stacked_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two blocks on one sheet, the first with a length that differs by document."""
    first_length = F.col("document_id") % 11
    pos = F.col("pos")
    in_first = pos < first_length
    row_no = F.when(in_first, 6 + pos).otherwise(9 + pos)
    data = F.struct(row_no.alias("row_no"), F.array("event_type", "amount", "props").alias("vals"))
    header = F.array(*map(F.lit, ["Kind", "Amount", "Details"]))
    tops = F.array(
        F.struct(F.lit(5).cast("bigint").alias("row_no"), header.alias("vals")),
        F.struct((8 + first_length).alias("row_no"), header.alias("vals")),
    )
    rows = F.when(pos == 0, F.concat(tops, F.array(data))).otherwise(F.array(data))
    return event_rows(spark, sf_dir).select(
        "document_id", F.lit(SHEET).alias("sheet"), F.inline(rows)
    )


@query(
    "relative_range",
    """
    WITH t AS (SELECT event_id // 64 AS d, event_id % 64 AS pos, * FROM events)
    SELECT d AS document_id, CASE WHEN pos < d % 11 THEN 6 + pos ELSE 9 + pos END AS row_no,
           event_type AS kind, CAST(value AS VARCHAR) AS amount, props AS details
    FROM t
    """,
)
def relative_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stacked_sheets(spark, sf_dir)
    documents = documents_of(rows)
    found = SheetBlocks(documents, rows, STACKED)
    first = landing.land_block(documents, rows, STACKED, 1, ["Kind", "Amount", "Details"], found)
    second = landing.land_block(documents, rows, STACKED, 2, first.columns[2:], found)
    return landing.append(first, second).select(
        "document_id",
        "row_no",
        F.col("Kind").alias("kind"),
        F.col("Amount").alias("amount"),
        F.col("Details").alias("details"),
    )


@query(
    "range_end",
    """
    WITH t AS (SELECT DISTINCT event_id // 64 AS d FROM events),
         n AS (SELECT event_id // 64 AS d, count(*) AS n FROM events GROUP BY 1)
    SELECT t.d AS document_id, 5 AS first_row, 5 + least(d % 11, n) AS last_row,
           5 + least(d % 11, n) AS end_row
    FROM t JOIN n USING (d)
    """,
)
def range_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stacked_sheets(spark, sf_dir)
    documents = documents_of(rows)
    found = SheetBlocks(documents, rows, STACKED)
    bounds, ends = found.bounds(1), found.ends(1)
    return bounds.join(ends, "document_id").select(
        "document_id", F.col("first_row").cast("int"), "last_row", "end_row"
    )


@query(
    "footer_drop",
    """
    WITH t AS (SELECT event_id // 64 AS d, event_id % 64 AS pos, * FROM events)
    SELECT d AS document_id, pos + 5 AS row_no, event_type AS c1, CAST(value AS VARCHAR) AS c2
    FROM (SELECT *, max(pos) OVER (PARTITION BY d) AS footer FROM t) WHERE pos < footer
    """,
)
def footer_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sheet(event_rows(spark, sf_dir), 5, [F.col("event_type"), F.col("amount")])
    config = PlatformConfig("", (ImportConfig("events", SHEET, "A5:B", header=False, footer=True),))
    return landing.land_block(documents_of(rows), rows, config, 0)


@query(
    "ref_rows_filter",
    """
    SELECT event_id // 64 AS document_id, 5 + event_id % 64 AS row_no, event_type AS c1,
           CASE WHEN event_id % 11 = 0 THEN 'see #REF!' ELSE props END AS c2
    FROM events WHERE event_id % 7 <> 0
    """,
)
def ref_rows_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.when(F.col("event_id") % 7 == 0, "#REF!")
    details = broken.when(F.col("event_id") % 11 == 0, "see #REF!").otherwise(F.col("props"))
    rows = sheet(event_rows(spark, sf_dir), 5, [F.col("event_type"), details])
    config = PlatformConfig(
        "libreoffice", (ImportConfig("events", SHEET, "A5:B", header=False),)
    )
    return landing.land_block(documents_of(rows), rows, config, 0)


@query(
    "column_sanitize",
    """
    SELECT p_partkey AS part, trim(replace(replace(name, chr(10), ' '), chr(13), ' '),
                                   ' ' || chr(9) || chr(160)) AS name
    FROM (SELECT p_partkey,
                 CASE p_partkey % 3 WHEN 0 THEN chr(10) || replace(p_name, ' ', chr(10)) || chr(9)
                      WHEN 1 THEN replace(p_name, ' ', chr(13) || chr(10)) || chr(160)
                      ELSE '  ' || p_name || ' ' || chr(13) END AS name
          FROM part)
    """,
)
def column_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, name = F.col("p_partkey") % 3, F.col("p_name")
    broken = (
        F.when(kind == 0, F.concat(F.lit("\n"), F.replace(name, F.lit(" "), F.lit("\n")), F.lit("\t")))
        .when(kind == 1, F.concat(F.replace(name, F.lit(" "), F.lit("\r\n")), F.lit("\u00a0")))
        .otherwise(F.concat(F.lit("  "), name, F.lit(" \r")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"), clean_name(broken).alias("name")
    )


@query(
    "landing_append",
    """
    SELECT o_orderkey AS document_id, 1 AS row_no,
           CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS p,
           CAST(o_custkey AS VARCHAR) AS q
    FROM orders
    """,
)
def landing_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("document_id"),
        F.lit(1).alias("row_no"),
        F.col("o_orderpriority").alias("p"),
        F.col("o_custkey").cast("string").alias("q"),
        "o_orderstatus",
    )

    def batch(status: str) -> DataFrame:
        return orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus")

    target = batch("F")
    subset = batch("O").select("document_id", "row_no", "q")
    renamed = batch("P").withColumnRenamed("q", "zz")
    return landing.append(landing.append(target, subset), renamed)


@query(
    "service_relative_range",
    """
    WITH t AS (SELECT event_id // 64 AS d, event_id % 64 AS pos, * FROM events),
         n AS (SELECT d, count(*) FILTER (pos < d % 11 AND event_id % 97 = 0) AS errors FROM t GROUP BY d)
    SELECT d AS document_id, CASE WHEN pos < d % 11 THEN 6 + pos ELSE 9 + pos END AS row_no,
           event_type AS kind, CAST(value AS VARCHAR) AS amount, props AS details
    FROM t JOIN n USING (d) WHERE event_id % 97 <> 0 AND (pos < d % 11 OR errors = 0)
    """,
)
def service_relative_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a service prepares the rows, the next block is counted from the rows it gave.

    A row with a formula error is not among them, so the block below is looked for too far up: at an empty row.
    """
    rows = stacked_sheets(spark, sf_dir)
    own = F.array(F.lit("#REF!"), F.get("vals", F.lit(1)), F.get("vals", F.lit(2)))
    event = F.col("document_id") * 64 + F.col("row_no") - F.when(F.col("row_no") < 6 + F.col("document_id") % 11, 6).otherwise(9)
    data = ~F.get("vals", F.lit(0)).isin("Kind")
    rows = rows.withColumn("vals", F.when(data & (event % 97 == 0), own).otherwise(F.col("vals")))
    documents = documents_of(rows)
    config = replace(STACKED, method="libreoffice")
    names, found = ["Kind", "Amount", "Details"], SheetBlocks(documents, rows, config)
    first, second = (landing.land_block(documents, rows, config, k, names, found) for k in (1, 2))
    return landing.append(first, second).select(
        "document_id",
        "row_no",
        F.col("Kind").alias("kind"),
        F.col("Amount").alias("amount"),
        F.col("Details").alias("details"),
    )


@query(
    "default_table_names",
    """
    SELECT 'payout_web_Events_A5_B' AS table_name, event_id // 64 AS document_id, count(*) AS rows FROM events GROUP BY 2
    UNION ALL
    SELECT 'payout_web__', event_id // 64, count(*) - 1 FROM events GROUP BY 2 HAVING count(*) > 1
    """,
)
def default_table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imports without a table name land in one named after platform, sheet and range."""
    rows = sheet(event_rows(spark, sf_dir), 5, [F.col("event_type"), F.col("amount")])
    whole = rows.withColumn("row_no", F.col("row_no") - 4)
    rows = rows.withColumn("sheet_no", F.lit(2)).union(whole.select("document_id", F.lit("First").alias("sheet"), "row_no", "vals", F.lit(1)))
    config = PlatformConfig("", (ImportConfig(sheet=SHEET, range="A5:B", header=False), ImportConfig(columns=("c1", "c2"))))
    landed = landing.land_workbooks(documents_of(rows), rows, "Web", config)
    counts = [t.groupBy(F.lit(name).alias("table_name"), "document_id").agg(F.count("*").alias("rows")) for name, t in landed.items()]
    return reduce(DataFrame.union, counts)
