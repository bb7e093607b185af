"""State that batches leave for later ones: dimension entries, landing columns, rejects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.dimensions import _VENDORS, vendor_inputs
from catalogue.registry import query, table
from catalogue.settlements import OUTLET
from docsettle.operators import dims, landing
from docsettle.plans.payouts import run_payouts
from docsettle.session import shared_dir, staged
from docsettle.sources.config import ImportConfig, PlatformConfig

#: Each batch in turn, the second one twice: running it again must change nothing.
ORDER = (0, 1, 1, 2)


@query(
    "vendors_over_batches",
    _VENDORS
    + """,
         b AS (SELECT o_orderkey AS d,
                      CASE WHEN o_orderkey % 2 = 0 THEN least(o_custkey % 4, 2) ELSE 2 END AS batch_id
               FROM orders),
         begun AS (SELECT lower(name) AS k, min(batch_id) AS first FROM w JOIN b USING (d) GROUP BY 1),
         made AS (SELECT begun.k, (SELECT max(id) FROM dim)
                         + row_number() OVER (ORDER BY first, md5(begun.k), begun.k) AS id
                  FROM begun LEFT JOIN known USING (k) WHERE known.id IS NULL)
    SELECT d AS document_id, coalesce(known.id, made.id) AS contact_id, batch_id
    FROM w JOIN b USING (d)
    LEFT JOIN known ON known.k = lower(w.name) LEFT JOIN made ON made.k = lower(w.name)
    """,
)
def vendors_over_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors that one batch creates are found by the next ones."""
    bills, contacts = vendor_inputs(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    early = F.least(F.col("o_custkey") % 4, F.lit(2))
    number = F.when(F.col("o_orderkey") % 2 == 0, early).otherwise(2)
    batches = orders.select(F.col("o_orderkey").alias("document_id"), number.alias("number"))
    bills = staged(bills.join(batches, "document_id"), "bills", "number")
    root = shared_dir(spark, "batches")
    for batch_id in ORDER:
        own = bills.where(F.col("number") == batch_id).drop("number")
        found = dims.get_or_create_vendors(own, dims.known_entries(contacts, root, "contacts", batch_id))
        landing.write_table(found.rows.select("document_id", "contact_id"), root, "resolved", batch_id)
        landing.write_table(found.created, root, "contacts", batch_id)
    resolved = landing.read_table(spark, root, "resolved")
    return resolved.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def _payouts_over_batches(spark: SparkSession, sf_dir: str) -> str:
    """Sheets of ten customers each, landed in three batches; the folder of the tables.

    A sheet's header has the first one's names, some of them in another order, as many other
    names, or too few other names. Some documents have no sheet rows at all.
    """
    key = F.col("c_custkey")
    number, place = F.expr("c_custkey div 10"), key % 10
    kind, batch = (number + F.expr("c_custkey div 40")) % 4, F.expr("c_custkey div 40") % 3
    name, segment, nation = F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    headers = [["name", "segment", "nation"], ["segment", "name"], ["x", "y", "z"], ["p", "q"]]
    values = [[name, segment, nation], [segment, name], [name, segment, nation], [name, segment]]

    def of_kind(options: list[list]):
        return F.get(F.array(*(F.array(*one) for one in options)), kind.cast("int"))

    def line(row_no, vals):
        return F.struct(row_no.cast("bigint").alias("row_no"), vals.alias("vals"))

    data = line(place + 2, of_kind(values))
    top = line(F.lit(1), of_kind([[F.lit(text) for text in one] for one in headers]))
    lines = F.when(place == 0, F.array(top, data)).otherwise(F.array(data))
    customers = table(spark, sf_dir, "customer")
    rows = customers.where(number % 7 != 6).select(
        number.alias("document_id"), F.lit("People").alias("sheet"), batch.alias("number"), F.inline(lines)
    )
    rows = staged(rows, "sheet_rows", "number")
    documents = customers.select(
        number.alias("document_id"),
        F.concat(F.lit("2024/f"), number.cast("string"), F.lit(".xlsx")).alias("media_filename"),
        F.array(F.lit(1)).alias("tags"),
        batch.alias("number"),
    ).distinct()
    tags = customers.select(F.lit(1).alias("id"), F.lit("people").alias("name")).distinct()
    config = PlatformConfig("", (ImportConfig("people", "People", stop_at_empty=False),))
    stamp = F.lit("2024-06-30 12:00:00").cast("timestamp_ntz")
    root = shared_dir(spark, "batches")
    for batch_id in ORDER:
        own, sheet = (frame.where(F.col("number") == batch_id).drop("number") for frame in (documents, rows))
        known = landing.stored_columns(spark, root, batch_id)
        found = run_payouts(own, tags, {"people": config}, sheet, None, OUTLET, stamp, columns=known)
        outputs = {
            **found.landings,
            "rejects": found.rejects,
            "settlements": found.settlements.select("document_id"),
            "ledger": found.ledger.select("document_id"),
        }
        for output, result in outputs.items():
            landing.write_table(result, root, output, batch_id)
        landing.store_columns(spark, found.landings, known, root, batch_id)
    return root


_PEOPLE = """
    WITH t AS (SELECT c_custkey // 10 AS d, (c_custkey // 10 + c_custkey // 40) % 4 AS kind,
                      c_custkey // 40 % 3 AS batch_id, * FROM customer)
    """


@query(
    "landing_over_batches",
    _PEOPLE
    + """
    SELECT d AS document_id, 2 + c_custkey % 10 AS row_no, c_name AS name, c_mktsegment AS segment,
           CASE WHEN kind <> 1 THEN CAST(c_nationkey AS VARCHAR) END AS nation, batch_id
    FROM t WHERE kind < 3 AND d % 7 <> 6
    """,
)
def landing_over_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch lands in the columns that the first one gave the table."""
    landed = landing.read_table(spark, _payouts_over_batches(spark, sf_dir), "people")
    return landed.withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query(
    "payout_rejects",
    _PEOPLE
    + """
    SELECT DISTINCT 'rejects' AS output, d AS document_id, batch_id,
           CASE WHEN d % 7 <> 6 THEN 0 END AS import_no,
           CASE WHEN d % 7 = 6 THEN 'missing or unreadable workbook' ELSE 'columns do not fit' END AS reason
    FROM t WHERE kind = 3 OR d % 7 = 6
    UNION ALL
    SELECT DISTINCT output, d, batch_id, NULL, NULL
    FROM t, (SELECT unnest(['settlements', 'ledger']) AS output) WHERE kind < 3 AND d % 7 <> 6
    """,
)
def payout_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is either rejected with a reason or settled and in the ledger."""
    root = _payouts_over_batches(spark, sf_dir)
    outputs = []
    for output in ("rejects", "settlements", "ledger"):
        rows = landing.read_table(spark, root, output).withColumn("output", F.lit(output))
        if output != "rejects":
            rows = rows.withColumns({"import_no": F.lit(None).cast("int"), "reason": F.lit(None).cast("string")})
        outputs.append(rows.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    return reduce(DataFrame.unionByName, outputs).select("output", "document_id", "batch_id", "import_no", "reason")
