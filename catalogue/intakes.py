"""The stream with its real flows: requests joined to the archive, results and rejects published by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.invoices import _INVOICES, _ITEMS, AS_OF, bill_inputs, invoice_documents, statement_documents
from catalogue.registry import query, table
from catalogue.requests import take_in, tenth
from catalogue.scans import order_payloads
from catalogue.settlements import OUTLET
from docsettle.operators.landing import read_table
from docsettle.plans.archive import Archive, Books, archive_flows
from docsettle.plans.platforms import shipped_platforms
from docsettle.session import shared_dir

#: A document's requests, the part of the log each comes in, and the first of these parts.
_LOG = """
    WITH log AS (
      SELECT CASE event_id % 4 WHEN 0 THEN 'payout' WHEN 1 THEN 'bill' ELSE 'statement' END AS kind,
             user_id % 50 + 50 * ((day(ts) - 1 + event_id % 11) // 10) AS id, least(2, (day(ts) - 1) // 10) AS part
      FROM events WHERE event_id % 4 < 3),
    asked AS (SELECT kind, id, min(part) AS part, max(part) AS last FROM log GROUP BY kind, id)
    """


def _run(spark: SparkSession, sf_dir: str, *kinds: str) -> str:
    """The intake over the event log's requests of some kinds; the folder of its tables.

    Some entity lists and payloads are unreadable or missing, some documents are of no known platform or unknown.
    """
    number, stamp = F.col("event_id"), F.col("ts")
    kind = F.when(number % 4 == 0, "payout").when(number % 4 == 1, "bill").when(number % 4 == 2, "statement")
    key = F.col("user_id") % 50 + 50 * F.floor((F.dayofmonth("ts") - 1 + number % 11) / 10)
    log = table(spark, sf_dir, "events").select(
        kind.alias("kind"),
        F.concat(F.lit("http://h/documents/"), key.cast("string"), F.lit("/")).alias("doc_url"),
        stamp.alias("received_at"),
        tenth(stamp).alias("part"),
    )
    orders, document = table(spark, sf_dir, "orders"), F.col("document_id")
    payloads = order_payloads(orders).where(document % 11 != 6)
    payloads = payloads.withColumn("body", F.when(document % 11 == 5, F.lit('{"data": 5}')).otherwise(F.col("body")))
    sheets = orders.select(F.expr("o_orderkey div 32").alias("document_id")).distinct()
    tag = F.when(document % 3 == 2, 61).otherwise(60)
    tags = sheets.select(tag.alias("id"), F.when(document % 3 == 2, "paper").otherwise("zomato").alias("name")).distinct()
    sheets = sheets.select(
        "document_id",
        F.lit("").alias("file_name"),
        F.concat(F.lit("2024/f"), document.cast("string"), F.lit(".xlsx")).alias("media_filename"),
        F.array(tag).alias("tags"),
    )
    contacts, correspondents, fields = bill_inputs(spark, sf_dir)
    supplier = F.col("s_suppkey")
    accounts = table(spark, sf_dir, "supplier").select(
        supplier.alias("id"),
        F.concat(F.lit("BANK "), (supplier % 10).cast("string")).alias("name"),
        F.lit("bank").alias("type"),
    )
    books = Books(contacts, accounts, correspondents, fields, tags)
    root = shared_dir(spark, "intake")
    platforms = {"zomato": shipped_platforms(2024)["zomato"]}
    flows = {}
    if "payout" in kinds:
        archive = Archive(sheets, sheets.limit(0), None, payloads)
        flows["payout"] = archive_flows(archive, books, platforms, root, OUTLET, AS_OF)["payout"]
    if "bill" in kinds:
        invoices = invoice_documents(spark, sf_dir)
        scanned = F.when(document % 17 == 3, F.lit("no list")).otherwise(F.col("raw_ocr_data"))
        scans = invoices.select("document_id", "text", scanned.alias("raw_ocr_data"))
        archive = Archive(invoices.select("document_id", "file_name"), scans)
        flows["bill"] = archive_flows(archive, books, platforms, root, OUTLET, AS_OF)["bill"]
    if "statement" in kinds:
        scans = statement_documents(spark, sf_dir).select("document_id", "text", "raw_ocr_data")
        flows["statement"] = archive_flows(Archive(scans, scans), books, platforms, root, OUTLET, AS_OF)["statement"]
    take_in(log.where(F.col("kind").isin(*kinds)), root, flows)
    return root


def _published(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, root, name).withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query(
    "intake_bills",
    _LOG
    + ","
    + _INVOICES.replace("WITH p", "p", 1)
    + """,
    v AS (SELECT r.*, part, CASE WHEN supplier = '' THEN 'Unknown Vendor' ELSE supplier END AS vendor,
                 CASE WHEN regexp_full_match(total_amount, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)')
                      THEN CAST(trunc(CAST(total_amount AS DOUBLE) * 100) AS BIGINT) ELSE 0 END AS amount
          FROM r JOIN asked ON kind = 'bill' AND id = o_orderkey WHERE o_orderkey % 17 <> 3),
    known AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'vendor ' ELSE 'other ' END || c_custkey AS k,
                     c_custkey AS id FROM customer),
    begun AS (SELECT lower(vendor) AS k, min(part) AS part FROM v GROUP BY 1),
    fresh AS (SELECT begun.k, (SELECT max(id) FROM known)
                     + row_number() OVER (ORDER BY begun.part, md5(begun.k), begun.k) AS id
              FROM begun LEFT JOIN known USING (k) WHERE known.id IS NULL)
    SELECT o_orderkey AS document_id, coalesce(known.id, fresh.id) AS contact_id,
           invoice_id AS bill_number, invoice_date AS issue_date,
           strftime(CAST(invoice_date AS DATE) + INTERVAL 30 DAY, '%Y-%m-%d') AS due_date,
           amount, 'draft' AS status, 'http://h/documents/' || o_orderkey || '/' AS file_url,
           'Auto-created from archive document #' || o_orderkey || ' (scan' || o_orderkey || '.pdf)' AS notes,
           CAST(part AS BIGINT) AS batch_id
    FROM v LEFT JOIN known ON known.k = lower(vendor) LEFT JOIN fresh ON fresh.k = lower(vendor)
    WHERE amount > 0
    """,
)
def intake_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills that the stream publishes, each in its document's first batch; vendors of one batch are known to the next."""
    return _published(spark, _run(spark, sf_dir, "bill"), "bills")


@query(
    "intake_transactions",
    _LOG
    + ","
    + _ITEMS.replace("WITH e", "e", 1)
    + """,
    u AS (SELECT t.*, part, CASE WHEN document_id % 3 = 0 THEN 'Bank' ELSE 'Bank ' || (document_id % 20) END AS bank
          FROM t JOIN asked ON asked.kind = 'statement' AND id = document_id),
    dim AS (SELECT s_suppkey AS id, 'bank ' || (s_suppkey % 10) AS k FROM supplier),
    known AS (SELECT k, min(id) AS id FROM dim GROUP BY k),
    begun AS (SELECT lower(bank) AS k, min(part) AS part FROM u GROUP BY 1),
    fresh AS (SELECT begun.k, (SELECT max(id) FROM dim)
                     + row_number() OVER (ORDER BY begun.part, md5(begun.k), begun.k) AS id
              FROM begun LEFT JOIN known USING (k) WHERE known.id IS NULL)
    SELECT document_id, item_no, coalesce(known.id, fresh.id) AS account_id,
           CASE WHEN type = 'credit' THEN 'income' ELSE 'expense' END AS type,
           coalesce(TRY_CAST(amount AS DOUBLE), 0) AS amount,
           coalesce(NULLIF(date, ''), '2024-06-30') AS transaction_date,
           coalesce(description, '') AS description, CAST(u.part AS BIGINT) AS batch_id
    FROM u LEFT JOIN known ON known.k = lower(bank) LEFT JOIN fresh ON fresh.k = lower(bank)
    """,
)
def intake_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, _run(spark, sf_dir, "statement"), "transactions")


@query(
    "intake_settlements",
    _LOG
    + """,
    t AS (SELECT o_orderkey // 32 AS d, strftime(o_orderdate, '%Y-%m-%d') AS day, * FROM orders)
    SELECT d AS document_id, 'Main Outlet' AS outlet_name, 'zomato' AS platform,
           min(day) AS period_start, max(day) AS period_end, max(day) AS settlement_date,
           count(*) AS total_orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS gross_sales_amt,
           0::DOUBLE AS restaurant_discount_amt, CAST(sum(o_custkey) AS DOUBLE) AS platform_commission_amt,
           0::DOUBLE AS taxes_tcs_tds_amt, -count(*)::DOUBLE AS marketing_ads_amt,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE - count(*) AS final_payout_amt, 'UTR' || CAST(d AS VARCHAR) AS utr_number,
           CAST(min(part) AS BIGINT) AS batch_id
    FROM t JOIN asked ON kind = 'payout' AND id = d
    WHERE d % 3 < 2 AND d % 11 NOT IN (5, 6) GROUP BY d
    """,
)
def intake_settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, _run(spark, sf_dir, "payout"), "settlements")


@query(
    "intake_rejects",
    _LOG
    + """,
    sheets AS (SELECT DISTINCT o_orderkey // 32 AS id FROM orders),
    bad AS (
      SELECT *, NULL::INTEGER AS import_no, 'unreadable entities' AS reason FROM asked
      WHERE kind = 'bill' AND id % 17 = 3 AND id IN (SELECT o_orderkey FROM orders)
      UNION ALL
      SELECT *, NULL, 'unknown document' FROM asked
      WHERE (kind = 'bill' AND id NOT IN (SELECT o_orderkey FROM orders))
         OR (kind = 'statement' AND id NOT IN (SELECT event_id // 64 FROM events))
         OR (kind = 'payout' AND id NOT IN (SELECT id FROM sheets))
      UNION ALL
      SELECT *, CASE WHEN id % 3 < 2 THEN 0 END,
             CASE WHEN id % 3 = 2 THEN 'no workbook of a known platform'
                  WHEN id % 11 = 5 THEN 'unreadable payload' ELSE 'missing payload' END
      FROM asked WHERE kind = 'payout' AND (id % 3 = 2 OR id % 11 IN (5, 6)) AND id IN (SELECT id FROM sheets))
    SELECT kind, id AS document_id, import_no, reason, CAST(part AS BIGINT) AS batch_id FROM bad
    UNION ALL
    SELECT kind, id, import_no, reason, 2 FROM bad WHERE part < 2 AND last = 2
    """,
)
def intake_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a flow could not process are open again after the restart, and rejected once more if asked for."""
    rejects = _published(spark, _run(spark, sf_dir, "payout", "bill", "statement"), "rejects")
    return rejects.select("kind", "document_id", "import_no", "reason", "batch_id")
