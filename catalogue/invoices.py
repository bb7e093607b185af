"""Entity queries: invoices to bills and updates, statements to transactions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query, table
from docsettle.functions import scalars
from docsettle.operators import entities
from docsettle.plans.bills import run_bills
from docsettle.plans.statements import run_statements

AS_OF = dt.date(2024, 6, 30)


def entity(kind, mention=None, normalized=None, anchor=None) -> Column:
    """One entity; ``normalized`` is a text column or None for no normalized value."""

    def text(value) -> Column:
        if value is None:
            return F.lit(None).cast("string")
        return (F.lit(value) if isinstance(value, str) else value).cast("string")

    def holder(value, field: str) -> Column:
        inner = F.struct(text(value).alias(field))
        return F.when(F.lit(value is not None), inner)

    return F.struct(
        text(kind).alias("type"),
        text(mention).alias("mention_text"),
        holder(normalized, "text").alias("normalized_value"),
        holder(anchor, "content").alias("text_anchor"),
    )


def invoice_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as scanned invoices with their entity list as JSON text.

    Every tenth order has its supplier twice; totals come in all the forms amounts take.
    """
    number, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    vendor = F.concat(F.lit("Vendor "), F.col("o_custkey").cast("string"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    whole = F.substring_index(price, ".", 1)
    kind = number % 7
    normalized = (
        F.when(kind == 0, whole)
        .when(kind == 1, F.concat(whole, F.lit(".5")))
        .when(kind == 2, F.concat(price, F.lit("99")))
        .when(kind == 3, F.concat(F.lit("1."), price))
        .when(kind == 4, F.lit(""))
        .otherwise(price)
    )
    plain_total = entity("total_amount", F.concat(F.lit("$"), price))
    empty_mention = entity("invoice_date", "", None, day)
    parts = F.array(
        F.when(number % 3 == 0, empty_mention).otherwise(entity("invoice_date", day)),
        F.when(kind == 6, plain_total).otherwise(
            entity("total_amount", F.concat(F.lit("$"), price), normalized)
        ),
        entity("supplier_name", F.when(number % 11 != 0, vendor).otherwise("")),
        entity("invoice_id", F.concat(F.lit("INV-"), number.cast("string"))),
        entity("currency", "$", "USD"),
    )
    twice = F.array(entity("supplier_name", F.concat(vendor, F.lit(" Ltd"))))
    listed = F.when(number % 10 == 0, F.concat(parts, twice)).otherwise(parts)
    return table(spark, sf_dir, "orders").select(
        number.alias("document_id"),
        F.concat(F.lit("scan"), number.cast("string"), F.lit(".pdf")).alias("file_name"),
        F.concat(F.lit("http://h/documents/"), number.cast("string"), F.lit("/")).alias("doc_url"),
        F.when(number % 4 == 0, "").otherwise(F.col("o_orderpriority")).alias("text"),
        F.to_json(listed).alias("raw_ocr_data"),
    )


_INVOICES = """
    WITH p AS (SELECT *, CAST(o_totalprice AS VARCHAR) AS price FROM orders),
    q AS (SELECT *, split_part(price, '.', 1) AS whole FROM p),
    r AS (SELECT *, CASE o_orderkey % 7 WHEN 0 THEN whole || '.00' WHEN 1 THEN whole || '.50'
                         WHEN 2 THEN whole || '.' || left(split_part(price, '.', 2) || '99', 2)
                         WHEN 3 THEN '1.' || price WHEN 4 THEN '.00'
                         WHEN 5 THEN whole || '.' || rpad(split_part(price, '.', 2), 2, '0')
                         ELSE '$' || whole || '.' || rpad(split_part(price, '.', 2), 2, '0')
                    END AS total_amount,
                 strftime(o_orderdate, '%Y-%m-%d') AS invoice_date,
                 CASE WHEN o_orderkey % 10 = 0 THEN 'Vendor ' || o_custkey || ' Ltd'
                      WHEN o_orderkey % 11 = 0 THEN ''
                      ELSE 'Vendor ' || o_custkey END AS supplier,
                 'INV-' || o_orderkey AS invoice_id
          FROM q)
    """


@query(
    "invoice_fields",
    _INVOICES
    + """
    SELECT o_orderkey AS document_id, invoice_date, total_amount, supplier, invoice_id,
           '$' AS currency, 5 AS types FROM r
    """,
)
def invoice_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = entities.decode_entities(invoice_documents(spark, sf_dir))
    return entities.extract_invoices(documents).select(
        "document_id",
        "invoice_date",
        "total_amount",
        "supplier",
        F.col("fields")["invoice_id"].alias("invoice_id"),
        F.col("fields")["currency"].alias("currency"),
        F.size("fields").alias("types"),
    )


def bill_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Contacts, correspondents and custom fields, as made from customers and regions.

    Every second customer has a name no invoice bears.
    """
    customers, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    prefix = F.when(key % 2 == 0, "VENDOR ").otherwise("Other ")
    name = F.concat(prefix, key.cast("string"))
    contacts = customers.select(key.alias("id"), name.alias("name"), F.lit("vendor").alias("type"))
    correspondents = customers.select((key + 7).alias("id"), name.alias("name"))
    names = ["Invoice Date", "Total", "Invoice Number", "Currency", "Net Amount"]
    listed = F.array(*map(F.lit, names))
    fields = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.get(listed, F.col("r_regionkey")).alias("name")
    )
    return contacts, correspondents, fields


_BILLS = (
    _INVOICES
    + """,
    v AS (SELECT *, CASE WHEN supplier = '' THEN 'Unknown Vendor' ELSE supplier END AS vendor,
                 CASE WHEN regexp_full_match(total_amount, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)')
                      THEN CAST(trunc(CAST(total_amount AS DOUBLE) * 100) AS BIGINT)
                      ELSE 0 END AS amount
          FROM r),
    known AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'vendor ' ELSE 'other ' END || c_custkey AS k,
                     c_custkey AS id FROM customer),
    keys AS (SELECT DISTINCT lower(vendor) AS k FROM v),
    fresh AS (SELECT keys.k, (SELECT max(id) FROM known)
                     + row_number() OVER (ORDER BY md5(keys.k), keys.k) AS id
              FROM keys LEFT JOIN known USING (k) WHERE known.id IS NULL),
    b AS (SELECT o_orderkey AS document_id, coalesce(known.id, fresh.id) AS contact_id,
                 invoice_id AS bill_number, invoice_date AS issue_date,
                 strftime(CAST(invoice_date AS DATE) + INTERVAL 30 DAY, '%Y-%m-%d') AS due_date,
                 amount, 'draft' AS status, 'http://h/documents/' || o_orderkey || '/' AS file_url,
                 'Auto-created from archive document #' || o_orderkey || ' (scan' || o_orderkey
                 || '.pdf)' AS notes
          FROM v LEFT JOIN known ON known.k = lower(vendor) LEFT JOIN fresh ON fresh.k = lower(vendor))
    """
)


def _bills(spark: SparkSession, sf_dir: str):
    created = F.lit("2024-06-30 12:00:00").cast("timestamp_ntz")
    documents = invoice_documents(spark, sf_dir)
    return run_bills(documents, *bill_inputs(spark, sf_dir), AS_OF, created)


@query("bill_records", _BILLS + "SELECT * FROM b WHERE amount > 0")
def bill_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bills(spark, sf_dir).bills


@query("bills_skipped", _BILLS + "SELECT * FROM b WHERE amount <= 0")
def bills_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bills(spark, sf_dir).skipped


@query(
    "correspondent_and_fields",
    _INVOICES
    + """,
    known AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'vendor ' ELSE 'other ' END || c_custkey AS k,
                     c_custkey + 7 AS id FROM customer),
    keys AS (SELECT DISTINCT lower(supplier) AS k FROM r WHERE supplier <> ''),
    fresh AS (SELECT keys.k, (SELECT max(id) FROM known)
                     + row_number() OVER (ORDER BY md5(keys.k), keys.k) AS id
              FROM keys LEFT JOIN known USING (k) WHERE known.id IS NULL)
    SELECT o_orderkey AS document_id,
           CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS content,
           coalesce(known.id, fresh.id) AS correspondent,
           '0=' || invoice_date || '|1=' || total_amount || '|2=' || invoice_id || '|3=$' AS custom_fields
    FROM r LEFT JOIN known ON known.k = lower(supplier) LEFT JOIN fresh ON fresh.k = lower(supplier)
    """,
)
def correspondent_and_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _bills(spark, sf_dir).updates
    flat = F.transform(
        "custom_fields", lambda f: F.concat(f["field"].cast("string"), F.lit("="), f["value"])
    )
    return updates.withColumn("custom_fields", F.array_join(flat, "|"))


@query(
    "correspondents_created",
    _INVOICES
    + """,
    known AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'vendor ' ELSE 'other ' END || c_custkey AS k,
                     c_custkey + 7 AS id FROM customer),
    keys AS (SELECT lower(supplier) AS k, arg_min(supplier, o_orderkey) AS name
             FROM r WHERE supplier <> '' GROUP BY 1)
    SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY md5(keys.k), keys.k) AS id,
           keys.name
    FROM keys LEFT JOIN known USING (k) WHERE known.id IS NULL
    """,
)
def correspondents_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bills(spark, sf_dir).new_correspondents


@query(
    "bill_ledger",
    _INVOICES
    + """
    SELECT 'bill' AS kind, o_orderkey AS document_id, TIMESTAMP '2024-06-30 12:00:00' AS created_at,
           'scan' || o_orderkey || '.pdf' AS filename, supplier, invoice_date AS date,
           CASE WHEN regexp_full_match(total_amount, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)')
                THEN CAST(total_amount AS DOUBLE) ELSE 0 END AS total_amount,
           CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS extracted_text
    FROM r
    """,
)
def bill_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON text, which comes from this query's own input, is left out."""
    return _bills(spark, sf_dir).ledger.drop("raw_ocr_data")


def statement_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 events to a statement, each event one table item, in the order of the events.

    Sign-ups have properties no transaction is made of; banks are named in three ways.
    """
    number = F.expr("event_id div 64")
    kind = F.col("event_type")
    day, amount = F.date_format("ts", "yyyy-MM-dd"), F.col("value").cast("string")
    other_day = F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd")
    text = F.concat(F.lit("Ref\n"), F.col("props"))
    props = (
        F.when(
            kind == "purchase",
            F.array(
                entity("transaction_withdrawal_date", "x", day),
                entity("value_date", other_day),
                entity("transaction_withdrawal", F.concat(amount, F.lit(" Dr")), amount),
                entity("transaction_withdrawal_description", text),
                entity("narration", "later"),
                entity("cheque_number", F.col("event_id").cast("string")),
            ),
        )
        .when(
            kind == "click",
            F.array(
                entity("transaction_deposit", "1"),
                entity("transaction_deposit_date", day),
                entity("deposit_amount", "", None, amount),
                entity("balance", amount),
                entity("transaction_deposit_description", "Click"),
            ),
        )
        .when(
            kind == "error",
            F.array(entity("debit_amount", F.concat(F.lit("$"), amount)), entity("narration", "")),
        )
        .when(kind == "view", F.array(entity("transaction_date", ""), entity("balance", amount)))
        .otherwise(F.array(entity("page_number", "1")))
    )
    item = F.struct(
        F.lit("table_item").alias("type"),
        F.lit(None).cast("string").alias("mention_text"),
        entity("x")["normalized_value"].alias("normalized_value"),
        entity("x")["text_anchor"].alias("text_anchor"),
        props.alias("properties"),
    )
    statements = (
        table(spark, sf_dir, "events")
        .groupBy(number.alias("document_id"))
        .agg(F.array_sort(F.collect_list(F.struct("event_id", item.alias("item")))).alias("listed"))
    )
    named = F.struct(
        F.lit("bank_name").alias("type"),
        F.when(F.col("document_id") % 3 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("Bank "), (F.col("document_id") % 20).cast("string")))
        .alias("mention_text"),
        entity("x")["normalized_value"].alias("normalized_value"),
        F.when(F.lit(True), F.struct(F.lit("anchor only").alias("content"))).alias("text_anchor"),
        F.array().cast("array<struct<type:string,mention_text:string,normalized_value:struct<text:string>,text_anchor:struct<content:string>>>").alias("properties"),
    )
    everything = F.concat(F.array(named), F.col("listed.item"))
    key = F.col("document_id").cast("string")
    return statements.select(
        "document_id",
        F.concat(F.lit("http://h/documents/"), key, F.lit("/")).alias("doc_url"),
        F.concat(F.lit("statement "), key).alias("text"),
        F.to_json(everything).alias("raw_ocr_data"),
    )


_ITEMS = """
    WITH e AS (SELECT event_id // 64 AS d, event_id % 64 + 1 AS item_no, event_type AS k,
                      strftime(ts, '%Y-%m-%d') AS day, CAST(value AS VARCHAR) AS v, * FROM events),
    t AS (SELECT d AS document_id, CAST(item_no AS INTEGER) AS item_no,
                 CASE k WHEN 'purchase' THEN day WHEN 'click' THEN day WHEN 'view' THEN '' END AS date,
                 CASE k WHEN 'purchase' THEN v WHEN 'click' THEN v WHEN 'error' THEN '$' || v END
                 AS amount,
                 CASE k WHEN 'purchase' THEN 'Ref ' || props WHEN 'click' THEN 'Click'
                        WHEN 'error' THEN '' END AS description,
                 CASE k WHEN 'purchase' THEN 'debit' WHEN 'click' THEN 'credit'
                        WHEN 'error' THEN 'debit' END AS type,
                 CASE k WHEN 'purchase' THEN CAST(event_id AS VARCHAR) END AS reference,
                 CASE WHEN k IN ('click', 'view') THEN v END AS balance
          FROM e WHERE k <> 'signup')
    """


@query("statement_transactions", _ITEMS + "SELECT * FROM t")
def statement_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = entities.decode_entities(statement_documents(spark, sf_dir))
    # the bank comes first in the list and is no table item
    return entities.extract_transactions(documents)


_ACCOUNTS = (
    _ITEMS
    + """,
    bank AS (SELECT DISTINCT document_id,
                    CASE WHEN document_id % 3 = 0 THEN 'Bank' ELSE 'Bank ' || (document_id % 20) END AS name
             FROM t),
    dim AS (SELECT s_suppkey AS id, 'BANK ' || (s_suppkey % 10) AS name FROM supplier),
    known AS (SELECT lower(name) AS k, min(id) AS id FROM dim GROUP BY 1),
    keys AS (SELECT lower(name) AS k, arg_min(name, document_id) AS name FROM bank GROUP BY 1),
    fresh AS (SELECT keys.k, keys.name, (SELECT max(id) FROM dim)
                     + row_number() OVER (ORDER BY md5(keys.k), keys.k) AS id
              FROM keys LEFT JOIN known USING (k) WHERE known.id IS NULL)
    """
)


def _statements(spark: SparkSession, sf_dir: str):
    key = F.col("s_suppkey")
    accounts = table(spark, sf_dir, "supplier").select(
        key.alias("id"),
        F.concat(F.lit("BANK "), (key % 10).cast("string")).alias("name"),
        F.when(key % 2 == 0, "cash").otherwise("bank").alias("type"),
    )
    created = F.lit("2024-06-30 12:00:00").cast("timestamp_ntz")
    return run_statements(statement_documents(spark, sf_dir), accounts, AS_OF, created)


@query(
    "account_get_or_create",
    _ACCOUNTS + "SELECT id, name, 'bank' AS type, CAST(0 AS BIGINT) AS opening_balance FROM fresh",
)
def account_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statements(spark, sf_dir).new_accounts


@query(
    "statement_flow",
    _ACCOUNTS
    + """
    SELECT t.document_id, item_no, coalesce(known.id, fresh.id) AS account_id,
           CASE WHEN type = 'credit' THEN 'income' ELSE 'expense' END AS type,
           coalesce(TRY_CAST(amount AS DOUBLE), 0) AS amount,
           coalesce(NULLIF(date, ''), '2024-06-30') AS transaction_date,
           coalesce(description, '') AS description
    FROM t JOIN bank USING (document_id) LEFT JOIN known ON known.k = lower(bank.name)
         LEFT JOIN fresh ON fresh.k = lower(bank.name)
    """,
)
def statement_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statements(spark, sf_dir).transactions


@query(
    "statement_updates",
    """
    SELECT DISTINCT event_id // 64 AS document_id, 'statement ' || (event_id // 64) AS content FROM events
    """,
)
def statement_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statements(spark, sf_dir).updates


@query(
    "statement_ledger",
    """
    SELECT DISTINCT 'statement' AS kind, event_id // 64 AS document_id,
           TIMESTAMP '2024-06-30 12:00:00' AS created_at,
           'http://h/documents/' || (event_id // 64) || '/' AS filename, '' AS supplier, '' AS date,
           CAST(0 AS DOUBLE) AS total_amount, 'statement ' || (event_id // 64) AS extracted_text
    FROM events
    """,
)
def statement_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON text, which comes from this query's own input, is left out."""
    return _statements(spark, sf_dir).ledger.drop("raw_ocr_data")


@query(
    "currency_minor_units",
    """
    SELECT o_orderkey AS document_id, CAST(trunc(o_totalprice * 100) AS BIGINT) AS amount,
           CASE WHEN o_orderkey % 4 = 3 THEN 0
                ELSE CAST(trunc(o_totalprice * 100) AS BIGINT) END AS strict_amount
    FROM orders
    """,
)
def currency_minor_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, price = F.col("o_orderkey") % 4, F.col("o_totalprice")
    text = (
        F.when(kind == 0, F.concat(F.lit(" ₹"), F.format_number(price, 2)))
        .when(kind == 1, F.concat(F.lit("[$₹]"), F.format_number(price, 2), F.lit("\t")))
        .when(kind == 2, F.concat(F.lit("₹ "), price.cast("string")))
        .otherwise(price.cast("string"))
    )
    plain = F.when(kind == 3, F.concat(F.lit("Rs "), price.cast("string"))).otherwise(
        price.cast("string")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("document_id"),
        scalars.currency_minor_units(text).alias("amount"),
        scalars.minor_units(scalars.weak_float(plain)).alias("strict_amount"),
    )


@query(
    "due_dates",
    """
    SELECT o_orderkey AS document_id,
           CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                WHEN 1 THEN strftime(o_orderdate, '%Y') || '-02-30'
                ELSE strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS due_date
    FROM orders
    """,
)
def due_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.date_format("o_orderdate", "M/d/yyyy"))
        .when(kind == 1, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-30")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("document_id"), scalars.due_date(text).alias("due_date")
    )
