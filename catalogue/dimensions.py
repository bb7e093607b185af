"""Dimension queries: platforms by tag, get-or-create by name, the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query, table
from docsettle.operators import dims, ledger
from docsettle.sources.config import PlatformConfig, configured_platforms

CREATED = "2024-06-30 12:00:00"


def tagged_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents tagged by language and source, and the tag dimension made from them."""
    documents = table(spark, sf_dir, "documents")
    source_id = F.substring("source", 4, 9).cast("int") + 100
    lang_id = F.ascii(F.substring("lang", 1, 1)) * 256 + F.ascii(F.substring("lang", 2, 1))
    ending = (
        F.when(F.col("doc_id") % 3 == 0, ".XLSX").when(F.col("doc_id") % 3 == 1, ".xls").otherwise(".pdf")
    )
    tagged = documents.select(
        F.col("doc_id").alias("document_id"),
        F.concat(F.lit("2024/file"), F.col("doc_id").cast("string"), ending).alias("media_filename"),
        F.array(lang_id, source_id).alias("tags"),
    )
    names = F.array(
        F.struct(lang_id.alias("id"), F.col("lang").alias("name")),
        F.struct(source_id.alias("id"), F.col("source").alias("name")),
    )
    tags = documents.select(F.inline(names)).distinct()
    return tagged, tags


@query(
    "platform_resolution",
    """
    SELECT doc_id AS document_id, platform,
           (doc_id % 3 < 2 AND platform IS NOT NULL) AS processable
    FROM (SELECT doc_id, CASE WHEN lang = 'fr' THEN 'fr'
                              WHEN source IN ('src1', 'src5', 'src7') THEN source END AS platform
          FROM documents)
    """,
)
def platform_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, tags = tagged_documents(spark, sf_dir)
    names = ["src1", "src5", "src7", "fr", "no such tag"]
    platforms = configured_platforms({name: PlatformConfig() for name in names}, tags)
    resolved = dims.resolve_platform(documents, platforms)
    processable = dims.is_processable(F.col("media_filename"), F.col("platform"))
    return resolved.select("document_id", "platform", processable.alias("processable"))


_VENDORS = """
    WITH w AS (SELECT o_orderkey AS d,
                      CASE WHEN o_orderkey % 50 = 0 THEN 'Unknown Vendor'
                           WHEN o_orderkey % 2 = 0 THEN upper(format('Customer#{:09d}', o_custkey))
                           ELSE format('Customer#{:09d}', o_custkey) END AS name
               FROM orders),
         dim AS (SELECT c_custkey + 10 AS id,
                        CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'Other ' || c_custkey END AS name,
                        CASE WHEN c_custkey % 3 = 0 THEN 'customer' ELSE 'vendor' END AS type
                 FROM customer
                 UNION ALL
                 SELECT c_custkey + 5, CASE WHEN c_custkey % 4 = 0 THEN lower(c_name)
                                            ELSE 'other ' || c_custkey END, 'vendor'
                 FROM customer),
         known AS (SELECT lower(name) AS k, min(id) AS id FROM dim WHERE type = 'vendor' GROUP BY 1),
         keys AS (SELECT lower(name) AS k, arg_min(name, d) AS name FROM w GROUP BY 1),
         fresh AS (SELECT keys.k, keys.name, (SELECT max(id) FROM dim)
                          + row_number() OVER (ORDER BY md5(keys.k), keys.k) AS id
                   FROM keys LEFT JOIN known USING (k) WHERE known.id IS NULL)
    """


def vendor_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as bills by vendor name in varying case, and contacts that lack half of them."""
    name = F.format_string("Customer#%09d", "o_custkey")
    number = F.col("o_orderkey")
    supplier = F.when(number % 50 == 0, "").when(number % 2 == 0, F.upper(name)).otherwise(name)
    bills = table(spark, sf_dir, "orders").select(
        number.alias("document_id"), supplier.alias("supplier")
    )
    customers, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    other = key.cast("string")
    first = customers.select(
        (key + 10).alias("id"),
        F.when(key % 2 == 0, F.col("c_name")).otherwise(F.concat(F.lit("Other "), other)).alias("name"),
        F.when(key % 3 == 0, "customer").otherwise("vendor").alias("type"),
    )
    second = customers.select(
        (key + 5).alias("id"),
        F.when(key % 4 == 0, F.lower("c_name"))
        .otherwise(F.concat(F.lit("other "), other))
        .alias("name"),
        F.lit("vendor").alias("type"),
    )
    return bills, first.unionByName(second)


@query(
    "vendor_get_or_create",
    _VENDORS
    + """
    SELECT d AS document_id, coalesce(known.id, fresh.id) AS contact_id
    FROM w LEFT JOIN known ON known.k = lower(w.name) LEFT JOIN fresh ON fresh.k = lower(w.name)
    """,
)
def vendor_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = dims.get_or_create_vendors(*vendor_inputs(spark, sf_dir))
    return result.rows.select("document_id", "contact_id")


@query("vendors_created", _VENDORS + "SELECT id, name, 'vendor' AS type FROM fresh")
def vendors_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.get_or_create_vendors(*vendor_inputs(spark, sf_dir)).created


@query(
    "ledger_append",
    """
    SELECT 'bill' AS kind, doc_id AS document_id, 'scan' || doc_id || '.pdf' AS filename,
           source AS supplier, '2024-01-05' AS date, CAST(n_chars AS DOUBLE) AS total_amount,
           '[]' AS raw_ocr_data, text AS extracted_text, TIMESTAMP '2024-06-30 12:00:00' AS created_at
    FROM documents
    UNION ALL
    SELECT 'statement', doc_id, 'http://h/documents/' || doc_id || '/', '', '', 0, '[]', text,
           TIMESTAMP '2024-06-30 12:00:00'
    FROM documents
    UNION ALL
    SELECT 'payout', doc_id, 'documents/originals/2024/f' || doc_id || '.xlsx', '', '', 0, '', '',
           TIMESTAMP '2024-06-30 12:00:00'
    FROM documents
    """,
)
def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("doc_id").cast("string")
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("document_id"),
        F.concat(F.lit("scan"), number, F.lit(".pdf")).alias("file_name"),
        F.concat(F.lit("http://h/documents/"), number, F.lit("/")).alias("doc_url"),
        F.concat(F.lit("2024/f"), number, F.lit(".xlsx")).alias("media_filename"),
        "text",
        F.lit("[]").alias("raw_ocr_data"),
        F.col("source").alias("supplier"),
        F.lit("2024-01-05").alias("invoice_date"),
        F.concat(F.col("n_chars").cast("string"), F.lit(".00")).alias("total_amount"),
    )
    created = F.lit(CREATED).cast("timestamp_ntz")
    bills = ledger.bill_ledger(documents, created)
    statements = ledger.statement_ledger(documents, created)
    return bills.unionByName(statements).unionByName(ledger.payout_ledger(documents, created))


@query(
    "ledger_antijoin",
    """
    SELECT doc_id AS document_id, kind
    FROM documents CROSS JOIN (SELECT 'bill' AS kind UNION ALL SELECT 'payout') k
    WHERE NOT (kind = 'bill' AND doc_id IN (SELECT doc_id FROM labels))
    """,
)
def ledger_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents are in the ledger as bills, which does not block payouts."""
    batch = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("document_id"),
        F.explode(F.array(F.lit("bill"), F.lit("payout"))).alias("kind"),
    )
    done = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("document_id"), F.lit("bill").alias("kind")
    )
    return ledger.exclude_processed(batch, done)
