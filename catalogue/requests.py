"""Request queries: ids from URLs and the streaming intake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query, table
from docsettle.functions.scalars import document_id
from docsettle.operators import ledger
from docsettle.operators.landing import read_table
from docsettle.session import shared_dir, staged
from docsettle.streaming.intake import request_stream, run_intake


@query(
    "request_ids",
    """
    WITH u AS (SELECT url FROM pages
               UNION ALL SELECT 'http://h:8000/documents/' || page_id || '/' FROM pages
               UNION ALL SELECT 'documents/+' || page_id FROM pages
               UNION ALL SELECT 'http://h/documents/' || page_id || '//' FROM pages
               UNION ALL SELECT '-' || page_id FROM pages),
    s AS (SELECT url, regexp_replace(url, '/$', '') AS cut FROM u),
    l AS (SELECT url, split_part(cut, '/', -1) AS last FROM s)
    SELECT url, CASE WHEN regexp_full_match(last, '[+-]?[0-9]+')
                     THEN TRY_CAST(ltrim(last, '+') AS BIGINT) END AS document_id FROM l
    """,
)
def request_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("page_id").cast("string")
    urls = F.array(
        F.col("url"),
        F.concat(F.lit("http://h:8000/documents/"), number, F.lit("/")),
        F.concat(F.lit("documents/+"), number),
        F.concat(F.lit("http://h/documents/"), number, F.lit("//")),
        F.concat(F.lit("-"), number),
    )
    pages = table(spark, sf_dir, "pages").select(F.explode(urls).alias("url"))
    return pages.select("url", document_id(F.col("url")).alias("document_id"))


def request_log(events: DataFrame) -> DataFrame:
    """Events as requests for their user's document, some malformed or of no known kind."""
    number = F.col("event_id")
    kind = (
        F.when(number % 4 == 0, "payout")
        .when(number % 4 == 1, "bill")
        .when(number % 4 == 2, "statement")
        .otherwise("other")
    )
    ending = F.when(number % 13 == 0, "/x/").otherwise("/")
    url = F.concat(F.lit("http://h/documents/"), F.col("user_id").cast("string"), ending)
    return events.select(kind.alias("kind"), url.alias("doc_url"), F.col("ts").alias("received_at"))


def tenth(stamp: Column) -> Column:
    """0 to 2 for the first, second and last days of a month."""
    return F.least(F.expr("2"), F.floor((F.dayofmonth(stamp) - 1) / 10)).cast("int")


def take_in(log: DataFrame, root: str, flows) -> None:
    """A log with a ``part`` (0, 1, 2) as files that come in one after the other, and the intake run twice over them."""
    spark, source = log.sparkSession, f"{root}/log"
    log = staged(log, "log")

    def arrive(part: int) -> None:
        log.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(source)

    def run() -> None:
        stream = request_stream(spark, source, "parquet", maxFilesPerTrigger="1")
        run_intake(stream, root, f"{root}/checkpoint", flows).awaitTermination()

    arrive(0), arrive(1), run()
    arrive(2), run()


@query(
    "intake_stream",
    """
    SELECT kind, user_id AS document_id, min(ts) AS created_at,
           CASE kind WHEN 'payout' THEN 'documents/originals/' || user_id || '.xlsx'
                     WHEN 'bill' THEN user_id || '.pdf'
                     ELSE 'http://h/documents/' || user_id || '/' END AS filename
    FROM (SELECT *, CASE event_id % 4 WHEN 0 THEN 'payout' WHEN 1 THEN 'bill'
                         WHEN 2 THEN 'statement' END AS kind FROM events)
    WHERE kind IS NOT NULL AND event_id % 13 <> 0 GROUP BY kind, user_id
    """,
)
def intake_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a stream of requests; the ledger holds every document once.

    The log comes in three files, by date and one per batch, the last one after a restart.
    """
    root = shared_dir(spark, "intake")
    log = request_log(table(spark, sf_dir, "events")).withColumn("part", tenth(F.col("received_at")))
    number, stamp = F.col("document_id").cast("string"), F.col("received_at")
    name = {
        "bill": F.concat(number, F.lit(".pdf")),
        "payout": F.concat(number, F.lit(".xlsx")),
        "statement": F.col("doc_url"),
    }

    def flow(kind: str, build):
        def run(requests: DataFrame, batch_id: int) -> dict[str, DataFrame]:
            documents = requests.withColumns(
                {
                    "file_name": name[kind],
                    "media_filename": name[kind],
                    "supplier": F.lit(""),
                    "invoice_date": F.lit(""),
                    "total_amount": F.lit(".00"),
                    "raw_ocr_data": F.lit("[]"),
                    "text": F.lit(""),
                }
            )
            return {"ledger": build(documents, stamp)}

        return run

    flows = {
        "bill": flow("bill", ledger.bill_ledger),
        "payout": flow("payout", ledger.payout_ledger),
        "statement": flow("statement", ledger.statement_ledger),
    }
    take_in(log, root, flows)
    return read_table(spark, root, "ledger").select("kind", "document_id", "created_at", "filename")
