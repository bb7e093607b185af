"""The ledger of processed documents: records per flow, append, exclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle import schemas
from docsettle.functions.scalars import weak_float
from docsettle.operators.dims import original_path

KEYS = ["kind", "document_id"]
_TYPES = dict(part.strip().split(" ") for part in schemas.LEDGER.split(","))


def _records(df: DataFrame, kind: str, created_at: Column, **values: Column) -> DataFrame:
    filled = {
        "kind": F.lit(kind),
        "document_id": F.col("document_id"),
        "created_at": created_at,
        "total_amount": F.lit(0.0),
        **values,
    }
    return df.select(
        *[filled.get(name, F.lit("")).cast(kind_).alias(name) for name, kind_ in _TYPES.items()]
    )


def bill_ledger(invoices: DataFrame, created_at: Column) -> DataFrame:
    return _records(
        invoices,
        "bill",
        created_at,
        filename=F.col("file_name"),
        supplier=F.col("supplier"),
        date=F.col("invoice_date"),
        total_amount=weak_float(F.col("total_amount")),
        raw_ocr_data=F.col("raw_ocr_data"),
        extracted_text=F.col("text"),
    )


def statement_ledger(documents: DataFrame, created_at: Column) -> DataFrame:
    """Statements keep their URL as the file name and have no supplier, date or total."""
    return _records(
        documents,
        "statement",
        created_at,
        filename=F.col("doc_url"),
        raw_ocr_data=F.col("raw_ocr_data"),
        extracted_text=F.col("text"),
    )


def payout_ledger(documents: DataFrame, created_at: Column) -> DataFrame:
    return _records(
        documents, "payout", created_at, filename=original_path(F.col("media_filename"))
    )


def exclude_processed(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of the batch whose document is not in the ledger.

    The ledger is first cut down to the batch's own keys. Where the batch turns out
    small at run time its keys are broadcast and the ledger is not shuffled; else both
    sides are joined on keys that are single documents.
    """
    keys = batch.select(*KEYS).distinct()
    seen = ledger.select(*KEYS).join(keys, KEYS, "left_semi")
    return batch.join(seen, KEYS, "left_anti")


def first_requests(batch: DataFrame, order: str) -> DataFrame:
    """One row per document, the first by ``order``; repeats combine map side."""
    rest = [name for name in batch.columns if name not in (*KEYS, order)]
    first = batch.groupBy(*KEYS).agg(F.min(F.struct(order, *rest)).alias("_first"))
    return first.select(*KEYS, "_first.*").select(*batch.columns)
