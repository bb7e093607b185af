"""The three flows behind the intake: a batch of requests joined to the archive, processed and published."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsettle.operators import dims, landing
from docsettle.plans.bills import run_bills
from docsettle.plans.payouts import candidates, run_payouts
from docsettle.plans.statements import run_statements
from docsettle.session import staged
from docsettle.sources.config import PlatformConfig
from docsettle.streaming.intake import Flow

UNKNOWN = "unknown document"
NO_WORKBOOK = "no workbook of a known platform"


@dataclass(frozen=True)
class Archive:
    """What is stored of the documents, each table with a ``document_id``.

    ``documents`` has ``file_name, media_filename, tags``, ``scans`` has ``text, raw_ocr_data``; ``rows`` (sheet rows)
    and ``payloads`` are those of the workbooks.
    """

    documents: DataFrame
    scans: DataFrame
    rows: DataFrame | None = None
    payloads: DataFrame | None = None


@dataclass(frozen=True)
class Books:
    """Entries that exist before the first batch."""

    contacts: DataFrame
    accounts: DataFrame
    correspondents: DataFrame
    fields: DataFrame
    tags: DataFrame


def _rejected(documents: DataFrame, reason: str) -> DataFrame:
    return documents.select("document_id", F.lit(None).cast("int").alias("import_no"), F.lit(reason).alias("reason"))


def _found(requests: DataFrame, table: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The requested documents with what ``table`` has of them, as a table of this batch, and those that it lacks.

    A batch is small against the archive: it is its side of the join that is made small enough to broadcast, or
    else both meet by document.
    """
    known = staged(table.join(requests.select("document_id", "doc_url", "received_at"), "document_id"), name)
    lacking = requests.join(known.select("document_id").distinct(), "document_id", "left_anti")
    return known, _rejected(lacking, UNKNOWN)


def archive_flows(
    archive: Archive,
    books: Books,
    platforms: Mapping[str, PlatformConfig],
    root: str,
    outlet_name: str,
    as_of: dt.date,
    digits: int | None = None,
    archive_name: str = "archive",
) -> dict[str, Flow]:
    """Flows for :func:`docsettle.streaming.intake.process_batch`, by kind of request.

    Names are resolved against the books and what earlier batches created, sheets land in the columns that earlier
    batches stored. Records bear the time of their request. A document that the archive does not have, or that
    its flow cannot process, is in ``rejects``.
    """
    spark = archive.documents.sparkSession
    stamp = F.col("received_at")

    def created(dimension: DataFrame, table: str, batch_id: int) -> DataFrame:
        return dims.known_entries(dimension, root, table, batch_id)

    def bills(requests: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        scans = archive.scans.join(archive.documents.select("document_id", "file_name"), "document_id")
        known, unknown = _found(requests, scans, "scans")
        found = run_bills(
            known,
            created(books.contacts, "contacts", batch_id),
            created(books.correspondents, "correspondents", batch_id),
            books.fields,
            as_of,
            stamp,
            archive_name,
        )
        return {
            "bills": found.bills,
            "bills_skipped": found.skipped,
            "contacts": found.new_contacts,
            "correspondents": found.new_correspondents,
            "bill_updates": found.updates,
            "ledger": found.ledger,
            "rejects": unknown.union(found.rejects),
        }

    def statements(requests: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        known, unknown = _found(requests, archive.scans, "scans")
        found = run_statements(known, created(books.accounts, "accounts", batch_id), as_of, stamp)
        return {
            "transactions": found.transactions,
            "accounts": found.new_accounts,
            "statement_updates": found.updates,
            "ledger": found.ledger,
            "rejects": unknown.union(found.rejects),
        }

    def payouts(requests: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        known, unknown = _found(requests, archive.documents, "documents")
        chosen = candidates(known, books.tags, platforms).select("document_id")
        other = known.join(chosen, "document_id", "left_anti")
        ids = known.select("document_id").distinct()
        rows, payloads = (t if t is None else t.join(ids, "document_id", "left_semi") for t in (archive.rows, archive.payloads))
        columns = landing.stored_columns(spark, root, batch_id)
        found = run_payouts(known, books.tags, platforms, rows, payloads, outlet_name, stamp, digits, columns)
        landing.store_columns(spark, found.landings, columns, root, batch_id)
        return {
            **{f"landing_{name}": landed for name, landed in found.landings.items()},
            "settlements": found.settlements,
            "ledger": found.ledger,
            "rejects": unknown.union(_rejected(other, NO_WORKBOOK)).union(found.rejects),
        }

    return {"bill": bills, "statement": statements, "payout": payouts}
