"""The bank statement flow: scanned statements to transactions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from docsettle.operators import dims, entities, ledger
from docsettle.session import staged


@dataclass(frozen=True)
class Statements:
    transactions: DataFrame
    new_accounts: DataFrame
    updates: DataFrame
    ledger: DataFrame
    rejects: DataFrame


def run_statements(
    documents: DataFrame, accounts: DataFrame, as_of: dt.date, created_at: Column
) -> Statements:
    """Items are taken apart once and staged, with their bank's name, by which they get its account.

    Every result has one row per document or item, however often a document is given. A
    document without any transaction gets no account; one without a readable entity list
    is in ``rejects`` and nowhere else.
    """
    rejects = entities.unreadable_entities(documents).dropDuplicates(["document_id"])
    documents = entities.readable_entities(documents)
    decoded = entities.bank_names(entities.decode_entities(documents))
    items = entities.extract_transactions(decoded, "bank_name").dropDuplicates(["document_id", "item_no"])
    owned = dims.get_or_create_accounts(staged(items, "items"), accounts)
    return Statements(
        entities.transaction_records(owned.rows, as_of),
        owned.created,
        entities.content_updates(documents).dropDuplicates(["document_id"]),
        ledger.statement_ledger(documents, created_at).dropDuplicates(["document_id"]),
        rejects,
    )
