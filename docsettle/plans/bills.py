"""The bill flow: scanned invoices to bills, archive updates and ledger records."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle.operators import dims, entities, ledger
from docsettle.session import staged

EXTRACTED = [
    "document_id",
    "file_name",
    "doc_url",
    "supplier",
    "invoice_date",
    "total_amount",
    *entities.OPTIONAL_FIELDS,
]


class Bills:
    """The flow's results. A name is resolved, and its ids staged, when a result first needs it.

    What is staged are the few short fields read from the entity lists, not the lists or
    texts. The ledger, which holds both, reads them where they lie instead of joining them
    to the fields. Every result has one row per document, however often one is given.
    """

    def __init__(
        self,
        documents: DataFrame,
        contacts: DataFrame,
        correspondents: DataFrame,
        fields: DataFrame,
        as_of: dt.date,
        created_at: Column,
        archive: str,
    ):
        self._readable = entities.readable_entities(documents)
        self._dimensions = contacts, correspondents, fields
        self._as_of, self._created_at, self._archive = as_of, created_at, archive
        self.rejects = entities.unreadable_entities(documents).dropDuplicates(["document_id"])

    @cached_property
    def _invoices(self) -> DataFrame:
        return entities.extract_invoices(entities.decode_entities(self._readable))

    @cached_property
    def _fields_read(self) -> DataFrame:
        return staged(self._invoices.select(*EXTRACTED).dropDuplicates(["document_id"]), "invoices")

    @cached_property
    def _vendors(self) -> dims.Resolved:
        return dims.get_or_create_vendors(self._fields_read, self._dimensions[0])

    @cached_property
    def _correspondents(self) -> dims.Resolved:
        return dims.get_or_create_correspondents(self._fields_read, self._dimensions[1])

    @cached_property
    def _records(self) -> tuple[DataFrame, DataFrame]:
        return entities.bill_records(self._vendors.rows, self._as_of, self._archive)

    @property
    def bills(self) -> DataFrame:
        return self._records[0]

    @property
    def skipped(self) -> DataFrame:
        return self._records[1]

    @property
    def new_contacts(self) -> DataFrame:
        return self._vendors.created

    @property
    def new_correspondents(self) -> DataFrame:
        return self._correspondents.created

    @cached_property
    def updates(self) -> DataFrame:
        texts = self._readable.groupBy("document_id").agg(F.max("text").alias("text"))
        with_text = self._correspondents.rows.join(texts, "document_id")
        bound = dims.bind_custom_fields(entities.custom_field_values(), self._dimensions[2])
        return entities.document_updates(with_text, bound)

    @cached_property
    def ledger(self) -> DataFrame:
        return ledger.bill_ledger(self._invoices, self._created_at).dropDuplicates(["document_id"])


def run_bills(
    documents: DataFrame,
    contacts: DataFrame,
    correspondents: DataFrame,
    fields: DataFrame,
    as_of: dt.date,
    created_at: Column,
    archive: str = "archive",
) -> Bills:
    """``documents`` has the columns of the entity documents, JSON entities included.

    A document without a readable list is in ``rejects`` and nowhere else.
    """
    return Bills(documents, contacts, correspondents, fields, as_of, created_at, archive)
