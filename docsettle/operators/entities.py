"""Entity lists of scanned documents to invoices, bills and transactions.

An entity list belongs to one document and arrives as one value, so all of this is
narrow: no shuffle happens between reading the documents and the typed records.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsettle import fixed, schemas
from docsettle.functions.scalars import (
    due_date,
    minor_units,
    non_empty,
    or_default,
    weak_float,
)


OPTIONAL_FIELDS = [fixed.INVOICE_ID, fixed.CURRENCY, fixed.NET_AMOUNT]


def decode_entities(documents: DataFrame) -> DataFrame:
    """``raw_ocr_data`` JSON text to a typed entity list in ``entities``."""
    parsed = F.from_json("raw_ocr_data", schemas.ENTITIES)
    empty = F.array().cast(schemas.ENTITIES)
    return documents.withColumn("entities", F.coalesce(parsed, empty))


def readable_entities(documents: DataFrame) -> DataFrame:
    """Documents with an entity list, which may be empty."""
    return documents.where(F.from_json("raw_ocr_data", schemas.ENTITIES).isNotNull())


def unreadable_entities(documents: DataFrame) -> DataFrame:
    """Documents whose entity list is absent or no JSON list: ``document_id, import_no, reason``."""
    bad = documents.where(F.from_json("raw_ocr_data", schemas.ENTITIES).isNull())
    return bad.select("document_id", F.lit(None).cast("int").alias("import_no"), F.lit("unreadable entities").alias("reason"))


def mention_value(entity: Column) -> Column:
    """Mention text, else the content of the text anchor, else empty."""
    return F.coalesce(
        non_empty(entity["mention_text"]), entity["text_anchor"]["content"], F.lit("")
    )


def normalized_value(entity: Column) -> Column:
    """Normalized text, else mention text, else the anchor's content, else empty."""
    return F.coalesce(non_empty(entity["normalized_value"]["text"]), mention_value(entity))


def first_of(items: Column, types: list[str]) -> Column:
    return F.get(F.filter(items, lambda e: e["type"].isin(types)), F.lit(0))


def last_of(items: Column, types: list[str]) -> Column:
    return F.try_element_at(F.filter(items, lambda e: e["type"].isin(types)), F.lit(-1))


def two_decimals(text: Column) -> Column:
    """Amount text with two decimals, cut or padded; text with more dots is kept."""
    parts = F.split(text, "[.]", -1)
    cents = F.rpad(F.substring(F.get(parts, F.lit(1)), 1, 2), 2, "0")
    return (
        F.when(F.size(parts) == 1, F.concat(text, F.lit(".00")))
        .when(F.size(parts) == 2, F.concat(F.get(parts, F.lit(0)), F.lit("."), cents))
        .otherwise(text)
    )


def extract_invoices(documents: DataFrame) -> DataFrame:
    """Adds the invoice fields and ``fields``, the map of all types to their last value.

    Date, total and supplier are empty where the list has none, the others null.
    """
    listed = F.transform(
        "entities",
        lambda e: F.struct(F.coalesce(e["type"], F.lit("")).alias("type"), mention_value(e).alias("value")),
    )
    frame = documents.withColumn("_listed", listed).withColumn(
        "fields",
        F.map_from_entries(
            F.transform(
                F.array_distinct(F.col("_listed.type")),
                lambda t: F.struct(
                    t, F.element_at(F.filter("_listed", lambda e: e["type"] == t), -1)["value"]
                ),
            )
        ),
    )
    total = F.col(f"_{fixed.TOTAL_AMOUNT}")
    raw = F.when(
        total["normalized_value"].isNotNull(),
        F.coalesce(total["normalized_value"]["text"], F.lit("")),
    ).otherwise(mention_value(total))
    chosen = [fixed.INVOICE_DATE, fixed.TOTAL_AMOUNT, fixed.SUPPLIER_NAME, *OPTIONAL_FIELDS]
    frame = frame.withColumns(
        {f"_{name}": last_of(F.col("entities"), [name]) for name in chosen}
    )
    return frame.withColumns(
        {
            "invoice_date": F.coalesce(_last_value(fixed.INVOICE_DATE), F.lit("")),
            "total_amount": F.when(total.isNotNull(), two_decimals(raw)).otherwise(F.lit("")),
            "supplier": F.coalesce(_last_value(fixed.SUPPLIER_NAME), F.lit("")),
            **{name: _last_value(name) for name in OPTIONAL_FIELDS},
        }
    ).drop("_listed", *[f"_{name}" for name in chosen])


def _last_value(name: str) -> Column:
    entity = F.col(f"_{name}")
    return F.when(entity.isNotNull(), mention_value(entity))


def bill_records(
    invoices: DataFrame, as_of: dt.date, archive: str = "archive"
) -> tuple[DataFrame, DataFrame]:
    """Bills and the documents skipped for want of a positive amount.

    ``invoices`` comes out of :func:`extract_invoices` with a ``contact_id`` resolved;
    vendors therefore exist even for skipped bills. ``archive`` names the source system
    in the note.
    """
    issued = or_default(F.col("invoice_date"), as_of.isoformat())
    note = F.format_string(
        f"Auto-created from {archive.replace('%', '%%')} document #%d (%s)",
        F.col("document_id"),
        F.col("file_name"),
    )
    bills = invoices.select(
        "document_id",
        "contact_id",
        F.coalesce(fixed.INVOICE_ID, F.lit("")).alias("bill_number"),
        issued.alias("issue_date"),
        due_date(issued).alias("due_date"),
        minor_units(weak_float(F.col("total_amount"))).alias("amount"),
        F.lit(fixed.BILL_STATUS).alias("status"),
        F.col("doc_url").alias("file_url"),
        note.alias("notes"),
    )
    return bills.where("amount > 0"), bills.where("amount <= 0")


def custom_field_values() -> dict[str, Column]:
    """Value per source of a custom field; null where the field stays unset.

    A total is only ever empty where the document has none.
    """
    return {
        fixed.INVOICE_DATE: non_empty(F.col("invoice_date")),
        fixed.TOTAL_AMOUNT: non_empty(F.col("total_amount")),
        **{name: F.col(name) for name in OPTIONAL_FIELDS},
    }


def document_updates(invoices: DataFrame, custom_fields: Column) -> DataFrame:
    """Partial updates of the archive: null stands for untouched."""
    return invoices.select(
        "document_id",
        non_empty(F.col("text")).alias("content"),
        "correspondent",
        F.when(F.size(custom_fields) > 0, custom_fields).alias("custom_fields"),
    )


def content_updates(documents: DataFrame) -> DataFrame:
    """The statement flow only hands back the text, even where it is empty."""
    return documents.select("document_id", F.coalesce("text", F.lit("")).alias("content"))


def is_recognised(prop: Column) -> Column:
    """Whether a property says anything about a transaction."""
    return prop["type"].isin(
        fixed.DEBIT_DATE_TYPES
        + fixed.CREDIT_DATE_TYPES
        + fixed.PLAIN_DATE_TYPES
        + fixed.DEBIT_AMOUNT_TYPES
        + fixed.CREDIT_AMOUNT_TYPES
        + fixed.DESCRIPTION_TYPES
        + fixed.REFERENCE_TYPES
        + fixed.BALANCE_TYPES
    )


def has_transactions(items: Column) -> Column:
    """Whether an entity list holds at least one usable table item."""
    return F.exists(
        items,
        lambda e: (e["type"] == fixed.TABLE_ITEM) & F.exists(e["properties"], is_recognised),
    )


def extract_transactions(documents: DataFrame, *carried: str) -> DataFrame:
    """One row per table item with at least one recognised property.

    The first date and description win, by presence; the last amount, reference and
    balance win, and the last dated or amount property with a direction sets the type.
    """
    items = F.filter("entities", lambda e: e["type"] == fixed.TABLE_ITEM)
    numbered = documents.select("document_id", *carried, F.posexplode(items).alias("pos", "item"))
    props = F.transform(
        F.coalesce(F.col("item.properties"), F.array().cast(f"array<{schemas.PROPERTY}>")),
        lambda p: F.struct(p["type"].alias("type"), normalized_value(p).alias("value")),
    )
    debit = fixed.DEBIT_DATE_TYPES + fixed.DEBIT_AMOUNT_TYPES
    credit = fixed.CREDIT_DATE_TYPES + fixed.CREDIT_AMOUNT_TYPES
    dates = fixed.DEBIT_DATE_TYPES + fixed.CREDIT_DATE_TYPES + fixed.PLAIN_DATE_TYPES
    amounts = fixed.DEBIT_AMOUNT_TYPES + fixed.CREDIT_AMOUNT_TYPES
    p = F.col("props")
    direction = last_of(p, debit + credit)["type"]
    return (
        numbered.withColumn("props", props)
        .where(F.exists("props", is_recognised))
        .select(
            "document_id",
            *carried,
            (F.col("pos") + 1).alias("item_no"),
            first_of(p, dates)["value"].alias("date"),
            last_of(p, amounts)["value"].alias("amount"),
            F.replace(first_of(p, fixed.DESCRIPTION_TYPES)["value"], F.lit("\n"), F.lit(" ")).alias(
                "description"
            ),
            F.when(direction.isin(debit), "debit").when(direction.isin(credit), "credit").alias("type"),
            last_of(p, fixed.REFERENCE_TYPES)["value"].alias("reference"),
            last_of(p, fixed.BALANCE_TYPES)["value"].alias("balance"),
        )
    )


def transaction_records(transactions: DataFrame, as_of: dt.date) -> DataFrame:
    """Bookkeeping form: income or expense, amount 0 and today's date where missing."""
    return transactions.select(
        "document_id",
        "item_no",
        "account_id",
        F.when(F.col("type") == "credit", "income").otherwise("expense").alias("type"),
        weak_float(F.coalesce("amount", F.lit(""))).alias("amount"),
        or_default(F.col("date"), as_of.isoformat()).alias("transaction_date"),
        F.coalesce("description", F.lit("")).alias("description"),
    )


def bank_names(documents: DataFrame) -> DataFrame:
    """Adds ``bank_name``: the first non-empty one of the list, else the default.

    The anchor's content is no fallback here.
    """
    values = F.transform(
        F.filter("entities", lambda e: e["type"] == fixed.BANK_NAME),
        lambda e: F.coalesce(non_empty(e["normalized_value"]["text"]), e["mention_text"]),
    )
    first = F.get(F.filter(values, lambda v: F.length(v) > 0), F.lit(0))
    return documents.withColumn("bank_name", F.coalesce(first, F.lit(fixed.DEFAULT_BANK)))
