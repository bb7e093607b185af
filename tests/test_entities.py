import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from docsettle.operators import entities
from docsettle.plans.bills import run_bills
from docsettle.plans.statements import run_statements

DOC = "document_id bigint, file_name string, doc_url string, text string, raw_ocr_data string"
AS_OF = dt.date(2024, 6, 30)


def stamp():
    return F.lit("2024-06-30 12:00:00").cast("timestamp_ntz")


def entity(kind, mention="", normalized=None, anchor=None, properties=None):
    made = {"type": kind, "mention_text": mention}
    if normalized is not None:
        made["normalized_value"] = {"text": normalized}
    if anchor is not None:
        made["text_anchor"] = {"content": anchor}
    if properties is not None:
        made["properties"] = properties
    return made


def documents(spark, *lists):
    rows = [
        (n, f"f{n}.pdf", f"http://h/documents/{n}/", f"text {n}" if n % 2 else "", json.dumps(one))
        for n, one in enumerate(lists, start=1)
    ]
    return spark.createDataFrame(rows, DOC)


def invoices(spark, *lists):
    frame = entities.extract_invoices(entities.decode_entities(documents(spark, *lists)))
    return frame.orderBy("document_id").collect()


def test_invoice_fields(spark):
    row = invoices(
        spark,
        [
            entity("invoice_date", "2022-03-17"),
            entity("total_amount", "$48.20", "48.20"),
            entity("supplier_name", "Harbour Rope Works"),
            entity("currency", "$", "USD"),
        ],
    )[0]
    assert (row["invoice_date"], row["total_amount"], row["supplier"]) == ("2022-03-17", "48.20", "Harbour Rope Works")
    assert row["fields"]["currency"] == "$"
    assert row["fields"]["total_amount"] == "$48.20"
    assert row["currency"] == "$"
    assert row["invoice_id"] is None


def test_anchor_fallback_last_wins_and_no_entities(spark):
    rows = invoices(
        spark,
        [entity("invoice_date", anchor="2023-01-01")],
        [entity("supplier_name", "a"), entity("supplier_name", "b"), entity("total_amount", "5", "")],
        [],
    )
    assert rows[0]["invoice_date"] == "2023-01-01"
    assert (rows[1]["supplier"], rows[1]["total_amount"]) == ("b", ".00")
    assert (rows[2]["invoice_date"], rows[2]["total_amount"], rows[2]["supplier"]) == ("", "", "")
    assert rows[2]["fields"] == {}


def test_entities_that_are_no_json(spark):
    frame = spark.createDataFrame([(1, "f", "u", "t", "junk"), (2, "f", "u", "t", None)], DOC)
    assert [r["entities"] for r in entities.decode_entities(frame).collect()] == [[], []]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("100.50", "100.50"), ("100", "100.00"), ("100.5", "100.50"), ("100.", "100.00"),
        ("100.999", "100.99"), ("1.234.56", "1.234.56"), ("", ".00"), ("$1,200", "$1,200.00"),
    ],
)
def test_two_decimals(values, text, expected):
    assert values(entities.two_decimals, [text]) == [expected]


def statement(*items, bank=None):
    banks = [] if bank is None else [entity("bank_name", *bank)]
    return banks + [entity("table_item", properties=list(props)) for props in items]


def transactions(spark, *lists):
    frame = entities.extract_transactions(entities.decode_entities(documents(spark, *lists)))
    return frame.orderBy("document_id", "item_no").collect()


def test_first_and_last_wins(spark):
    row = transactions(
        spark,
        statement(
            [
                entity("transaction_withdrawal_date", "03-DEC-2025", "2025-12-03"),
                entity("value_date", "2025-12-04"),
                entity("transaction_withdrawal", "1,000", "1000"),
                entity("narration", "UPI\nX"),
                entity("transaction_deposit_description", "later"),
                entity("deposit_amount", anchor="55"),
                entity("cheque_number", "1"),
                entity("cheque_number", "2"),
            ]
        ),
    )[0].asDict()
    assert row == {
        "document_id": 1, "item_no": 1, "date": "2025-12-03", "amount": "55", "description": "UPI X",
        "type": "credit", "reference": "2", "balance": None,
    }


def test_presence_wins_over_content_and_unknown_items_are_dropped(spark):
    rows = transactions(
        spark,
        statement(
            [entity("transaction_date", ""), entity("value_date", "2025-01-01")],
            [entity("page", "1")],
            [],
            [entity("transaction_deposit_date", "d")],
            [entity("balance", "9")],
        ),
        [entity("other", properties=[entity("balance", "1")])],
    )
    assert [(r["item_no"], r["date"], r["type"], r["balance"]) for r in rows] == [
        (1, "", None, None),
        (4, "d", "credit", None),
        (5, None, None, "9"),
    ]


def test_bank_names(spark):
    lists = [
        statement(bank=("", None, "anchor only")),
        statement(bank=("HDFC", "HDFC Bank")),
        [entity("bank_name", "", ""), entity("bank_name", "Second")],
        [],
    ]
    frame = entities.bank_names(entities.decode_entities(documents(spark, *lists)))
    found = [r["bank_name"] for r in frame.orderBy("document_id").collect()]
    assert found == ["Bank", "HDFC Bank", "Second", "Bank"]


def test_statement_flow(spark):
    item = [entity("transaction_deposit", "7.5"), entity("transaction_deposit_date", "2025-01-01")]
    lists = [
        statement(item, [entity("debit_amount", "$3"), entity("narration", "n")], bank=("hdfc",)),
        statement(item, bank=("New Bank",)),
        statement([entity("page", "1")], bank=("Never seen",)),
    ]
    accounts = spark.createDataFrame(
        [(4, "HDFC", "cash"), (9, "Zed", "bank")], "id bigint, name string, type string"
    )
    result = run_statements(documents(spark, *lists), accounts, AS_OF, stamp())
    rows = [tuple(r) for r in result.transactions.orderBy("document_id", "item_no").collect()]
    assert rows == [
        (1, 1, 4, "income", 7.5, "2025-01-01", ""),
        (1, 2, 4, "expense", 0.0, "2024-06-30", "n"),
        (2, 1, 10, "income", 7.5, "2025-01-01", ""),
    ]
    assert [tuple(r) for r in result.new_accounts.collect()] == [(10, "New Bank", "bank", 0)]
    assert [r["content"] for r in result.updates.orderBy("document_id").collect()] == ["text 1", "", "text 3"]
    assert {r["filename"] for r in result.ledger.collect()} == {f"http://h/documents/{n}/" for n in (1, 2, 3)}


def test_bill_flow(spark):
    lists = [
        [entity("invoice_date", "2023-01-05"), entity("total_amount", "19.99"),
         entity("supplier_name", "HARBOUR ropes"), entity("invoice_id", "I-1"), entity("net_amount", "")],
        [entity("total_amount", "$5"), entity("supplier_name", "New Co")],
        [entity("total_amount", "1", "2.5"), entity("supplier_name", "NEW co")],
        [entity("invoice_date", "soon"), entity("total_amount", "3")],
    ]
    contacts = spark.createDataFrame(
        [(11, "harbour ROPES", "vendor"), (10, "Harbour Ropes", "vendor"), (12, "new co", "customer")],
        "id bigint, name string, type string",
    )
    correspondents = spark.createDataFrame([(3, "New Co")], "id bigint, name string")
    fields = spark.createDataFrame(
        [(1, "Invoice Date"), (2, "Total"), (3, "Net Amount"), (4, "Other")], "id bigint, name string"
    )
    result = run_bills(documents(spark, *lists), contacts, correspondents, fields, AS_OF, stamp())
    bills = {r["document_id"]: r for r in result.bills.collect()}
    assert set(bills) == {1, 3, 4}
    first = bills[1].asDict()
    assert first == {
        "document_id": 1, "contact_id": 10, "bill_number": "I-1", "issue_date": "2023-01-05",
        "due_date": "2023-02-04", "amount": 1998, "status": "draft", "file_url": "http://h/documents/1/",
        "notes": "Auto-created from archive document #1 (f1.pdf)",
    }
    assert (bills[3]["issue_date"], bills[3]["due_date"], bills[3]["amount"]) == ("2024-06-30", "2024-07-30", 250)
    assert (bills[4]["issue_date"], bills[4]["due_date"]) == ("soon", "soon")
    assert [r["document_id"] for r in result.skipped.collect()] == [2]
    created = {r["name"]: (r["id"], r["type"]) for r in result.new_contacts.collect()}
    assert set(created) == {"New Co", "Unknown Vendor"}
    assert {number for number, _ in created.values()} == {13, 14}
    assert bills[3]["contact_id"] == created["New Co"][0]
    assert bills[4]["contact_id"] == created["Unknown Vendor"][0]
    updates = {r["document_id"]: r for r in result.updates.collect()}
    assert updates[1]["content"] == "text 1"
    assert updates[2]["content"] is None
    assert [tuple(f) for f in updates[1]["custom_fields"]] == [(1, "2023-01-05"), (2, "19.99"), (3, "")]
    assert updates[2]["correspondent"] == 3
    assert updates[4]["correspondent"] is None
    assert [tuple(f) for f in updates[4]["custom_fields"]] == [(1, "soon"), (2, "3.00")]
    ledger = {r["document_id"]: r for r in result.ledger.collect()}
    assert (ledger[1]["supplier"], ledger[1]["total_amount"]) == ("HARBOUR ropes", 19.99)
    assert ledger[2]["total_amount"] == 0.0


def test_a_document_given_twice_counts_once(spark):
    """Bills, updates and ledger have one row per document, transactions one per item."""
    nothing = spark.createDataFrame([], "id bigint, name string, type string")
    invoice = documents(spark, [entity("total_amount", "3"), entity("supplier_name", "Twice")])
    bills = run_bills(invoice.union(invoice), nothing, nothing.drop("type"), nothing.drop("type"), AS_OF, stamp())
    counted = (bills.bills, bills.updates, bills.ledger, bills.new_contacts, bills.new_correspondents)
    assert [frame.count() for frame in counted] == [1, 1, 1, 1, 1]
    paper = documents(spark, statement([entity("deposit_amount", "1")], [entity("balance", "2")], bank=("Quay",)))
    found = run_statements(paper.union(paper), nothing, AS_OF, stamp())
    counted = (found.transactions, found.updates, found.ledger, found.new_accounts)
    assert [frame.count() for frame in counted] == [2, 1, 1, 1]
    bad = invoice.withColumn("raw_ocr_data", F.lit("junk"))
    assert run_statements(bad.union(bad), nothing, AS_OF, stamp()).rejects.count() == 1
