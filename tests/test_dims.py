import pytest
from pyspark.sql import functions as F

from docsettle.operators import dims, ledger, lookups
from docsettle.operators.landing import write_table


@pytest.fixture
def contacts(spark):
    return spark.createDataFrame(
        [(10, "Harbour Ropes", "vendor"), (11, "HARBOUR ropes", "vendor"), (12, "Beta", "vendor"), (13, "New Co", "customer")],
        "id bigint, name string, type string",
    )


def vendors(spark, contacts, names):
    bills = spark.createDataFrame(list(enumerate(names)), "document_id bigint, supplier string")
    result = dims.get_or_create_vendors(bills, contacts)
    ids = {r["document_id"]: r["contact_id"] for r in result.rows.collect()}
    return [ids[n] for n in range(len(names))], result.created


def test_vendors(spark, contacts):
    ids, created = vendors(spark, contacts, ["harbour ROPES", "New Co", "NEW co", "", None, "beta"])
    made = {r["name"]: r["id"] for r in created.collect()}
    assert set(made) == {"New Co", "Unknown Vendor"}
    assert set(made.values()) == {14, 15}
    unknown = made["Unknown Vendor"]
    assert ids == [10, made["New Co"], made["New Co"], unknown, unknown, 12]


def test_empty_dimension_and_no_rows(spark, contacts):
    ids, created = vendors(spark, contacts.where("id < 0"), ["New Corp"])
    assert ids == [1]
    assert [tuple(r) for r in created.collect()] == [(1, "New Corp", "vendor")]
    assert vendors(spark, contacts, [])[0] == []


def test_hot_names_and_many_new_ids(spark, contacts, monkeypatch):
    """Half of the rows share one name; only that one fits into the hot keys."""
    monkeypatch.setattr(lookups, "HOT_KEYS", 1)
    names = ["hot"] * 500 + [f"n{n % 300}" for n in range(500)]
    ids, created = vendors(spark, contacts, names)
    assert len(set(ids)) == 301
    assert sorted(set(ids)) == list(range(14, 315))
    assert ids == [dict(zip(names, ids, strict=True))[name] for name in names]
    assert created.count() == 301


def test_correspondents_leave_nameless_documents_alone(spark):
    rows = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "B")], "document_id bigint, supplier string")
    known = spark.createDataFrame([(5, "A")], "id bigint, name string")
    result = dims.get_or_create_correspondents(rows, known)
    found = {r["document_id"]: r["correspondent"] for r in result.rows.collect()}
    assert found == {1: 5, 2: None, 3: None, 4: 6}
    assert [tuple(r) for r in result.created.collect()] == [(6, "B")]


def test_entries_of_earlier_batches_are_known(spark, contacts, tmp_path):
    """A name that a batch creates is found by the next one; a repeated batch gives the same ids."""
    root, ids = str(tmp_path / "out"), {}
    for batch_id, names in [(0, ["First", "beta"]), (1, ["Second", "FIRST"]), (1, ["Second", "FIRST"]), (2, ["second"])]:
        found, created = vendors(spark, dims.known_entries(contacts, root, "contacts", batch_id), names)
        write_table(created, root, "contacts", batch_id)
        assert ids.setdefault(batch_id, found) == found
    assert ids == {0: [14, 12], 1: [15, 14], 2: [15]}


def test_platforms(spark):
    documents = spark.createDataFrame(
        [(1, [3, 2, 1]), (2, [9]), (3, []), (4, None)], "document_id bigint, tags array<int>"
    )
    found = dims.resolve_platform(documents, {1: "one", 2: "two"}).orderBy("document_id").collect()
    assert [r["platform"] for r in found] == ["two", None, None, None]
    assert {r["platform"] for r in dims.resolve_platform(documents, {}).collect()} == {None}


def test_processable(spark):
    names = [("a.XLSX", "p"), ("a.xls", "p"), ("a.xlsx", None), ("a.xlsx.pdf", "p"), ("xlsx", "p")]
    frame = spark.createDataFrame(names, "n string, p string")
    flags = frame.select(dims.is_processable(F.col("n"), F.col("p"))).collect()
    assert [r[0] for r in flags] == [True, True, False, False, False]


def test_ledger_excludes_by_kind_and_document(spark):
    batch = spark.createDataFrame([("bill", 1), ("payout", 1), ("bill", 2)], "kind string, document_id bigint")
    done = spark.createDataFrame([("bill", 1), ("bill", 1), ("bill", 9)], "kind string, document_id bigint")
    left = ledger.exclude_processed(batch, done).collect()
    assert {tuple(r) for r in left} == {("payout", 1), ("bill", 2)}


def test_first_requests(spark):
    rows = [("bill", 1, 5, "late"), ("bill", 1, 2, "early"), ("payout", 1, 9, "other")]
    frame = spark.createDataFrame(rows, "kind string, document_id bigint, at int, doc_url string")
    found = ledger.first_requests(frame, "at")
    assert found.columns == frame.columns
    assert {tuple(r) for r in found.collect()} == {rows[1], rows[2]}
