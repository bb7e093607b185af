import pytest
from pyspark.sql import functions as F

from docsettle.operators import landing
from docsettle.plans.payouts import run_payouts, settle_payloads
from docsettle.sources.config import platforms_from_json
from docsettle.sources.payloads import REPEATED_KEYS, block_rows, payload_blocks, row_value, unreadable_payloads


def parse(spark, *bodies):
    frame = spark.createDataFrame(list(enumerate(bodies)), "document_id bigint, body string")
    rows = block_rows(payload_blocks(frame)).withColumn("vals", F.transform("names", row_value))
    rows = rows.orderBy("document_id", "row_no").collect()
    return [(r["document_id"], r["row_no"], r["names"], r["vals"]) for r in rows], frame


def test_given_headers_decide_columns_and_order(spark):
    """Headers come last in the body, name a column no row has, and leave out a key that rows have."""
    body = '{"data": [{"knots": 3, "buoy": "east", "crew": 9}, {"buoy": null, "draft": 1.25}], "headers": ["buoy", " draft\\n", "knots", "mast"]}'
    names = ["buoy", "draft", "knots", "mast"]
    found, _ = parse(spark, body)
    assert found == [(0, 1, names, ["east", None, "3", None]), (0, 2, names, [None, "1.25", None, None])]


def test_bare_and_empty(spark):
    found, _ = parse(spark, '[{"Date": "d", "Amount": 1.5}, {"Date": null}]', "[]", '{"data": []}')
    assert found == [(0, 1, ["Date", "Amount"], ["d", "1.5"]), (0, 2, ["Date", "Amount"], [None, None])]


def test_line_break_in_a_name(spark):
    body = '{"data": [{"Order date": "d", "Order level Payout\\n(A) - (F) + (G)": 1.5}]}'
    found, _ = parse(spark, body)
    assert found[0][2] == ["Order date", "Order level Payout (A) - (F) + (G)"]
    assert found[0][3] == ["d", "1.5"]


def test_first_row_decides_the_order_even_if_it_is_dropped(spark):
    body = (
        '{"data": [{"tide": "#REF!", "berth": 14, "crane": 15}, {"crane": 26, "berth": 25, "tide": 24},'
        ' {"tide": 37, "berth": "#REF!"}, {"tide": "near #REF!"}]}'
    )
    names = ["tide", "berth", "crane"]
    found, _ = parse(spark, body)
    assert found == [(0, 2, names, ["24", "25", "26"]), (0, 4, names, ["near #REF!", None, None])]


def test_pairs_become_one_row(spark):
    body = (
        '{"data": [["Quarter", "April to June"], ["Depot", "north"],'
        ' ["Crates \\n(unloaded)", 42], ["Weight", 310.75], ["Depot", "south"], ["x"], [5, 6],'
        ' [" ", 1], null], "sheet": "Summary"}'
    )
    found, _ = parse(spark, body)
    assert found == [
        (
            0,
            1,
            ["Quarter", "Depot", "Crates  (unloaded)", "Weight"],
            ["April to June", "south", "42", "310.75"],
        )
    ]


def test_pairs_with_a_formula_error_are_dropped_unless_overwritten(spark):
    found, _ = parse(
        spark, '{"data": [["k", "#REF!"]]}', '{"data": [["k", "#REF!"], ["k", "ok"]]}'
    )
    assert found == [(1, 1, ["k"], ["ok"])]


@pytest.mark.parametrize(
    "body", ['{"data": null}', "{}", "junk", "[[1, 2]]", '{"data": [{"a": 1}, [1, 2]]}', '{"data": 5}']
)
def test_unreadable(spark, body):
    found, frame = parse(spark, body)
    assert found == []
    assert unreadable_payloads(frame).count() == 1


def test_land_blocks_by_name_by_position_and_rejected(spark):
    bodies = ['[{"a": 1, "b": 2}]', '[{"B": 3}]', '[{"x": 4, "y": 5}]', '[{"x": 1, "y": 2, "z": 3}]']
    frame = spark.createDataFrame(list(enumerate(bodies)), "document_id bigint, body string")
    landed = landing.land_payload_blocks(payload_blocks(frame), ["a", "b"])
    rows = [tuple(row) for row in landed.orderBy("document_id").collect()]
    assert rows == [(0, 1, "1", "2"), (1, 1, None, "3"), (2, 1, "4", "5")]
    assert landing.first_payload_columns(frame) == ["a", "b"]


def test_first_columns_skip_empty_payloads(spark):
    frame = spark.createDataFrame([(1, "[]"), (2, "junk"), (3, '[{"k": 1}]')], "document_id bigint, body string")
    assert landing.first_payload_columns(frame) == ["k"]
    assert landing.first_payload_columns(frame.limit(1)) == []


def test_settle_payloads_with_footer(spark):
    config = platforms_from_json(
        """{"platforms": {"p": {"method": "libreoffice",
             "import_configs": [{"table_name": "t", "sheet": "S", "range": "A1:B", "footer": true}],
             "export_configs": [{"table_name": "t", "reader_configs": [
                {"column_name": "TotalOrders", "expression": "count(`id`)"},
                {"column_name": "GrossSalesAmt", "expression": "sum(safe_double(nullif(`amt`, '')))"}]}]}}}"""
    )["p"]
    bodies = [
        (1, 0, '[{"id": "a", "amt": "1.5"}, {"id": "b", "amt": "x"}, {"id": "sum", "amt": "9"}]'),
        (2, 0, "[]"),
    ]
    payloads = spark.createDataFrame(bodies, "document_id bigint, import_no int, body string")
    documents = payloads.select("document_id")
    rows = settle_payloads(documents, payloads, "p", config, "Out").orderBy("document_id").collect()
    assert [(r["total_orders"], r["gross_sales_amt"]) for r in rows] == [(2, 1.5), (0, 0.0)]


@pytest.mark.parametrize("setting", ["false", "true"])
def test_repeated_keys_in_any_session(spark, setting):
    """Which payloads are readable does not depend on who built the session, nor does reading them change it."""
    spark.conf.set(REPEATED_KEYS, setting)
    try:
        bodies = ['{"data": [{"a": 1, "a": 2, "b": "x"}]}', '\n[{"a": 5}, null]', '{"data": [["a", 1], ["a", 2]], "data2": 1, "data2": 2}', '{"data": [5]}']
        frame = spark.createDataFrame(list(enumerate(bodies)), "document_id bigint, body string")
        rows = block_rows(payload_blocks(frame)).select("document_id", row_value(F.lit("a")).alias("a")).orderBy("document_id", "row_no")
        assert [tuple(r) for r in rows.collect()] == [(0, "2"), (1, "5"), (1, None), (2, "2")]
        assert [r[0] for r in unreadable_payloads(frame).select("document_id").collect()] == [3]
        assert spark.conf.get(REPEATED_KEYS) == setting
    finally:
        spark.conf.unset(REPEATED_KEYS)


def test_a_run_builds_documents_and_payloads_once(spark):
    """Names, faults, rows and ledger ask for both, and what they are made of may be dear."""
    config = platforms_from_json(
        """{"platforms": {"p": {"method": "libreoffice", "import_configs": [{"table_name": "t", "sheet": "S", "range": "A1:B"}],
             "export_configs": [{"table_name": "t", "reader_configs": [
                {"column_name": "TotalOrders", "expression": "count(`id`)"}]}]}}}"""
    )
    made = {name: spark.sparkContext.accumulator(0) for name in ("documents", "payloads")}

    def counted(frame, name):
        seen = made[name]

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return frame.mapInArrow(count, frame.schema)

    documents = spark.createDataFrame([(1, "a.xlsx", [5]), (2, "b.xlsx", [5])], "document_id bigint, media_filename string, tags array<int>")
    payloads = spark.createDataFrame(
        [(1, 0, '[{"id": "a", "x": 1}, {"id": "b", "x": 2}]'), (2, 0, "junk")], "document_id bigint, import_no int, body string"
    )
    tags = spark.createDataFrame([(5, "p")], "id int, name string")
    stamp = F.lit("2024-06-30 12:00:00").cast("timestamp_ntz")
    result = run_payouts(counted(documents, "documents"), tags, config, None, counted(payloads, "payloads"), "Out", stamp)
    assert [(r["document_id"], r["total_orders"]) for r in result.settlements.collect()] == [(1, 2)]
    assert [r["document_id"] for r in result.ledger.collect()] == [1]
    assert [(r["document_id"], r["reason"]) for r in result.rejects.collect()] == [(2, "unreadable payload")]
    assert {name: seen.value for name, seen in made.items()} == {"documents": 2, "payloads": 2}
