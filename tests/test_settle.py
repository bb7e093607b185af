import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from docsettle.functions.expressions import NamedExpression, exact_sum
from docsettle.operators import landing
from docsettle.operators.settle import evaluate, settle
from docsettle.sources.config import ExportConfig


def export(table, **expressions):
    return ExportConfig(table, tuple(NamedExpression(*pair) for pair in expressions.items()))


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [(1, 5, "2024-01-02", "10.5", ""), (1, 4, "2024-01-01", "1", "u1"), (2, 1, "2024-03-01", "x", "u2")],
        "document_id bigint, row_no bigint, day string, amount string, utr string",
    )


def test_aggregates_and_positions(orders):
    rows = evaluate(
        orders,
        export(
            "t", a="min(#2)", b="sum(safe_double(#3))", c="count(utr)", d="max(nullif(utr, ''))"
        ).reader_configs,
    )
    found = {row["document_id"]: tuple(row)[1:] for row in rows.collect()}
    assert found == {1: ("2024-01-01", 11.5, 2, "u1"), 2: ("2024-03-01", None, 1, "u2")}


def test_plain_expressions_take_the_first_row(orders):
    rows = evaluate(orders, export("t", day="day", twice="concat(amount, amount)").reader_configs)
    assert {tuple(row) for row in rows.collect()} == {(1, "2024-01-01", "11"), (2, "2024-03-01", "xx")}


def test_merge_order_defaults_and_finalise(spark, orders):
    documents = spark.createDataFrame([(1,), (2,), (3,)], "document_id bigint")
    exports = [
        export("t", UtrNumber="max(utr)", FINALPAYOUTAMT="sum(safe_double(amount))", nothing="1"),
        export("t", utrnumber="max(CASE WHEN document_id = 1 THEN 'late' END)", PeriodStart="min(day)"),
        ExportConfig("absent"),
        export("t", MarketingAdsAmt="max('-2.5')", TotalOrders="max('3 orders')"),
    ]
    rows = settle(documents, {"t": orders}, exports, "p", "Out").orderBy("document_id").collect()
    assert [row["utr_number"] for row in rows] == ["late", "u2", ""]
    assert [row["period_start"] for row in rows] == ["2024-01-01", "2024-03-01", ""]
    assert [row["marketing_ads_amt"] for row in rows] == [-2.5, -2.5, 0.0]
    assert [row["final_payout_amt"] for row in rows] == [9.0, -2.5, 0.0]
    assert [row["total_orders"] for row in rows] == [0, 0, 0]
    assert [row["gross_sales_amt"] for row in rows] == [0.0, 0.0, 0.0]


def test_one_document_alone_equals_the_same_in_a_batch(spark, orders):
    exports = [export("t", GrossSalesAmt="sum(safe_double(amount))", PeriodEnd="max(day)")]
    documents = orders.select("document_id").distinct()
    batch = {r["document_id"]: r for r in settle(documents, {"t": orders}, exports, "p", "o").collect()}
    for number, row in batch.items():
        alone = orders.where(F.col("document_id") == number)
        ids = alone.select("document_id").distinct()
        assert settle(ids, {"t": alone}, exports, "p", "o").collect() == [row]


def test_exports_over_one_table_are_one_aggregation(orders):
    documents = orders.select("document_id").distinct()
    exports = [export("t", UtrNumber="max(utr)"), export("t", PeriodEnd="max(day)")]
    plan = settle(documents, {"t": orders}, exports, "p", "o")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Aggregate [document_id") == 2  # the documents and the table


def test_append(spark):
    target = spark.createDataFrame([(1, 1, "p1", "q1")], "document_id bigint, row_no bigint, p string, q string")
    subset = spark.createDataFrame([(2, 1, "q2")], "document_id bigint, row_no bigint, Q string")
    renamed = target.toDF("document_id", "row_no", "p", "zz")
    rows = landing.append(landing.append(target, subset), renamed).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1, 1, "p1", "q1"), (2, 1, None, "q2"), (1, 1, "p1", "q1")], key=str
    )
    with pytest.raises(ValueError):
        landing.append(target, target.withColumn("zz", F.lit(1)))


def test_writing_a_batch_again_replaces_it(spark, tmp_path, orders):
    for _ in range(2):
        landing.write_table(orders, str(tmp_path), "t", 1)
    landing.write_table(orders.where("document_id = 2"), str(tmp_path), "t", 2)
    back = landing.read_table(spark, str(tmp_path), "t")
    assert {(r["batch_id"], r["count"]) for r in back.groupBy("batch_id").count().collect()} == {(1, 3), (2, 1)}


def test_exact_sums(spark):
    """The same to the last bit however rows are dealt; values that are no decimals fall back to doubles."""
    rng = random.Random(3)
    texts = [f"{rng.uniform(-1e6, 1e6):.6f}" for _ in range(3_000)] + ["0.1"] * 500 + ["", "n/a", None, "1e3", " 7 "]
    rows = [(1, k, t) for k, t in enumerate(texts)] + [(2, 1, "1e30"), (2, 2, "1"), (3, 1, "inf"), (3, 2, "5"), (4, 1, "x"), (5, 1, "0.1234567")]
    readers = [NamedExpression("total", exact_sum("nullif(#2, '')"))]
    found = []
    for parts in (1, 7, 211):
        landing = spark.createDataFrame(rows, "document_id bigint, row_no bigint, amount string").repartition(parts)
        found.append({r["document_id"]: r["total"] for r in evaluate(landing, readers).collect()})
    assert found[0] == found[1] == found[2]
    exact = sum(Fraction(t.strip()) for t in texts if t not in ("", "n/a", None, "1e3")) + 1000
    assert found[0] == {1: float(exact), 2: 1e30, 3: float("inf"), 4: None, 5: 0.1234567}
