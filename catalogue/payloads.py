"""Payload queries: JSON bodies in all envelopes, and settlements from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query, table
from catalogue.settlements import OUTLET
from docsettle.operators.landing import land_payload_blocks
from docsettle.plans.payouts import settle_payloads
from docsettle.plans.platforms import named_column_platform
from docsettle.sources.payloads import payload_blocks, unreadable_payloads


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


@query(
    "row_envelopes",
    """
    SELECT o_orderkey AS document_id, 1 AS row_no, CAST(o_orderkey AS VARCHAR) AS order_id,
           regexp_replace(CAST(o_totalprice AS VARCHAR), '[.]0$', '') AS amount,
           o_orderstatus AS status
    FROM orders WHERE o_orderkey % 4 < 3
    UNION ALL
    SELECT o_orderkey, 2, 'late ' || CAST(o_orderkey AS VARCHAR), NULL, o_orderpriority
    FROM orders WHERE o_orderkey % 4 < 3
    """,
)
def row_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a body of two rows in one of the three envelopes, or as a broken one.

    JSON numbers land in their plain form, without a trailing ``.0``.
    """
    key, price = text("o_orderkey"), text("o_totalprice")
    rows = F.concat(
        F.lit('[{"Order ID": '), key, F.lit(', "Amount\\n": '), price, F.lit(', "Status": "'),
        F.col("o_orderstatus"), F.lit('"}, {"Status": "'), F.col("o_orderpriority"),
        F.lit('", "Extra": 1, "Order ID": "late '), key, F.lit('"}]'),
    )
    kind = F.col("o_orderkey") % 4
    given = '{"headers": ["Status", "Order ID", "Amount\\n"], "data": '
    body = (
        F.when(kind == 0, F.concat(F.lit(given), rows, F.lit("}")))
        .when(kind == 1, F.concat(F.lit('{"sheet": "s", "data": '), rows, F.lit("}")))
        .when(kind == 2, rows)
        .otherwise(F.concat(F.lit('{"data": null, "rows": '), rows, F.lit("}")))
    )
    payloads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("document_id"), body.alias("body")
    )
    landed = land_payload_blocks(payload_blocks(payloads), ["Order ID", "Amount", "Status"])
    return landed.select(
        "document_id",
        F.col("row_no").cast("int"),
        F.col("Order ID").alias("order_id"),
        F.col("Amount").alias("amount"),
        F.col("Status").alias("status"),
    )


@query(
    "unreadable_payloads",
    """
    SELECT o_orderkey AS document_id FROM orders WHERE o_orderkey % 5 <> 0
    """,
)
def broken_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that fit no envelope: null data, other JSON, cut JSON, mixed rows."""
    key = text("o_orderkey")
    kind = F.col("o_orderkey") % 5
    body = (
        F.when(kind == 0, F.concat(F.lit('[{"k": '), key, F.lit("}]")))
        .when(kind == 1, F.concat(F.lit('{"data": null, "k": '), key, F.lit("}")))
        .when(kind == 2, F.concat(F.lit('{"k": '), key, F.lit("}")))
        .when(kind == 3, F.concat(F.lit('{"data": [{"k": '), key))
        .otherwise(F.concat(F.lit('{"data": [{"k": '), key, F.lit("}, [1, 2]]}")))
    )
    payloads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("document_id"), body.alias("body")
    )
    return unreadable_payloads(payloads).select("document_id")


@query(
    "pair_pivot",
    """
    SELECT o_orderkey AS document_id, 'C' || CAST(o_custkey AS VARCHAR) AS res_id,
           regexp_replace(CAST(o_totalprice AS VARCHAR), '[.]0$', '') AS total,
           o_orderpriority AS priority
    FROM orders WHERE o_orderkey % 9 <> 0
    """,
)
def pair_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 9 == 0, "#REF!").otherwise(F.col("o_orderpriority"))
    body = F.concat(
        F.lit('{"data": [["Res id", "old"], ["Total \\nOrders", '), text("o_totalprice"),
        F.lit('], ["", 1], ["odd"], [5, 6], ["Priority", "'), status,
        F.lit('"], ["Res id", "C'), text("o_custkey"), F.lit('"]], "sheet": "Summary"}'),
    )
    payloads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("document_id"), body.alias("body")
    )
    landed = land_payload_blocks(payload_blocks(payloads), ["Res id", "Total  Orders", "Priority"])
    return landed.select(
        "document_id",
        F.col("Res id").alias("res_id"),
        F.col("Total  Orders").alias("total"),
        F.col("Priority").alias("priority"),
    )


@query(
    "payout_shipped_named",
    """
    WITH t AS (SELECT o_orderkey // 32 AS d, * FROM orders WHERE o_orderkey % 13 <> 0)
    SELECT d AS document_id, 'Main Outlet' AS outlet_name, 'zomato' AS platform,
           strftime(min(o_orderdate), '%Y-%m-%d') AS period_start,
           strftime(max(o_orderdate), '%Y-%m-%d') AS period_end,
           strftime(max(o_orderdate) + INTERVAL 2 DAY, '%Y-%m-%d') AS settlement_date,
           count(*) AS total_orders,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS gross_sales_amt,
           coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice::DECIMAL(18,2) END)::DOUBLE, 0)
               + coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN 5 END)::DOUBLE, 0)
               AS restaurant_discount_amt,
           CAST(coalesce(sum(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END), 0) AS DOUBLE)
               AS platform_commission_amt,
           CAST(sum(o_custkey) AS DOUBLE) AS taxes_tcs_tds_amt,
           CAST(-count(*) AS DOUBLE) AS marketing_ads_amt,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE - count(*) AS final_payout_amt,
           max('UTR' || CAST(o_custkey AS VARCHAR)) AS utr_number
    FROM t GROUP BY d
    """,
)
def payout_shipped_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipped named-column platform over one payload per 32 orders.

    The order of the rows in a body does not matter here, and a body has 32 rows at most.
    """
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    columns = {
        "Order ID": text("o_orderkey"),
        "Order date": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "Subtotal (items total)": price,
        "Restaurant discount (Promo)": F.when(status == "F", text(price)).otherwise(""),
        "Restaurant discount (BOGO, Freebies, Gold, Brand pack & others)": F.when(
            status == "O", F.lit("5")
        ).otherwise("n/a"),
        "Service fee & payment mechanism fee\n[(13) + (15) - (16) - (17) + (18)]": F.when(
            status != "P", F.col("o_custkey")
        ),
        "Government charges\n[(19) + (22) + (23) + (24) + (25)]": text("o_custkey"),
        "Extra inventory ads (order level deduction)": F.lit(-1),
        "Order level Payout\n(A) - (F) + (G)": F.when(F.col("o_orderkey") % 13 == 0, "#REF!").otherwise(
            text(price)
        ),
        "Bank UTR": F.concat(F.lit("UTR"), text("o_custkey")),
        "Settlement date": F.date_format(
            F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS"), "yyyy-MM-dd"
        ),
    }
    row = F.to_json(
        F.struct(*[column.alias(name) for name, column in columns.items()]),
        {"ignoreNullFields": "false"},
    )
    payloads = (
        table(spark, sf_dir, "orders")
        .groupBy(F.expr("o_orderkey div 32").alias("document_id"))
        .agg(F.array_join(F.collect_list(row), ",").alias("rows"))
        .select(
            "document_id",
            F.lit(0).alias("import_no"),
            F.concat(F.lit('{"data": ['), "rows", F.lit("]}")).alias("body"),
        )
    )
    documents = payloads.select("document_id")
    config = named_column_platform()
    return settle_payloads(documents, payloads, "zomato", config, OUTLET)
