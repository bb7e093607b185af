"""Settlement queries: declared expressions over landing tables made from the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.registry import query, table
from docsettle.functions.expressions import NamedExpression, exact, exact_sum
from docsettle.operators.settle import evaluate, settle
from docsettle.sources.config import ExportConfig

OUTLET = "Main Outlet"


def readers(**expressions: str) -> tuple[NamedExpression, ...]:
    return tuple(NamedExpression(name, text) for name, text in expressions.items())


def order_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the order sheet of their supplier."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("document_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_no"),
        F.col("l_orderkey").alias("Order ID"),
        F.col("l_shipdate").alias("Order date"),
        F.col("l_extendedprice").alias("Gross"),
        F.col("l_discount").alias("Discount"),
        F.col("l_tax").alias("Tax"),
        F.col("l_returnflag").alias("Return flag"),
    )


SETTLEMENT = ExportConfig(
    "order_level",
    readers(
        PeriodStart="date_format(min(`Order date`), 'yyyy-MM-dd')",
        PeriodEnd="date_format(max(`Order date`), 'yyyy-MM-dd')",
        SettlementDate="date_format(max(`Order date`), 'yyyy-MM-dd')",
        TotalOrders="count(1)",
        GrossSalesAmt=f"sum({exact('Gross')})",
        RestaurantDiscountAmt=f"sum({exact('Gross')} * {exact('Discount')})",
        TaxesTcsTdsAmt=f"sum({exact('Gross')} * {exact('Tax')})",
        MarketingAdsAmt=f"sum(CASE WHEN `Return flag` = 'R' THEN -{exact('Gross')} ELSE 0 END)",
        FinalPayoutAmt=f"sum({exact('Gross')} * (1 - {exact('Discount')}))",
    ),
)


@query(
    "payout_settlement",
    """
    WITH d AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_discount AS DECIMAL(18,2)) AS discount,
                      CAST(l_tax AS DECIMAL(18,2)) AS rate FROM lineitem),
    s AS (
      SELECT l_suppkey AS document_id, strftime(min(l_shipdate), '%Y-%m-%d') AS a,
             strftime(max(l_shipdate), '%Y-%m-%d') AS b, count(*) AS n,
             sum(price)::DOUBLE AS gross, sum(price * discount)::DOUBLE AS disc, sum(price * rate)::DOUBLE AS tax,
             sum(CASE WHEN l_returnflag = 'R' THEN -price ELSE 0 END)::DOUBLE AS ads,
             sum(price * (1 - discount))::DOUBLE AS fin
      FROM d GROUP BY l_suppkey)
    SELECT s_suppkey AS document_id, 'Main Outlet' AS outlet_name, 'orders' AS platform,
           coalesce(a, '') AS period_start, coalesce(b, '') AS period_end,
           coalesce(b, '') AS settlement_date, coalesce(n, 0) AS total_orders,
           coalesce(gross, 0) AS gross_sales_amt, coalesce(disc, 0) AS restaurant_discount_amt,
           CAST(0 AS DOUBLE) AS platform_commission_amt, coalesce(tax, 0) AS taxes_tcs_tds_amt,
           coalesce(ads, 0) AS marketing_ads_amt,
           coalesce(fin, 0) + coalesce(ads, 0) AS final_payout_amt,
           '' AS utr_number
    FROM supplier LEFT JOIN s ON document_id = s_suppkey
    """,
)
def payout_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("document_id"))
    landings = {"order_level": order_level(spark, sf_dir)}
    return settle(documents, landings, [SETTLEMENT], "orders", OUTLET)


@query(
    "payout_text_amounts",
    """
    WITH t AS (
      SELECT l_suppkey AS document_id,
             CASE l_linenumber WHEN 5 THEN NULL WHEN 4 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS oid,
             CASE l_linenumber WHEN 7 THEN '' WHEN 6 THEN 'n/a'
                  ELSE CAST(l_extendedprice AS VARCHAR) END AS amount,
             CASE WHEN l_tax = 0 THEN '' ELSE CAST(l_tax AS VARCHAR) END AS promo,
             CASE WHEN l_discount = 0 THEN '-' ELSE CAST(l_discount AS VARCHAR) END AS gold
      FROM lineitem)
    SELECT document_id, count(oid) AS total_orders,
           sum(TRY_CAST(NULLIF(amount, '') AS DECIMAL(18,4)))::DOUBLE AS gross_sales_amt,
           coalesce(sum(TRY_CAST(NULLIF(promo, '') AS DECIMAL(18,4)))::DOUBLE, 0)
               + coalesce(sum(TRY_CAST(NULLIF(gold, '') AS DECIMAL(18,4)))::DOUBLE, 0) AS restaurant_discount_amt
    FROM t GROUP BY document_id
    """,
)
def payout_text_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("l_linenumber")
    landing = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("document_id"),
        (F.col("l_orderkey") * 8 + number).alias("row_no"),
        F.when(number == 4, "").when(number != 5, F.col("l_orderkey").cast("string")).alias("Order ID"),
        F.when(number == 7, "")
        .when(number == 6, "n/a")
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("Subtotal"),
        F.when(F.col("l_tax") == 0, "").otherwise(F.col("l_tax").cast("string")).alias("Promo"),
        F.when(F.col("l_discount") == 0, "-")
        .otherwise(F.col("l_discount").cast("string"))
        .alias("Gold"),
    )

    def total(name: str) -> str:
        return exact_sum(f"nullif(`{name}`, '')")

    return evaluate(
        landing,
        readers(
            total_orders="count(`Order ID`)",
            gross_sales_amt=total("Subtotal"),
            restaurant_discount_amt=f"coalesce({total('Promo')}, 0) + coalesce({total('Gold')}, 0)",
        ),
    )


@query(
    "payout_other_charges",
    """
    WITH t AS (
      SELECT o_custkey AS document_id,
             CASE o_orderkey % 4 WHEN 0 THEN '-' || CAST(o_totalprice AS VARCHAR)
                  WHEN 1 THEN '-' || format('{:,.2f}', o_totalprice)
                  WHEN 2 THEN '₹' || CAST(o_totalprice AS VARCHAR)
                  ELSE 'Rs ' || CAST(o_totalprice AS VARCHAR) END AS charge
      FROM orders)
    SELECT document_id, count(*) AS charges,
           sum(TRY_CAST(regexp_replace(charge, '[^0-9.]', '') AS DECIMAL(18,4)))::DOUBLE AS marketing_ads_amt,
           sum(TRY_CAST(regexp_replace(charge, '[^0-9.]', '', 'g') AS DECIMAL(18,4)))::DOUBLE AS all_charges
    FROM t GROUP BY document_id
    """,
)
def payout_other_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, kind = F.col("o_totalprice"), F.col("o_orderkey") % 4
    plain = price.cast("string")
    charge = (
        F.when(kind == 0, F.concat(F.lit("-"), plain))
        .when(kind == 1, F.concat(F.lit("-"), F.format_number(price, 2)))
        .when(kind == 2, F.concat(F.lit("₹"), plain))
        .otherwise(F.concat(F.lit("Rs "), plain))
    )
    landing = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("document_id"),
        F.col("o_orderkey").alias("row_no"),
        charge.alias("Charge"),
    )
    return evaluate(
        landing,
        readers(
            charges="count(1)",
            marketing_ads_amt=exact_sum("strip_first(#2)"),
            all_charges=exact_sum("regexp_replace(#2, '[^0-9.]', '')"),
        ),
    )


@query(
    "payout_key_value",
    """
    SELECT o_custkey AS document_id, max('UTR' || CAST(o_orderkey AS VARCHAR)) AS utr_number,
           max(strftime(o_orderdate, '%Y-%m-%d')) AS settlement_date,
           max(NULLIF(CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END, '')) AS top_priority
    FROM orders GROUP BY o_custkey
    """,
)
def payout_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderpriority"))
    pairs = F.array(
        F.struct(
            F.lit("Bank UTR").alias("label"),
            F.concat(F.lit("UTR"), F.col("o_orderkey").cast("string")).alias("value"),
        ),
        F.struct(
            F.lit("Payout Settlement Date").alias("label"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("value"),
        ),
        F.struct(F.lit("Priority").alias("label"), urgent.alias("value")),
    )
    landing = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("document_id"),
        F.col("o_orderkey").alias("row_no"),
        F.inline(pairs),
    )
    return evaluate(
        landing,
        readers(
            utr_number="max(CASE WHEN #2 = 'Bank UTR' THEN #3 END)",
            settlement_date="max(CASE WHEN #2 = 'Payout Settlement Date' THEN #3 END)",
            top_priority="max(nullif(CASE WHEN #2 = 'Priority' THEN #3 END, ''))",
        ),
    )


@query(
    "payout_dates",
    """
    WITH t AS (
      SELECT o_custkey AS document_id,
             CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                  WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:20:30+05:30'
                  WHEN 2 THEN strftime(o_orderdate, '%Y') || '-02-30'
                  WHEN 3 THEN strftime(o_orderdate, '%Y')
                  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d
      FROM orders)
    SELECT document_id,
           strftime(min(CASE WHEN regexp_matches(d, '^\\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
                             THEN TRY_CAST(d AS TIMESTAMP) END), '%Y-%m-%d') AS period_start,
           strftime(max(CASE WHEN regexp_matches(d, '^\\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
                             THEN TRY_CAST(d AS TIMESTAMP) END), '%Y-%m-%d') AS period_end
    FROM t GROUP BY document_id
    """,
)
def payout_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, day = F.col("o_orderkey") % 5, F.date_format("o_orderdate", "yyyy-MM-dd")
    year = F.date_format("o_orderdate", "yyyy")
    text = (
        F.when(kind == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.concat(day, F.lit("T10:20:30+05:30")))
        .when(kind == 2, F.concat(year, F.lit("-02-30")))
        .when(kind == 3, year)
        .otherwise(day)
    )
    landing = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("document_id"),
        F.col("o_orderkey").alias("row_no"),
        text.alias("Order date"),
    )
    return evaluate(
        landing,
        readers(
            period_start="date_format(min(safe_ts(`Order date`)), 'yyyy-MM-dd')",
            period_end="date_format(max(safe_ts(`Order date`)), 'yyyy-MM-dd')",
        ),
    )


@query(
    "payout_first_row_period",
    """
    WITH t AS (
      SELECT o_custkey AS document_id, o_orderkey,
             CASE WHEN o_orderkey % 17 = 0 THEN 'no period'
                  ELSE strftime(o_orderdate, '%-d %B') || ' - '
                       || strftime(o_orderdate + INTERVAL 6 DAY, '%-d %B') END AS period
      FROM orders),
    f AS (SELECT document_id, arg_min(period, o_orderkey) AS period FROM t GROUP BY document_id)
    SELECT document_id,
           strftime(try_strptime(trim(split_part(period, '-', 1)) || ' 2023', '%d %B %Y'),
                    '%Y-%m-%d') AS period_start,
           strftime(try_strptime(trim(split_part(period, '-', 2)) || ' 2023', '%d %B %Y'),
                    '%Y-%m-%d') AS period_end
    FROM f
    """,
)
def payout_first_row_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.col("o_orderdate") + F.expr("INTERVAL 6 DAYS")
    text = F.when(F.col("o_orderkey") % 17 == 0, "no period").otherwise(
        F.concat_ws(" - ", F.date_format("o_orderdate", "d MMMM"), F.date_format(last, "d MMMM"))
    )
    landing = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("document_id"),
        F.col("o_orderkey").alias("row_no"),
        text.alias("Payout Period"),
    )
    day = "date_format(day_month(split_part(`Payout Period`, '-', {}), 2023), 'yyyy-MM-dd')".format
    return evaluate(landing, readers(period_start=day(1), period_end=day(2)))


@query(
    "payout_merge_exports",
    """
    WITH a AS (SELECT l_suppkey AS k, count(*) AS n, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS gross,
                      max(l_returnflag) AS flag FROM lineitem GROUP BY 1),
         b AS (SELECT o_custkey AS k, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS fin,
                      max(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS utr
               FROM orders GROUP BY 1),
         c AS (SELECT user_id AS k, sum(value::DECIMAL(18,2))::DOUBLE AS ads,
                      strftime(min(ts), '%Y-%m-%d') AS first_day FROM events GROUP BY 1)
    SELECT c_custkey AS document_id, 'Main Outlet' AS outlet_name, 'merged' AS platform,
           coalesce(first_day, '') AS period_start, '' AS period_end, '' AS settlement_date,
           coalesce(b.n, a.n, 0) AS total_orders,
           coalesce(gross, 0) AS gross_sales_amt,
           CAST(0 AS DOUBLE) AS restaurant_discount_amt,
           CAST(0 AS DOUBLE) AS platform_commission_amt,
           CAST(0 AS DOUBLE) AS taxes_tcs_tds_amt,
           coalesce(ads, 0) AS marketing_ads_amt,
           coalesce(fin, 0) + coalesce(ads, 0) AS final_payout_amt,
           coalesce(utr, flag, '') AS utr_number
    FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey
         LEFT JOIN c ON c.k = c_custkey
    """,
)
def payout_merge_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("document_id"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("document_id"),
        F.col("o_orderkey").alias("row_no"),
        "o_totalprice",
        "o_orderstatus",
        "o_orderpriority",
    )
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("document_id"), F.col("event_id").alias("row_no"), "ts", "value"
    )
    landings = {"lines": order_level(spark, sf_dir), "orders": orders, "events": events}
    exports = [
        ExportConfig(
            "lines",
            readers(TotalOrders="count(1)", GrossSalesAmt=f"sum({exact('Gross')})", UtrNumber="max(`Return flag`)"),
        ),
        ExportConfig("unread"),
        ExportConfig("orders", readers(totalorders="count(1)", FinalPayoutAmt=f"sum({exact('o_totalprice')})")),
        ExportConfig(
            "orders",
            readers(UtrNumber="max(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END)"),
        ),
        ExportConfig(
            "events",
            readers(
                marketing_ads_amt=f"sum({exact('value')})",
                period_start="date_format(min(ts), 'yyyy-MM-dd')",
                no_such_field="count(1)",
            ),
        ),
    ]
    return settle(documents, landings, exports, "merged", OUTLET)


@query(
    "positional_columns",
    """
    SELECT l_suppkey AS document_id, min(l_orderkey) AS first_order,
           strftime(max(l_shipdate), '%Y-%m-%d') AS last_day,
           sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS gross, '#2' AS quoted
    FROM lineitem GROUP BY l_suppkey
    """,
)
def positional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(
        order_level(spark, sf_dir),
        readers(
            first_order="min(#2)",
            last_day="date_format(max(#3), 'yyyy-MM-dd')",
            gross=f"CAST(sum({exact('#4')}) AS DOUBLE)",
            quoted="max('#2')",
        ),
    )
