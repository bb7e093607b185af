"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tools.check_oracle import compare, open_oracle

SF_DIR = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()
QUERIES = {name: run for name, run in contract.queries().items() if name not in contract.TEXT_QUERIES}


@pytest.fixture(scope="module")
def oracle():
    con = open_oracle(SF_DIR)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(ORACLES) - set(contract.TEXT_ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    verdict = compare(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name])
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name",
    [
        "relative_range",
        "footer_drop",
        "payout_shipped_orders",
        "payout_merge_exports",
        "vendor_get_or_create",
        "ledger_antijoin",
        "bill_records",
        "statement_flow",
    ],
)
def test_without_automatic_broadcasts(spark, oracle, name):
    """The joins that large inputs get give the same results."""
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for setting in settings:
        spark.conf.set(setting, "-1")
    try:
        verdict = compare(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name])
    finally:
        for setting in settings:
            spark.conf.unset(setting)
    assert verdict.startswith("ok"), verdict
