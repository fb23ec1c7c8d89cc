"""Data-quality checks find planted violations and never abort the run."""

from tillbook.operators.quality import CHECKS, run_checks
from tests.fixtures import customer, order, project


def test_check_inventory():
    tests = [c.test for c in CHECKS]
    assert len(CHECKS) == 64
    assert (tests.count("unique"), tests.count("not_null"), tests.count("accepted_values")) == (25, 38, 1)


def test_planted_violations(spark):
    p = project(
        spark,
        customer=[customer(1), customer(1), customer(2, name=None)],
        orders=[order(1, 1), order(1, 1), order(2, None, status="F"), order(None, 1)],
    )
    checks = [c for c in CHECKS if c.table in ("customer", "orders", "stg_orders")]
    got = {(r["table_name"], r["column_name"], r["test_name"]): (r["failures"], r["passed"])
           for r in run_checks(p, checks=checks).collect()}
    assert got[("customer", "c_custkey", "unique")] == (1, False)
    assert got[("customer", "c_name", "not_null")] == (1, False)
    assert got[("orders", "o_orderkey", "unique")] == (1, False)
    assert got[("orders", "o_orderkey", "not_null")] == (1, False)
    assert got[("orders", "o_custkey", "not_null")] == (1, False)
    assert got[("stg_orders", "order_status", "accepted_values")] == (0, True)


def test_unlisted_status_and_dual_reporting(spark):
    p = project(
        spark,
        orders=[order(1, 1)],
        raw_payments=[{"payment_id": "x", "order_id": 1}, {"payment_id": "x", "order_id": None}],
    )
    # an accepted-values failure needs a status the staging CASE cannot produce: check the raw column
    from tillbook.operators.quality import Check

    bad = p.table("stg_orders").withColumnRenamed("order_status", "s")
    p.use("stg_orders", bad.selectExpr("*", "'lost' AS order_status"))
    rows = run_checks(p, checks=[c for c in CHECKS if c.table in ("stg_orders", "raw_payments")]).collect()
    got = {(r["resource_type"], r["table_name"], r["column_name"], r["test_name"]): r["failures"] for r in rows}
    assert got[("model", "stg_orders", "order_status", "accepted_values")] == 1
    # one computation, reported for the source and the seed
    assert got[("source", "raw_payments", "payment_id", "unique")] == 1
    assert got[("seed", "raw_payments", "payment_id", "unique")] == 1
    assert got[("source", "raw_payments", "order_id", "not_null")] == 1
    assert Check("seed", "raw_payments", "payment_id", "not_null") in CHECKS
