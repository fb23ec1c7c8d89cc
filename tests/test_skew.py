"""Hot keys: results stay whole and exact, and the hot key is spread out."""

from pyspark.sql import functions as F

from tests.fixtures import customer, order, payment, project
from tillbook.operators import core
from tillbook.operators.skew import hot_keys, salted_left_join


def _hot_project(spark, n=3000):
    custs = [customer(c, segment="HOT" if c == 1 else "COLD") for c in range(1, 201)]
    # customer 1 owns a third of the orders and, through them, a third of the
    # payments; order 7 (another customer's) owns another third of the payments
    orders = [order(k, 1 if k % 3 == 0 else (k % 199) + 2) for k in range(1, n + 2)]
    target = {0: lambda k: 7, 1: lambda k: k, 2: lambda k: k + 1}
    pays = [payment(f"p{k}", target[k % 3](k), amount=1.0 + k % 50) for k in range(1, n + 1)]
    return project(spark, customer=custs, orders=orders, raw_payments=pays)


def test_hot_keys_follow_their_size(spark):
    df = spark.range(10000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    assert [(r.k, r["_salts"]) for r in hot_keys(df, "k", 1000).collect()] == [(0, 4)]
    assert [(r.k, r["_salts"]) for r in hot_keys(df, "k", 100).collect()] == [(0, 34)]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("k"), F.col("id").alias("row")
    )
    right = spark.createDataFrame([(k, f"v{k}") for k in range(1, 40)] + [(1, "dup"), (None, "null")], "k long, v string")
    for how in ("left", "inner"):
        salted = salted_left_join(left, right, "k", F.col("row"), rows_per_task=100, how=how)
        plain = left.join(right, "k", how)
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.select(salted.columns).collect()))


def test_hot_and_null_keys_are_spread(spark):
    """A third of the rows have one key, a third none: no task of the join gets a third of the rows."""
    saved = {k: spark.conf.get(k, None) for k in (*SMALL_DATA_SKEW, "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), F.col("id").alias("row"))
        right = spark.range(9000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        joined = salted_left_join(left, right, "k", F.col("row"), rows_per_task=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 9000 and max(sizes) < 1500


SMALL_DATA_SKEW = {
    # make broadcast impossible and AQE's skew thresholds match fixture sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_revenue_with_hot_customer_and_order(spark):
    saved = {k: spark.conf.get(k, None) for k in SMALL_DATA_SKEW}
    for k, v in SMALL_DATA_SKEW.items():
        spark.conf.set(k, v)
    try:
        p = _hot_project(spark)
        df = core.fct_revenue(p.table("paid_orders"), p.table("int_customer_lifetime"), p.as_of_sql, rows_per_task=200)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan  # AQE split the hot order
    assert len(rows) == 3000  # captured payments of known orders: all of them
    by_segment = {}
    for r in rows:
        by_segment[r["customer_segment"]] = by_segment.get(r["customer_segment"], 0) + 1
    assert by_segment["HOT"] >= 1000 and None not in by_segment
    assert "_salt" in plan  # the customer join runs on (customer, salt)
