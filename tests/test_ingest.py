"""The daily append is idempotent per table, in batch and in streaming form."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillbook.plans.graph import Project
from tillbook.session import run_folder
from tillbook.sources.schemas import RAW_SCHEMAS
from tillbook.sources.tables import BATCH_DATE, land, read_landed
from tillbook.streaming import daily
from tillbook.streaming.stream import stream_append


def _land(spark, p, raw_dir, tables=daily.BATCH_TABLES):
    for t in tables:
        land(p.table(t), raw_dir, t, mode="overwrite")


def _count(spark, raw_dir, t):
    return read_landed(spark, raw_dir, t).count()


def test_batch_is_deterministic_and_sized(spark):
    p = Project.from_dir(spark, SF_SMALL)
    b1 = daily.daily_batches(p.sources, p.as_of_text)
    b2 = daily.daily_batches(Project.from_dir(spark, SF_SMALL).sources, p.as_of_text)
    for t, n in daily.BATCH_ROWS.items():
        rows = sorted(map(tuple, b1[t].collect()))
        assert len(rows) == n
        assert rows == sorted(map(tuple, b2[t].collect()))
        assert b1[t].where(~F.col(daily.KEYS[t]).startswith(daily.batch_prefix(t, p.as_of_text))).count() == 0


def test_append_twice_and_partial_recovery(spark):
    p = Project.from_dir(spark, SF_SMALL)
    raw_dir = run_folder(spark, "test-append") + "/raw"
    _land(spark, p, raw_dir)
    base = {t: _count(spark, raw_dir, t) for t in daily.BATCH_TABLES}
    batches = daily.daily_batches(p.sources, p.as_of_text)

    # a crashed run: only payments got appended
    first = daily.append_daily_batch(spark, raw_dir, batches, p.as_of_text, tables=("raw_payments",))
    assert first[0].appended == 100
    # the next run skips payments and fills the other two tables
    second = {r.table: r for r in daily.append_daily_batch(spark, raw_dir, batches, p.as_of_text)}
    assert second["raw_payments"].skipped_existing and second["raw_payments"].appended == 0
    assert second["raw_shipments"].appended == 75 and second["raw_marketing_clicks"].appended == 150
    # and a third run adds nothing
    third = daily.append_daily_batch(spark, raw_dir, batches, p.as_of_text)
    assert all(r.appended == 0 for r in third)
    for t in daily.BATCH_TABLES:
        assert _count(spark, raw_dir, t) == base[t] + daily.BATCH_ROWS[t]


def test_row_level_guard_drops_existing_keys(spark):
    p = Project.from_dir(spark, SF_SMALL)
    batch = daily.daily_batches(p.sources, p.as_of_text)["raw_payments"]
    target = p.table("raw_payments").unionByName(batch.limit(10))
    assert daily.new_rows(batch, target, "payment_id").count() == 90


def test_stream_replay_lands_once(spark):
    p = Project.from_dir(spark, SF_SMALL)
    root = run_folder(spark, "test-stream")
    raw_dir, landing, ckpt = f"{root}/raw", f"{root}/landing", f"{root}/ckpt"
    _land(spark, p, raw_dir, tables=("raw_payments",))
    base = _count(spark, raw_dir, "raw_payments")
    batch = daily.daily_batches(p.sources, p.as_of_text)["raw_payments"]
    for _ in range(2):  # the same file is delivered twice
        batch.withColumn(BATCH_DATE, daily.batch_day(p.as_of_text)).write.mode("append").parquet(f"{landing}/raw_payments")
        stream_append(spark, landing, raw_dir, ckpt, tables=("raw_payments",))
    assert _count(spark, raw_dir, "raw_payments") == base + 100


def test_stream_replay_after_lost_checkpoint(spark):
    p = Project.from_dir(spark, SF_SMALL)
    root = run_folder(spark, "test-stream-replay")
    raw_dir, landing = f"{root}/raw", f"{root}/landing"
    _land(spark, p, raw_dir, tables=("raw_shipments",))
    base = _count(spark, raw_dir, "raw_shipments")
    batch = daily.daily_batches(p.sources, p.as_of_text)["raw_shipments"]
    batch.withColumn(BATCH_DATE, daily.batch_day(p.as_of_text)).write.mode("append").parquet(f"{landing}/raw_shipments")
    stream_append(spark, landing, raw_dir, f"{root}/ckpt-a", tables=("raw_shipments",))
    # the checkpoint is lost: a new one replays every landed file
    stream_append(spark, landing, raw_dir, f"{root}/ckpt-b", tables=("raw_shipments",))
    assert _count(spark, raw_dir, "raw_shipments") == base + 75


def test_guard_reads_only_the_days_partition(spark):
    p = Project.from_dir(spark, SF_SMALL)
    raw_dir = run_folder(spark, "test-guard-plan") + "/raw"
    _land(spark, p, raw_dir, tables=("raw_payments",))
    batch = daily.daily_batches(p.sources, p.as_of_text)["raw_payments"]
    df = daily.guard_status("raw_payments", batch, read_landed(spark, raw_dir, "raw_payments"), p.as_of_text)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    row = df.first()
    assert (row.existing_batch_rows, row.batch_rows, row.rows_to_append) == (0, 100, 100)


def test_keys_that_look_like_a_day_and_half_landed_batches(spark):
    """An order key that spells the day doesn't block the batch, and a batch that landed in part is completed."""
    p = Project.from_dir(spark, SF_SMALL)
    raw_dir = run_folder(spark, "test-date-keys") + "/raw"
    _land(spark, p, raw_dir)
    dated = p.table("raw_payments").limit(1).selectExpr("'PMT_20010801_1' AS payment_id", *RAW_SCHEMAS["raw_payments"].names[1:])
    land(dated, raw_dir, "raw_payments")
    batches = daily.daily_batches(p.sources, p.as_of_text)
    part = batches["raw_payments"].where("right(payment_id, 4) <= '0040'").withColumn(BATCH_DATE, daily.batch_day(p.as_of_text))
    land(part, raw_dir, "raw_payments")
    first = daily.append_daily_batch(spark, raw_dir, batches, p.as_of_text)
    assert [r.appended for r in first] == [60, 75, 150]
    landed = daily.day_rows(read_landed(spark, raw_dir, "raw_payments"), p.as_of_text).drop(BATCH_DATE)
    assert sorted(map(tuple, landed.collect()), key=str) == sorted(map(tuple, batches["raw_payments"].select(landed.columns).collect()), key=str)
    assert [r.appended for r in daily.append_daily_batch(spark, raw_dir, batches, p.as_of_text)] == [0, 0, 0]
    # another day is another batch
    later = "2001-08-02 00:00:00"
    assert [r.appended for r in daily.append_daily_batch(spark, raw_dir, daily.daily_batches(p.sources, later), later)] == [100, 75, 150]


def test_stream_reads_only_the_partitions_of_its_dates(spark):
    """Files of other days may even be unreadable: a micro-batch does not open them."""
    p = Project.from_dir(spark, SF_SMALL)
    root = run_folder(spark, "test-stream-days")
    raw_dir, landing = f"{root}/raw", f"{root}/landing"
    _land(spark, p, raw_dir, tables=("raw_shipments",))
    other = f"{raw_dir}/raw_shipments/{BATCH_DATE}=2000-01-01"
    os.makedirs(other)
    with open(f"{other}/part-0.parquet", "w") as broken:
        broken.write("no parquet")
    batch = daily.daily_batches(p.sources, p.as_of_text)["raw_shipments"]
    batch.withColumn(BATCH_DATE, daily.batch_day(p.as_of_text)).write.parquet(f"{landing}/raw_shipments")
    stream_append(spark, landing, raw_dir, f"{root}/ckpt", tables=("raw_shipments",))
    rows = daily.day_rows(read_landed(spark, raw_dir, "raw_shipments"), p.as_of_text).drop(BATCH_DATE)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, batch.select(rows.columns).collect()), key=str)


def test_a_key_that_repeats_in_a_micro_batch(spark):
    """One row of it lands, by a stated rule and not by which task came first."""
    p = Project.from_dir(spark, SF_SMALL)
    root = run_folder(spark, "test-stream-ties")
    raw_dir, landing = f"{root}/raw", f"{root}/landing"
    _land(spark, p, raw_dir, tables=("raw_payments",))
    one = daily.daily_batches(p.sources, p.as_of_text)["raw_payments"].limit(1).withColumn(BATCH_DATE, daily.batch_day(p.as_of_text))
    for order_id in (9, 3, 7):
        one.withColumn("order_id", F.lit(order_id).cast("long")).write.mode("append").parquet(f"{landing}/raw_payments")
    stream_append(spark, landing, raw_dir, f"{root}/ckpt", tables=("raw_payments",))
    assert [r.order_id for r in daily.day_rows(read_landed(spark, raw_dir, "raw_payments"), p.as_of_text).collect()] == [3]
