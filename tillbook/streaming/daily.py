"""The daily batch of new payments, shipments and clicks, and its append.

The reference draws a random sample and random attributes inside a stored
procedure.  Here the sample is deterministic — rows ordered by an
arithmetic hash of the key, top N taken with a bounded top-k
(``TakeOrderedAndProject``: each task keeps N rows) — and every attribute is
a function of the row number, so a re-run produces the same batch.

Landed raw tables are partitioned by ``batch_date``, the day whose batch a row
came with (NULL: the first load).  The guard reads that day's partition alone,
and never judges by key text: a first-load key may look like a day's.  Batch
rows whose key is in the partition already are dropped (the N-row batch and the
keys of one day's batch are what is joined), so a batch that landed in part
is completed and a whole one adds nothing.  What a run adds is one file with a
name that follows from its first key, renamed into the partition: two runs at
a time bring the same rows under the same name, and the later one replaces the earlier.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.sources.raw import CARRIERS, LANDING_PAGES, PAYMENT_METHODS, pad_sql, pick_sql
from tillbook.session import remove, run_folder
from tillbook.sources.schemas import RAW_SCHEMAS
from tillbook.sources.tables import BATCH_DATE, read_landed
from tillbook.sources.versions import make_folder, only_file, replace_file

# ---- fixed values ----------------------------------------------------------
ID_PREFIX = {"raw_payments": "PMT_", "raw_shipments": "SHIP_", "raw_marketing_clicks": "CLICK_"}
BATCH_ROWS = {"raw_payments": 100, "raw_shipments": 75, "raw_marketing_clicks": 150}
# Short table names used by the reference's status and count queries.
TABLE_LABELS = {"raw_payments": "payments", "raw_shipments": "shipments", "raw_marketing_clicks": "marketing_clicks"}
# -----------------------------------------------------------------------------

KEYS = {"raw_payments": "payment_id", "raw_shipments": "shipment_id", "raw_marketing_clicks": "click_id"}
TIME_COLUMNS = {"raw_payments": "paid_at", "raw_shipments": "shipped_at", "raw_marketing_clicks": "clicked_at"}
BATCH_TABLES = tuple(KEYS)


SAMPLE_HASH = "sample_hash"


def bottom_k(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """The ``n`` rows (all, if fewer) with the smallest ``sample_hash`` of seed and key; ties by key.

    Rows without a key are not drawn.  Whether a row is drawn does not depend on how the table is parted."""
    hashed = df.where(F.col(key).isNotNull()).withColumn(SAMPLE_HASH, F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")))
    return hashed.orderBy(SAMPLE_HASH, key).limit(n)


def merge_samples(samples: list[DataFrame], key: str, n: int) -> DataFrame:
    """The ``bottom_k`` of several tables together, from each one's own (of at least ``n`` rows, with one seed)."""
    return reduce(DataFrame.unionByName, samples).orderBy(SAMPLE_HASH, key).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows (or all, if fewer), numbered 1..n in sample order (``rn``)."""
    order = Window.orderBy(SAMPLE_HASH, key)  # n rows
    return bottom_k(df, key, n, seed).withColumn("rn", F.row_number().over(order)).drop(SAMPLE_HASH)


def sample_seed(table: str, as_of_text: str) -> str:
    """One draw for each table and day."""
    return f"{as_of_text[:10]}:{table}"


def batch_prefix(table: str, as_of_text: str) -> str:
    return f"{ID_PREFIX[table]}{as_of_text[:10].replace('-', '')}_"


def _as_of_sql(as_of_text: str) -> str:
    return f"CAST('{as_of_text}' AS TIMESTAMP_NTZ)"


def batch_payments(orders: DataFrame, as_of_text: str) -> DataFrame:
    s = sample_rows(orders.select("o_orderkey", "o_custkey"), "o_orderkey", BATCH_ROWS["raw_payments"], sample_seed("raw_payments", as_of_text))
    now, roll = _as_of_sql(as_of_text), "(rn * 53) % 100"
    return s.selectExpr(
        f"concat('{batch_prefix('raw_payments', as_of_text)}', {pad_sql('rn', 4)}) AS payment_id",
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CAST(15 + (o_orderkey * 7919) % 4986 AS DECIMAL(12,2)) AS amount_usd",
        f"CASE WHEN (rn * 37) % 100 < 5 THEN NULL ELSE {pick_sql(PAYMENT_METHODS, 'rn % 5')} END AS payment_method",
        f"""CASE WHEN {roll} < 5 THEN 'failed' WHEN {roll} < 10 THEN 'pending'
                 WHEN {roll} < 15 THEN 'refunded' ELSE 'captured' END AS status""",
        f"timestampadd(HOUR, -(rn % 37), {now}) AS paid_at",
    )


def batch_shipments(orders: DataFrame, as_of_text: str) -> DataFrame:
    s = sample_rows(orders.select("o_orderkey"), "o_orderkey", BATCH_ROWS["raw_shipments"], sample_seed("raw_shipments", as_of_text))
    now, roll = _as_of_sql(as_of_text), "(rn * 53) % 100"
    return s.selectExpr(
        f"concat('{batch_prefix('raw_shipments', as_of_text)}', {pad_sql('rn', 4)}) AS shipment_id",
        "o_orderkey AS order_id",
        f"{pick_sql(CARRIERS, 'rn % 4')} AS carrier",
        "CAST(100000000 + (o_orderkey * 104729) % 899999999 AS STRING) AS tracking_number",
        f"""CASE WHEN {roll} < 5 THEN 'returned' WHEN {roll} < 20 THEN 'in_transit'
                 WHEN {roll} < 25 THEN 'delayed' ELSE 'delivered' END AS status""",
        f"timestampadd(DAY, -(1 + rn % 7), {now}) AS shipped_at",
        # independent of status, as in the reference: delivered rows without a date occur
        f"CASE WHEN (rn * 37) % 100 < 75 THEN timestampadd(DAY, 2 + rn % 7, {now}) END AS delivered_at",
    )


def batch_clicks(customers: DataFrame, as_of_text: str) -> DataFrame:
    s = sample_rows(customers.select("c_custkey"), "c_custkey", BATCH_ROWS["raw_marketing_clicks"], sample_seed("raw_marketing_clicks", as_of_text))
    now = _as_of_sql(as_of_text)
    return s.selectExpr(
        f"concat('{batch_prefix('raw_marketing_clicks', as_of_text)}', {pad_sql('rn', 5)}) AS click_id",
        f"concat('CMP_', {pad_sql('(rn * 17) % 40 + 1', 4)}) AS campaign_id",
        "CASE WHEN (rn * 41) % 100 < 70 THEN c_custkey END AS customer_id",
        f"timestampadd(HOUR, -(rn % 25), {now}) AS clicked_at",
        f"concat('/landing/', {pick_sql(LANDING_PAGES, 'rn % 5')}) AS source_url",
        "(rn * 59) % 100 < 12 AS converted",
    )


def daily_batches(sources: dict[str, DataFrame], as_of_text: str) -> dict[str, DataFrame]:
    return {
        "raw_payments": batch_payments(sources["orders"], as_of_text),
        "raw_shipments": batch_shipments(sources["orders"], as_of_text),
        "raw_marketing_clicks": batch_clicks(sources["customer"], as_of_text),
    }


def new_rows(batch: DataFrame, target: DataFrame, key: str, bounded: bool = True) -> DataFrame:
    """Batch rows whose key is not yet in the target.

    The semi join finds the target keys that clash with the batch (each
    once), the anti join drops them from the batch.  A daily
    batch has at most N rows, so it and the clashing keys are broadcast outright (``bounded``);
    for stream micro-batches of unknown size AQE decides from the measured
    size whether to broadcast or shuffle."""
    batch_keys = batch.select(key)
    if bounded:
        batch_keys = F.broadcast(batch_keys)
    clashing = target.select(key).join(batch_keys, key, "left_semi").distinct()
    if bounded:
        clashing = F.broadcast(clashing)
    return batch.join(clashing, key, "left_anti")


def batch_day(as_of_text: str) -> Column:
    return F.lit(as_of_text[:10]).cast("date")


def day_rows(target: DataFrame, as_of_text: str) -> DataFrame:
    """Rows of the target that came with the day's batch: one partition of a landed table."""
    return target.where(F.col(BATCH_DATE) == batch_day(as_of_text))


def unbatched(raw: DataFrame) -> DataFrame:
    """A first-load raw table in the shape of a landed one."""
    return raw.withColumn(BATCH_DATE, F.lit(None).cast("date"))


def guard_status(table: str, batch: DataFrame, target: DataFrame, as_of_text: str) -> DataFrame:
    """One row: how many rows of today's batch exist, and how many would be appended."""
    key = KEYS[table]
    prefix = batch_prefix(table, as_of_text)
    # a flag per batch row: one sampling of the batch and one read of the day's partition
    today = day_rows(target, as_of_text).where(F.col(key).startswith(prefix)).select(key, F.lit(1).alias("landed")).distinct()
    flagged = F.broadcast(batch.select(key, F.lit(1).alias("fresh"))).join(today, key, "full")
    return flagged.agg(
        F.count("landed").alias("existing_batch_rows"),
        F.count("fresh").alias("batch_rows"),
        F.count_if(F.col("landed").isNull()).alias("rows_to_append"),
    ).select(F.lit(TABLE_LABELS[table]).alias("table_name"), F.lit(prefix).alias("batch_prefix"), "existing_batch_rows", "batch_rows", "rows_to_append")


def guarded_batch(table: str, batch: DataFrame, target: DataFrame, as_of_text: str) -> DataFrame:
    """The rows an append would add (lazy), with their ``batch_date``."""
    return new_rows(batch, day_rows(target, as_of_text), KEYS[table]).withColumn(BATCH_DATE, batch_day(as_of_text))


@dataclass
class AppendReport:
    table: str
    appended: int
    skipped_existing: bool


def stage_batch(spark: SparkSession, raw_dir: str, table: str, batch: DataFrame, as_of_text: str) -> tuple[str, int]:
    """Writes the rows that an append would add (at most N) as one file of a fresh folder: the folder and their number."""
    rows = guarded_batch(table, batch, read_landed(spark, raw_dir, table), as_of_text).drop(BATCH_DATE)
    path = run_folder(spark, f"append-{table}")
    rows.select(*RAW_SCHEMAS[table].names).orderBy(KEYS[table]).coalesce(1).write.parquet(path)
    return path, spark.read.parquet(path).count()


def land_staged(spark: SparkSession, raw_dir: str, table: str, staged: tuple[str, int], as_of_text: str) -> None:
    """Moves staged rows into the day's partition with one rename.

    The file's name follows from the first key in it: runs that saw the same table bring the
    same rows under the same name, and one replaces the other."""
    path, n = staged
    if n:
        first = spark.read.parquet(path).agg(F.min(KEYS[table])).first()[0]
        folder = f"{raw_dir.rstrip('/')}/{table}/{BATCH_DATE}={as_of_text[:10]}"
        make_folder(spark, folder)
        replace_file(spark, only_file(spark, path), f"{folder}/batch-{first}.parquet")
    remove(spark, path)


def append_daily_batch(
    spark: SparkSession,
    raw_dir: str,
    batches: dict[str, DataFrame],
    as_of_text: str,
    tables: tuple[str, ...] = BATCH_TABLES,
) -> list[AppendReport]:
    """Append what is missing of today's batch to each landed raw table; safe to re-run, and to run twice at a time.

    A run that crashed between tables, or within one, is completed by the next."""
    reports = []
    for table in tables:
        staged = stage_batch(spark, raw_dir, table, batches[table], as_of_text)
        land_staged(spark, raw_dir, table, staged, as_of_text)
        reports.append(AppendReport(table, staged[1], staged[1] == 0))
    return reports


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table (a union of global counts)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(TABLE_LABELS.get(name, name)).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def latest_rows(table: DataFrame, table_name: str, n: int = 5) -> DataFrame:
    """Newest n rows of a raw table by its event time (key breaks ties)."""
    key, ts = KEYS[table_name], TIME_COLUMNS[table_name]
    return (
        table.where(F.col(key).like(f"{ID_PREFIX[table_name]}%"))
        .orderBy(F.col(ts).desc_nulls_last(), F.col(key).asc())
        .limit(n)
    )
