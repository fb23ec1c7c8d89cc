"""Registered queries beyond the models: data quality and the daily batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.operators.quality import run_checks
from tillbook.plans.graph import Project
from tillbook.session import run_folder
from tillbook.sources.seeds import load_seed, write_seed_csv
from tillbook.sources.tables import BATCH_DATE, land, read_landed
from tillbook.sources.versions import publish, read_current
from tillbook.streaming import daily
from tillbook.streaming.stream import stream_append


def _project(spark: SparkSession, sf_dir: str) -> Project:
    return Project.from_dir(spark, sf_dir)


def _batches(p: Project) -> dict[str, DataFrame]:
    return daily.daily_batches(p.sources, p.as_of_text)


def _after_append(p: Project) -> dict[str, DataFrame]:
    """Raw tables as they are after today's guarded append (lazy union)."""
    batches = _batches(p)
    out = {}
    for table in daily.BATCH_TABLES:
        raw = daily.unbatched(p.table(table))
        out[table] = raw.unionByName(daily.guarded_batch(table, batches[table], raw, p.as_of_text)).drop(BATCH_DATE)
    return out


def dq(tests: tuple[str, ...]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The marts that several checked models read are written once, as in a
        # pipeline run; the checks then read those files.
        p = _project(spark, sf_dir)
        if set(tests) & {"unique", "not_null"}:
            p.materialize("int_orders_enriched", "int_customer_lifetime", "fct_revenue")
        return run_checks(p, tests)

    return run


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _project(spark, sf_dir)
    return daily.sample_rows(
        p.sources["orders"].select("o_orderkey", "o_custkey"),
        "o_orderkey",
        daily.BATCH_ROWS["raw_payments"],
        daily.sample_seed("raw_payments", p.as_of_text),
    )


def batch(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _batches(_project(spark, sf_dir))[table]

    return run


def batch_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _project(spark, sf_dir)
    batches = _batches(p)
    parts = [
        daily.guard_status(t, batches[t], daily.unbatched(p.table(t)), p.as_of_text)
        for t in daily.BATCH_TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


def _first_load(p: Project, raw_dir: str) -> None:
    for table in daily.BATCH_TABLES:
        land(p.table(table), raw_dir, table, mode="overwrite")


def _appended(spark: SparkSession, raw_dir: str, day: str) -> DataFrame:
    """Rows that landed with the day's batch, of all tables: table, key, and their other columns as JSON."""
    parts = []
    for table, key in daily.KEYS.items():
        rows = daily.day_rows(read_landed(spark, raw_dir, table), day).drop(BATCH_DATE)
        others = [c for c in rows.columns if c != key]
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in others])
        parts.append(rows.select(F.lit(daily.TABLE_LABELS[table]).alias("table_name"), F.col(key).alias("row_key"), text.alias("row_values")))
    return reduce(DataFrame.unionByName, parts)


def append_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the raw tables, append today's batch twice (the second run is a
    no-op), and return the rows that were appended."""
    p = _project(spark, sf_dir)
    raw_dir = run_folder(spark, "append") + "/raw"
    _first_load(p, raw_dir)
    batches = _batches(p)
    for _ in range(2):
        daily.append_daily_batch(spark, raw_dir, batches, p.as_of_text)
    return _appended(spark, raw_dir, p.as_of_text)


def stream_append_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same append through the streaming job; the batch files are
    delivered twice and must still land once."""
    p = _project(spark, sf_dir)
    root = run_folder(spark, "stream")
    raw_dir, landing, checkpoints = f"{root}/raw", f"{root}/landing", f"{root}/checkpoints"
    _first_load(p, raw_dir)
    for _ in range(2):
        for table, df in _batches(p).items():
            df.withColumn(BATCH_DATE, daily.batch_day(p.as_of_text)).write.mode("append").parquet(f"{landing}/{table}")
        stream_append(spark, landing, raw_dir, checkpoints)
    return _appended(spark, raw_dir, p.as_of_text)


def rebuilt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as a table, rebuilt over itself, and read as a reader would."""
    folder = run_folder(spark, "rebuild") + "/rpt_daily_revenue"
    for _ in range(2):
        publish(_project(spark, sf_dir).table("rpt_daily_revenue"), folder)
    return read_current(spark, folder)


def seed_load(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A raw table written as seed CSV, loaded from it, and read as landed."""
        root = run_folder(spark, f"seed-{table}")
        write_seed_csv(_project(spark, sf_dir).table(table), f"{root}/csv")
        load_seed(spark, f"{root}/csv", table, f"{root}/raw")
        return read_landed(spark, f"{root}/raw", table).drop(BATCH_DATE)

    return run


def raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.table_counts(_after_append(_project(spark, sf_dir)))


def latest(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return daily.latest_rows(_after_append(_project(spark, sf_dir))[table], table)

    return run


def registered() -> dict:
    return {
        "dq_unique": dq(("unique",)),
        "dq_not_null": dq(("not_null",)),
        "dq_accepted_values": dq(("accepted_values",)),
        "dq_summary": dq(("unique", "not_null", "accepted_values")),
        "sample_rows": sample_rows,
        "batch_payments": batch("raw_payments"),
        "batch_shipments": batch("raw_shipments"),
        "batch_clicks": batch("raw_marketing_clicks"),
        "batch_guard": batch_guard,
        "append_batch": append_batch,
        "raw_counts": raw_counts,
        "latest_payments": latest("raw_payments"),
        "latest_shipments": latest("raw_shipments"),
        "latest_clicks": latest("raw_marketing_clicks"),
        "stream_append": stream_append_query,
        "rebuilt_table": rebuilt_table,
        "seed_payments": seed_load("raw_payments"),
        "seed_shipments": seed_load("raw_shipments"),
        "seed_campaigns": seed_load("raw_marketing_campaigns"),
        "seed_clicks": seed_load("raw_marketing_clicks"),
    }
