"""Readers for the source parquet tables and the raw event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.sources.schemas import OPTIONAL, RAW_SCHEMAS, SOURCE_SCHEMAS

#: Day that a row of a landed raw table was appended; NULL for rows of the first load.
BATCH_DATE = "batch_date"


def table_path(base_dir: str, name: str) -> str:
    base = base_dir.rstrip("/")
    return f"{base}/{name}.parquet"


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a source table in their declared types.

    Fails where a required column is missing; optional ones become typed
    NULLs.  Decimals stay where a double is declared: staging makes money of
    either.  A cast to the type a column already has costs nothing, and filters
    and projections still reach the scan."""
    present = {f.name.lower(): f for f in df.schema.fields}
    missing = [f.name for f in SOURCE_SCHEMAS[name] if f.name not in present and f.name not in OPTIONAL[name]]
    if missing:
        raise ValueError(f"table {name} lacks the columns {', '.join(missing)}")
    out = []
    for field in SOURCE_SCHEMAS[name]:
        own = present.get(field.name)
        if own is None:
            column = F.lit(None).cast(field.dataType)
        elif own.dataType == field.dataType or (isinstance(field.dataType, T.DoubleType) and isinstance(own.dataType, T.DecimalType)):
            column = F.col(own.name)
        else:
            column = F.col(own.name).cast(field.dataType)
        out.append(column.alias(field.name))
    return df.select(*out)


def read_source(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Scan one source table in its declared columns.

    Filters and projections applied later are pushed into this scan by
    Catalyst (``PushedFilters`` / pruned ``ReadSchema``).
    """
    return conform(spark.read.parquet(table_path(base_dir, name)), name)


def read_sources(spark: SparkSession, base_dir: str) -> dict[str, DataFrame]:
    return {name: read_source(spark, base_dir, name) for name in SOURCE_SCHEMAS}


def read_landed(spark: SparkSession, raw_dir: str, table: str) -> DataFrame:
    """One landed raw table, with its ``batch_date`` partition."""
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(BATCH_DATE, T.DateType())])
    return spark.read.schema(schema).parquet(f"{raw_dir.rstrip('/')}/{table}")


def land(df: DataFrame, raw_dir: str, table: str, mode: str = "append") -> None:
    """Writes rows of a raw table (with ``batch_date``; without: a first load) to its landed folder."""
    if BATCH_DATE not in df.columns:
        df = df.withColumn(BATCH_DATE, F.lit(None).cast("date"))
    rows = df.select(*RAW_SCHEMAS[table].names, BATCH_DATE)
    rows.write.mode(mode).partitionBy(BATCH_DATE).parquet(f"{raw_dir.rstrip('/')}/{table}")


def read_raw_tables(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Raw tables that were landed as parquet (e.g. by the seed loader or the
    daily append), read with their declared schemas."""
    return {name: read_landed(spark, raw_dir, name).drop(BATCH_DATE) for name in RAW_SCHEMAS}
