"""Seed loading: CSV files with a declared schema into parquet raw tables.

Empty CSV fields become NULL (``delivered_at`` of undelivered shipments,
``customer_id`` of anonymous clicks); types come from the declared schema,
never from inference.  Malformed rows fail the load (``FAILFAST``), unless a
quarantine folder is given: then the others are loaded, and each bad line
is kept there with what is wrong with it, for somebody to mend and load again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.session import remove, run_folder
from tillbook.sources.schemas import RAW_SCHEMAS
from tillbook.sources.tables import land

BAD_LINE = "bad_line"


_OPTIONS = {
    "header": True,
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def read_seed_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[table]).options(**_OPTIONS, mode="FAILFAST").csv(path)


def read_marked_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All rows of a seed file; ``bad_line`` is the text of a malformed one, NULL in the others."""
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(BAD_LINE, T.StringType())])
    return spark.read.schema(schema).options(**_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE).csv(path)


def reasons(line: Column, table: str) -> Column:
    """What is wrong with a malformed line: its number of fields, or the fields that are not of their column's type."""
    fields = RAW_SCHEMAS[table].fields
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    texts = F.from_csv(line, as_text.simpleString()[7:-1].replace(":", " "), {"nullValue": ""})
    # a line of commas more or less: quoted commas do not count
    found = F.regexp_count(F.regexp_replace(line, r'"[^"]*"', ""), F.lit(",")) + 1
    wrong = [
        F.when(texts[f.name].isNotNull() & texts[f.name].try_cast(f.dataType).isNull(), F.concat(F.lit(f"{f.name} is not of type {f.dataType.simpleString()}: "), texts[f.name]))
        for f in fields
        if not isinstance(f.dataType, T.StringType)
    ]
    count = F.when(found != len(fields), F.concat(found.cast("string"), F.lit(f" fields instead of {len(fields)}")))
    return F.coalesce(count, F.nullif(F.concat_ws("; ", *wrong), F.lit("")), F.lit("malformed"))


def load_seed(spark: SparkSession, csv_path: str, table: str, raw_dir: str, quarantine: str | None = None) -> str:
    """Load one seed CSV into ``<raw_dir>/<table>`` (full refresh), return the path.

    With ``quarantine``, malformed lines go to ``<quarantine>/<table>`` (``bad_line, reason, file``, overwritten) instead of failing the load."""
    target = f"{raw_dir.rstrip('/')}/{table}"
    if quarantine is None:
        land(read_seed_csv(spark, csv_path, table), raw_dir, table, mode="overwrite")
        return target
    # parsed once: whether a line is bad shows only when all its columns are read
    parsed = run_folder(spark, f"seed-{table}")
    read_marked_csv(spark, csv_path, table).withColumn("file", F.input_file_name()).write.parquet(parsed)
    rows = spark.read.parquet(parsed)
    bad = rows.where(F.col(BAD_LINE).isNotNull()).select(BAD_LINE, reasons(F.col(BAD_LINE), table).alias("reason"), "file")
    bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/{table}")
    land(rows.where(F.col(BAD_LINE).isNull()), raw_dir, table, mode="overwrite")
    remove(spark, parsed)
    return target


def write_seed_csv(df: DataFrame, path: str) -> None:
    """Export a raw table in the seed CSV layout (header, ISO timestamps)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
        .csv(path)
    )
