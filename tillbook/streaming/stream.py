"""The daily append as a Structured Streaming job over a landing folder.

New batch files dropped into ``<landing>/<table>/`` are read by a file
source with a declared schema and applied with ``foreachBatch``:
de-duplicate by key inside the micro-batch, drop keys that landed already,
append.  Landed files carry the ``batch_date`` of the batch they belong to, and a
key can only have landed with its own batch: the target is read in the
partitions of the micro-batch's dates alone, so the work of a micro-batch
does not grow with the table.  ``trigger(availableNow=True)`` processes what
has landed and stops, so the job can be scheduled like the daily task; the
checkpoint makes every file count once, and the key anti join makes a
replayed micro-batch (after a failure between write and commit) harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.session import remove, run_folder
from tillbook.sources.schemas import RAW_SCHEMAS
from tillbook.sources.tables import BATCH_DATE, land, read_landed
from tillbook.streaming.daily import BATCH_TABLES, KEYS, new_rows


def _apply_micro_batch(spark: SparkSession, table: str, raw_dir: str):
    key = KEYS[table]

    def apply(batch: DataFrame, batch_id: int) -> None:
        path = run_folder(spark, f"micro-batch-{table}-{batch_id}")
        # of the rows with one key, the one whose other columns come first: a replay keeps the same
        others = [c for c in batch.columns if c != key]
        one = batch.groupBy(key).agg(F.min(F.struct(*others)).alias("row")).select(key, "row.*").select(*batch.columns)
        one.write.parquet(f"{path}/batch")
        rows = spark.read.parquet(f"{path}/batch")
        days = [r[0] for r in rows.select(BATCH_DATE).distinct().collect()]  # a few days' batches at most
        target = read_landed(spark, raw_dir, table)
        same_days = F.col(BATCH_DATE).isin([d for d in days if d is not None])
        if None in days:
            same_days |= F.col(BATCH_DATE).isNull()
        new_rows(rows, target.where(same_days), key, bounded=False).write.parquet(f"{path}/new")
        land(spark.read.parquet(f"{path}/new"), raw_dir, table)
        remove(spark, path)

    return apply


def stream_append(
    spark: SparkSession,
    landing_dir: str,
    raw_dir: str,
    checkpoint_dir: str,
    tables: tuple[str, ...] = BATCH_TABLES,
    max_files_per_trigger: int = 64,
) -> None:
    for table in tables:
        schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(BATCH_DATE, T.DateType())])
        query = (
            spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(f"{landing_dir.rstrip('/')}/{table}")
            .writeStream.foreachBatch(_apply_micro_batch(spark, table, raw_dir))
            .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{table}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
