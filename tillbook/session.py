"""SparkSession construction and shared storage location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session_configs(cpus: int = 8, shuffle_partitions: int | None = None) -> dict[str, str]:
    """Configs the pipeline is tuned for.

    AQE re-plans at runtime: it coalesces small shuffle partitions, turns
    sort-merge joins into broadcast joins only when the *measured* build side
    is under ``adaptive.autoBroadcastJoinThreshold``, and splits skewed
    partitions of sort-merge joins (a hot customer or order key).
    """
    parts = shuffle_partitions or max(8, cpus * 2)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.autoBroadcastJoinThreshold": "32m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
        # money sums rely on it: an overflow raises instead of wrapping
        "spark.sql.ansi.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def get_session(
    master: str | None = None,
    cpus: int | None = None,
    app_name: str = "tillbook",
    driver_memory: str = "16g",
    shuffle_partitions: int | None = None,
) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    configs = session_configs(cpus, shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    # Under spark-submit the JVM (and the cluster master) already exist: what
    # was submitted stays, and how many partitions a shuffle has is the
    # cluster's business.  Only a plain `python` run starts its own local Spark.
    if "PYSPARK_GATEWAY_PORT" in os.environ and not master:
        spark = builder.getOrCreate()
        submitted = spark.sparkContext.getConf()
        for key, value in configs.items():
            if key != "spark.sql.shuffle.partitions" and not submitted.contains(key) and spark.conf.isModifiable(key):
                spark.conf.set(key, value)
    else:
        builder = builder.master(master or f"local[{cpus}]").config("spark.driver.memory", driver_memory)
        for key, value in configs.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def storage_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates, checkpoints and appended tables.

    On a cluster this is the shared location named by ``spark.checkpoint.dir``
    (or a checkpoint directory already set on the context).  Only on a local
    master, where all tasks share the machine, is a scratch folder picked if
    nothing is configured; elsewhere that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # setCheckpointDir adds a per-application sub-folder; share its parent
            root = current.rsplit("/", 1)[0]
        elif re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            root = tempfile.mkdtemp(prefix="tillbook-")
            sc.setCheckpointDir(root)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared storage root."""
    return f"{storage_root(spark)}/tillbook/{label}-{uuid.uuid4().hex[:12]}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """Materialise ``df`` once as parquet in a fresh shared folder and read it back.

    This is how the pipeline cuts lineage: one job computes and writes the
    data (``Dataset.checkpoint`` would compute it twice — once to count, once
    to write), later readers scan files, and a lost executor costs a re-read,
    never an upstream recompute."""
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a run wrote and no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
