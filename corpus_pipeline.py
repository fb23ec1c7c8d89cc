"""Corpus pipeline: training-data operators applied to ``documents`` one after another.

Each stage gets what its predecessor kept, written as Parquet and read again,
and all but the last return the columns of ``documents``:

1. ``quality``: texts that the classifier rejects go;
2. ``line_dedup``: of lines that are near to each other the first one stays
   (``n_chars`` follows the text);
3. ``jaccard_join``: of each class of near-duplicate documents the first stays;
4. ``decontaminate``: documents that hold a benchmark item go;
5. ``byte_bpe``: ids of the byte-level encoding, and the text as decoded from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm import byte_bpe, jaccard, lines, quality, templates
from tillbook.llm.common import read_table
from tillbook.session import run_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.trained(spark, sf_dir, docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    return lines.dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(names)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.firsts(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, ``text`` decoded from the ids, with ``bpe_ids`` and ``n_tokens``."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(docs, path, pattern, offsets=False, decoded=True)  # one pass: a task has one Python worker
    return encoded.drop("text").withColumnRenamed("bpe_text", "text").withColumn("n_tokens", F.size("bpe_ids")).select(*docs.columns, "bpe_ids", "n_tokens")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", jaccard_stage),
    ("decontaminate", benchmark_stage),
    ("byte_bpe", encode_stage),
]

#: SQL expresses neither the classifier nor the similarity stages; tests/llm hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's rows are written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = run_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
