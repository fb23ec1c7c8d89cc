"""Quality classifier by nearest-neighbour voting over latent-semantic vectors.

Method: a text's terms are its hashed byte trigrams (log counts times inverse
document frequency) and binned statistics (shares of byte classes, size,
variety, words that repeat the word before).  A truncated singular value decomposition of the labelled
texts' terms gives ``DIMENSIONS`` latent directions.  The labelled vectors are
broadcast; every text is projected and compared with all of them by exact
cosine, block by block, and its ``NEIGHBOURS`` nearest vote with weight
cosine ** ``SHARPNESS``.

The fit uses at most ``SAMPLE`` labelled texts of each label, chosen by a hash
of the id (a bound on what is collected and broadcast: about 18 MB of terms, 1 MB
of vectors); scores use the text alone.  A neighbour's vote is divided by the
number of texts with its label, so that a score is what it would be for evenly
mixed texts.

Defined cases: null or empty texts are scored by their statistics (no term
but the bins of an empty text); null labels and ids are not learned from; a
labelled id that occurs repeatedly is learned from once (its smallest label
and text); without labelled texts every score is 0.5; further columns are carried along by
``scored`` whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.common import Words, crc_mod, read_table, slices, text_arrays

HASHED = 2048
DIMENSIONS = 32
NEIGHBOURS = 10
SHARPNESS = 8
#: Labelled texts of each label.
SAMPLE = 2048
#: Weight of a statistic's bin beside the trigrams, whose vector has length 1.
BIN_WEIGHT = 0.15
BINS = 8
REJECT_BELOW = 0.3
ITERATIONS = 15

_CLASSES = np.zeros(256, np.int64)
_CLASSES[65:91], _CLASSES[97:123], _CLASSES[48:58], _CLASSES[128:] = 1, 2, 3, 4
_CLASSES[[9, 10, 13, 32]], _CLASSES[[44, 46]] = 5, 6
STATISTICS = 7 + 4


def terms(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed byte trigrams (rows x HASHED) and statistics (rows x STATISTICS)."""
    raw, offsets = text_arrays(column)
    n, sizes = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    counts = np.zeros((n, HASHED), np.float32)
    if len(raw) >= 3:
        x = raw.astype(np.uint32)
        h = x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h = (h * np.uint32(0x2C1B3C6D) >> np.uint32(21)).astype(np.int64)
        inside = row[:-2] == row[2:]
        counts = np.bincount(row[:-2][inside] * HASHED + h[inside], minlength=n * HASHED).reshape(n, HASHED).astype(np.float32)
    per_class = np.bincount(row * 7 + _CLASSES[raw], minlength=n * 7).reshape(n, 7) / np.maximum(sizes, 1)[:, None]
    variety = (counts > 0).sum(1) / np.clip(sizes, 1, HASHED)
    heaped = np.square(counts).sum(1) / np.maximum(counts.sum(1), 1) ** 2
    words = Words(column)
    again = (words.hashes[1:] == words.hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    echoes = np.bincount(words.doc[1:], weights=again, minlength=n) / np.maximum(np.diff(words.first), 1)
    return counts, np.column_stack([per_class, np.log1p(sizes), variety, heaped, echoes])


@dataclass
class Model:
    idf: np.ndarray
    edges: list[np.ndarray]
    directions: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled texts x dimensions, of length 1
    labels: np.ndarray

    def weighted(self, counts: np.ndarray, statistics: np.ndarray) -> np.ndarray:
        grams = np.log1p(counts, dtype=np.float32) * self.idf
        grams /= np.maximum(np.linalg.norm(grams, axis=1, keepdims=True), 1e-9)
        bins = [(np.searchsorted(e, s, side="right")[:, None] == np.arange(BINS)) * BIN_WEIGHT for e, s in zip(self.edges, statistics.T, strict=True)]
        return np.hstack([grams, *bins]).astype(np.float32)

    def project(self, counts: np.ndarray, statistics: np.ndarray) -> np.ndarray:
        out = self.weighted(counts, statistics) @ self.directions
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def score(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(column), 0.5)
        cosine = np.round(self.project(*terms(column)) @ self.vectors.T, 6)
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6).astype(np.float64) ** SHARPNESS
        weight /= np.where(self.labels == 1, max(self.labels.sum(), 1), max((self.labels == 0).sum(), 1))[near]
        return (weight * self.labels[near]).sum(1) / weight.sum(1)


def fit(counts: np.ndarray, statistics: np.ndarray, labels: np.ndarray) -> Model:
    if not len(labels):
        return Model(np.ones(HASHED), [], np.zeros((0, 0)), np.zeros((0, 0)), labels)
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    edges = [np.unique(np.quantile(s, np.linspace(0, 1, BINS + 1)[1:-1])) for s in statistics.T]
    model = Model(idf, edges, np.zeros((0, 0)), np.zeros((0, 0)), labels.astype(np.float64))
    # the leading right singular vectors by subspace iteration
    weighted = model.weighted(counts, statistics)
    basis = np.random.default_rng(0).normal(size=(weighted.shape[1], DIMENSIONS + 8)).astype(np.float32)
    for _ in range(ITERATIONS):
        basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0]
    _, _, turned = np.linalg.svd(weighted @ basis, full_matrices=False)
    model.directions = np.ascontiguousarray(basis @ turned.T[:, :DIMENSIONS])
    model.vectors = model.project(counts, statistics)
    return model


def learn(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` labelled documents of each label (rows of ``labels``: doc_id, ``label``)."""
    one = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col(label).cast("int")).alias("label"))
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    chosen = one.where("label = 0").orderBy(*by_hash).limit(sample).unionByName(one.where("label = 1").orderBy(*by_hash).limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # 2 x sample ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                counts, statistics = terms(part.column("text"))
                columns = [[r.tobytes() for r in m.astype(t)] for m, t in ((np.minimum(counts, 65535), np.uint16), (statistics, np.float64))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), *(pa.array(c, pa.binary()) for c in columns)], names=["doc_id", "label", "counts", "statistics"])

    found = sorted(rows.mapInArrow(run, "doc_id long, label int, counts binary, statistics binary").collect())
    counts = np.frombuffer(b"".join(r.counts for r in found), np.uint16).reshape(-1, HASHED)
    statistics = np.frombuffer(b"".join(r.statistics for r in found), np.float64).reshape(-1, STATISTICS)
    return fit(counts, statistics, np.array([r.label for r in found], np.float64))


def scored(docs: DataFrame, model: Model, kept: list[int] | None = None, name: str = "score", text: str = "text") -> DataFrame:
    """The ``kept`` columns (by position; all of them) of every row of ``docs`` and its score."""
    kept = list(range(len(docs.columns))) if kept is None else kept
    sent = docs.sparkSession.sparkContext.broadcast(model)
    position = docs.columns.index(text)
    fields = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in slices(batch, batch.schema.names[position], 1 << 20):
                scores = own.score(part.column(position))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array(scores)], names=[*(f"c{i}" for i in kept), "score"])

    plain = docs.toDF(*(f"c{i}" for i in range(len(fields))))
    schema = T.StructType([*(T.StructField(f"c{i}", fields[i].dataType) for i in kept), T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*(docs.columns[i] for i in kept), name)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``REJECT_BELOW`` or more."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    rows = scored(plain, model, text=f"c{names.index('text')}")
    return rows.where(F.col("score") >= REJECT_BELOW).drop("score").toDF(*names)


def held_out(column: str = "doc_id") -> Column:
    """The fold that is not learned from."""
    return crc_mod(column, 5) == 0


def trained(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Model:
    return learn(docs, read_table(spark, sf_dir, "labels").where(~held_out()), "quality")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = scored(docs, trained(spark, sf_dir, docs), kept=[0])
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"))
