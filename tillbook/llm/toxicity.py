"""Toxicity by subword-bag embeddings, averaged and put into a linear softmax.

Method: a text is cut into windows of ``WINDOW`` words that overlap by half.  A
word's vector is the mean of its subwords' vectors (byte n-grams of ``LENGTHS``,
with the word's edges, hashed to ``BUCKETS`` rows of one table); a window's vector is
the mean of its words'; a linear softmax over two classes gives the window's
odds.  A text is as toxic as its windows together: their odds add up, so that
one toxic sentence of a long text counts and is not averaged away.  A word
that was never seen, such as a misspelling, shares most of its n-grams, and so
its vector, with words that were.

Table and softmax are trained jointly, in numpy, on the driver, with Adam on all windows of
the labelled texts at once; one of the table's dimensions begins with the log ratio of
toxic and other texts that hold the subword.  The fit uses at most ``SAMPLE`` labelled texts of each label and
``SAMPLE_BYTES`` of text, whole texts in order of a hash of the id (a bound on what is
collected); everything else covers all rows.  As the softmax is linear, what a
subword adds to the difference of the classes is one number: only these
numbers (``BUCKETS`` of them, 512 KB) are sent to the executors.  They are kept in fixed
point, so that a score does not depend on how rows are batched.

Words are what white space (bytes 0x20 and 0x09 to 0x0D) parts, A-Z lower-cased;
a run of over ``LONGEST`` bytes counts as several words of that size.

Defined cases: a null text counts as empty; a text without words has one empty window (the softmax's bias
alone); null labels and ids are not learned from; a labelled id that occurs
repeatedly is learned from once (its largest label, its smallest text); without
labelled texts of both labels every score is near their label (0.5 without any); further columns,
whatever their names, are carried along by ``scored``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.common import LOWER, WHITE, block_hashes, crc_mod, mix, read_table, slices, text_arrays, tidied

LENGTHS = (3, 4, 5, 6)
BUCKETS = 1 << 17
DIMENSIONS = 4
WINDOW = 2
#: How far apart the softmax's first guess holds the classes.
SCALE = 12.0
LONGEST = 24
#: Labelled texts of each label, and bytes of them all, that the fit looks at.
SAMPLE = 2048
SAMPLE_BYTES = 4 << 20
EPOCHS = 10
#: Labelled texts that hold a subword which is learned.
LEAST_TEXTS = 4
#: Pull of every parameter towards 0.
DECAY = 1e-5
RATE = 0.2
#: Share of the loss that the texts with label 0 have together.
CLEAN_WEIGHT = 0.7
#: Fixed point of a subword's number.
UNIT = 1 << 20
TOXIC_FROM = 0.5


class Bags:
    """Words, subwords and windows of a column of texts.

    ``rows[n][i]`` is the table row of the n-gram that begins at byte i of the spaced-out
    texts; word w (``starts[w]`` to ``ends[w]``, its edges beside it) has those from
    ``starts[w] - 1`` on.  ``first`` is each text's first word, ``windows`` are (first, past
    last) words, ``window_of`` their texts."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pc.fill_null(column.cast(pa.large_string()), ""), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
        raw, offsets = text_arrays(spaced)
        white = WHITE[raw]
        self.bytes = np.where(white, np.uint8(0x20), LOWER[raw])
        starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1
        ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
        pieces = -(-(ends - starts) // LONGEST)  # long runs of bytes: several words
        if len(pieces) and pieces.max() > 1:
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts, ends = np.repeat(starts, pieces) + nth * LONGEST, np.repeat(ends, pieces)
            ends = np.minimum(ends, starts + LONGEST)
        self.starts, self.ends = starts, ends
        self.first = np.searchsorted(starts, offsets)
        # windows: every half a window, the last one shorter; one empty window where no word is
        counts = np.diff(self.first)
        per = np.maximum(1, -(-np.maximum(counts - WINDOW, 0) // (WINDOW // 2)) + 1)
        self.window_of = np.repeat(np.arange(len(counts)), per)
        begin = (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)) * (WINDOW // 2) + self.first[self.window_of]
        self.windows = begin, np.minimum(begin + WINDOW, self.first[self.window_of + 1])
        self.text_starts = np.cumsum(per) - per

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each n: table rows by byte, and each word's range of bytes in them."""
        rolled = self.bytes.astype(np.uint32)
        with np.errstate(over="ignore"):
            for n in range(2, max(LENGTHS) + 1):
                rolled = rolled[:-1] * np.uint32(0x01000193) + self.bytes[n - 1 :] if len(rolled) else rolled
                if n in LENGTHS:
                    mixed = (rolled ^ np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
                    rows = ((mixed ^ mixed >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
                    # an n-gram lies in <word>, the word with a byte on each side, as long as it ends there
                    yield rows, np.minimum(self.starts - 1, len(rows)), np.minimum(np.maximum(self.ends + 2 - n, self.starts - 1), len(rows))

    def sizes(self) -> np.ndarray:
        """Subwords of each word."""
        return sum(np.maximum(self.ends - self.starts + 3 - n, 0) for n in LENGTHS)


@dataclass
class Model:
    weights: np.ndarray  # of every subword, in fixed point (int32)
    bias: float

    def score(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        bags = Bags(column)
        total = np.zeros(len(bags.starts), np.int64)
        for rows, a, b in bags.grams():
            sums = np.zeros(len(rows) + 1, np.int64)
            np.cumsum(self.weights[rows], out=sums[1:])
            total += sums[b] - sums[a]
        words = np.zeros(len(total) + 1, np.int64)
        np.cumsum(np.rint(total / np.maximum(bags.sizes(), 1)).astype(np.int64), out=words[1:])
        a, b = bags.windows
        logits = (words[b] - words[a]) / (np.maximum(b - a, 1) * UNIT) + self.bias
        if not len(logits):
            return np.zeros(0)
        odds = np.logaddexp.reduceat(logits, bags.text_starts)
        return np.round(1 / (1 + np.exp(-np.clip(odds, -40, 40))), 9)


def _nth(sizes: np.ndarray) -> np.ndarray:
    """0 to size - 1 for each size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class _Means:
    """Averages of a column over ranges of its rows, and the way back for gradients."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray | None = None):
        self.starts, self.ends = starts, ends
        self.sizes = np.maximum(ends - starts if sizes is None else sizes, 1)

    def __call__(self, column: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(column) + 1)
        np.cumsum(column, out=sums[1:])
        return (sums[self.ends] - sums[self.starts]) / self.sizes

    def back(self, grads: np.ndarray, n: int) -> np.ndarray:
        """What each of ``n`` rows gets of the gradients of the ranges it lies in."""
        share = grads / self.sizes
        steps = np.bincount(self.starts, share, n + 1)
        steps -= np.bincount(self.ends, share, n + 1)
        return np.cumsum(steps, out=steps)[:-1]


def fit(column: pa.Array, labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Trains table and softmax jointly."""
    if len(np.unique(labels)) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
        return Model(np.zeros(BUCKETS, np.int32), float(np.log(share / (1 - share))))
    bags = Bags(column)
    # each distinct word once, with the rows of its subwords one after another
    spelled = block_hashes(bags.bytes, np.array([0, len(bags.bytes)]), mix(np.arange(1, 257, dtype=np.uint64)), bags.starts, bags.ends)
    _, one, word = np.unique(spelled, return_index=True, return_inverse=True)
    length = bags.sizes()[one]
    fill, flat = np.cumsum(length) - length, np.empty(length.sum(), np.int32)
    for rows, a, b in bags.grams():
        a, n = a[one], (b - a)[one]
        nth = _nth(n)
        flat[np.repeat(fill, n) + nth] = rows[np.repeat(a, n) + nth]
        fill += n
    # texts of each label that hold each subword; one that few texts hold would only learn those by heart
    text_of = np.searchsorted(bags.first[1:], np.arange(len(word)), side="right")
    pairs = np.unique(text_of * len(one) + word)
    begin, holders = np.cumsum(length) - length, np.zeros((2, BUCKETS))
    for part in np.array_split(pairs, max(1, len(pairs) // 20_000)):
        n = length[part % len(one)]
        held = np.unique(np.repeat(part // len(one), n) * BUCKETS + flat[np.repeat(begin[part % len(one)], n) + _nth(n)])
        for y in (0, 1):
            holders[y] += np.bincount(held[labels[held // BUCKETS] == y] % BUCKETS, minlength=BUCKETS)
    kept = holders.sum(0)[flat] >= LEAST_TEXTS
    owner = np.repeat(np.arange(len(one)), length)[kept]
    flat = flat[kept]
    there = np.zeros(BUCKETS, bool)
    there[flat] = True
    used = np.flatnonzero(there)
    flat = (np.cumsum(there, dtype=np.int32) - np.int32(1))[flat]
    length_kept = np.bincount(owner, minlength=len(one))
    of_word = _Means(np.cumsum(length_kept) - length_kept, np.cumsum(length_kept), length)
    of_window = _Means(*bags.windows)
    weight = np.where(labels == 1, (1 - CLEAN_WEIGHT) / labels.sum(), CLEAN_WEIGHT / (1 - labels).sum())

    # first guess: one dimension holds how much likelier a toxic text is to have the subword
    share = (holders[:, used] + 0.5) / (np.array([[(labels == 0).sum()], [(labels == 1).sum()]]) + 1)
    rng = np.random.default_rng(0)
    table = rng.normal(0, 0.05, (len(used), DIMENSIONS))
    softmax = rng.normal(0, 0.05, (DIMENSIONS, 2))
    table[:, 0] = np.log(share[1] / share[0])
    softmax[0] = -SCALE / 2, SCALE / 2
    bias = np.array([0, -2 - np.log(len(bags.window_of) / len(labels))])
    parameters = [table, softmax, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    for step in range(1, epochs + 1):
        windows = [of_window(of_word(table[flat, d])[word]) for d in range(DIMENSIONS)]  # one dimension at a time: less memory
        difference = sum(w * (r[1] - r[0]) for w, r in zip(windows, softmax, strict=True)) + (bias[1] - bias[0])
        odds = np.logaddexp.reduceat(difference, bags.text_starts)
        wrong = (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - labels) * weight
        pull = np.exp(difference - odds[bags.window_of]) * wrong[bags.window_of]  # on a window's logit of label 1; the other gets its opposite
        by_row = np.empty_like(table)
        for d in range(DIMENSIONS):
            by_word = of_window.back(pull * (softmax[d, 1] - softmax[d, 0]), len(word))
            by_row[:, d] = np.bincount(flat, of_word.back(np.bincount(word, by_word, len(one)), len(flat)), len(used))
        by_logit = np.array([[-(w @ pull), w @ pull] for w in windows])
        gradients = [by_row + DECAY * table, by_logit + DECAY * softmax, np.array([-pull.sum(), pull.sum()])]
        for p, g, (m, v) in zip(parameters, gradients, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    weights = np.zeros(BUCKETS, np.int32)
    weights[used] = np.clip(np.rint(table @ (softmax[:, 1] - softmax[:, 0]) * UNIT), -(2**31) + 1, 2**31 - 1).astype(np.int32)
    return Model(weights, float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, most: int = SAMPLE_BYTES) -> Model:
    """Fits on at most ``sample`` labelled documents of each label (rows of ``labels``: doc_id, ``label``) and ``most`` bytes of them."""
    one = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    chosen = one.where("label = 0").orderBy(*by_hash).limit(sample).unionByName(one.where("label = 1").orderBy(*by_hash).limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # 2 x sample ids
    # whole texts of each label, as long as they fit into half the bytes
    so_far = F.sum(F.octet_length("text").cast("long")).over(Window.partitionBy("label").orderBy(*by_hash).rowsBetween(Window.unboundedPreceding, 0))
    found = rows.select("label", "text", so_far.alias("so_far")).where(F.col("so_far") <= most // 2).select("label", "text").toArrow()
    found = found.sort_by([("label", "ascending"), ("text", "ascending")])  # the same sums whatever order rows came in
    return fit(found.column("text"), found.column("label").to_numpy().astype(np.float64))


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
                yield tidied(pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array(scores)], names=[*(f"c{i}" for i in kept), "score"]))

    plain = docs.toDF(*(f"c{i}" for i in range(len(fields))))
    schema = T.StructType([*(T.StructField(f"c{i}", fields[i].dataType) for i in kept), T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*(docs.columns[i] for i in kept), name)


def held_out(column: str = "doc_id") -> Column:
    """The fold that is not learned from."""
    return crc_mod(column, 5) == 0


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(docs, read_table(spark, sf_dir, "labels").where(~held_out()))
    rows = scored(docs, model, kept=[0])
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
