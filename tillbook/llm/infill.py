"""Fill-in-middle transformation: a text's prefix, middle and suffix in another order.

Method: a text is cut into units (code points, or the matches of a pattern).
Blocks of ``BLOCK`` UTF-8 bytes hold how many units and code points begin in
them, in a Fenwick tree; a cut after ``k`` units is found by binary lifting down
the tree to the block where unit ``k`` begins, and by looking through that block
alone.  The same descent adds up the code points before the cut.

Where to cut, and in which form the parts are written, follows from the SHA-256
of the seed and the row's id alone, so that a retried task writes the same text:

* ``plain``: the text as it is (empty texts, texts that hold a sentinel, and
  ``PLAIN_SHARE`` of a hundred others);
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (``SPM_SHARE`` of a hundred);
* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle.

``restored`` turns a form back with DataFrame functions.  No sentinel can begin
or end inside another, and no text that is cut holds one, so the first place
where a sentinel occurs is where it was written.

Defined cases: a null text counts as empty and gives an empty plain text; a null
id has the empty string for its decimal; rows that repeat give equal rows; a
text of any length is cut whole, with memory in proportion to its batch; other
columns, whatever their names, are carried along by ``infilled``; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.common import read_table, slices, text_arrays, tidied

BLOCK = 1024
SEED = "1"
PLAIN_SHARE = 10
SPM_SHARE = 20
#: Fixed: the sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINELS = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]


class Fenwick:
    """Units and code points by block, summed by binary lifting."""

    def __init__(self, units: np.ndarray, points: np.ndarray):
        self.n = len(units)
        tree = np.zeros((self.n + 1, 2), np.int64)
        tree[1:, 0], tree[1:, 1] = units, points
        step = 1
        while 2 * step <= self.n:  # every node adds itself to the node above it, level by level
            above = tree[2 * step :: 2 * step]
            above += tree[step :: 2 * step][: len(above)]
            step *= 2
        self.tree = tree.tolist()

    def descend(self, k: int) -> tuple[int, int, int]:
        """The block where unit ``k`` (from 0) begins, and the units and code points before that block."""
        at = units = points = 0
        step = 1 << self.n.bit_length() >> 1
        while step:
            if at + step <= self.n and units + self.tree[at + step][0] <= k:
                at += step
                units += self.tree[at][0]
                points += self.tree[at][1]
            step >>= 1
        return at, units, points


class Text:
    """One text as UTF-8 bytes, with the bytes at which units and code points begin."""

    def __init__(self, raw: np.ndarray, pattern: regex.Pattern | None = None):
        self.raw = raw
        self.points = (raw & 0xC0) != 0x80
        self.edges = self.points
        if pattern is not None and len(raw):
            at = np.flatnonzero(self.points)
            self.edges = np.zeros(len(raw), bool)
            self.edges[at[[m.start() for m in pattern.finditer(raw.tobytes().decode())]]] = True
            self.edges[0] = True  # what no match covers belongs to the unit before it
        starts = np.arange(0, len(raw), BLOCK)
        counted = [np.add.reduceat(x.astype(np.int64), starts) if len(raw) else np.zeros(0, np.int64) for x in (self.edges, self.points)]
        self.tree = Fenwick(*counted)
        self.units = int(counted[0].sum())

    def cut(self, k: int) -> tuple[int, int]:
        """Byte position and code points of the cut after ``k`` units."""
        block, units, points = self.tree.descend(k)
        begin = block * BLOCK
        if begin >= len(self.raw):
            return len(self.raw), points
        at = int(np.flatnonzero(self.edges[begin : begin + BLOCK])[k - units])
        return begin + at, points + int(np.count_nonzero(self.points[begin : begin + at]))


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """The four numbers that decide a row's cuts and form."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]


def arranged(raw: np.ndarray, doc_id: int | None, pattern: regex.Pattern | None = None, seed: str = SEED) -> tuple[bytes, str, int, int | None, int | None]:
    """A text's output, form, units, and code points of prefix and middle (None in plain form)."""
    text = Text(raw, pattern)
    whole = raw.tobytes()
    h = draws(doc_id, seed)
    if not whole or h[2] % 100 >= 100 - PLAIN_SHARE or any(s in whole for s in _SENTINELS):
        return whole, "plain", text.units, None, None
    (a, before), (b, until) = (text.cut(k) for k in sorted(x % (text.units + 1) for x in h[:2]))
    p, s, m = _SENTINELS
    if h[3] % 100 < SPM_SHARE:
        return s + whole[b:] + p + whole[:a] + m + whole[a:b], "spm", text.units, before, until - before
    return p + whole[:a] + s + whole[b:] + m + whole[a:b], "psm", text.units, before, until - before


def infilled(docs: DataFrame, id_column: str = "doc_id", text: str = "text", pattern: str | None = None, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` with ``fim_text``, ``fim_form``, ``fim_units``, ``fim_prefix_chars`` and ``fim_middle_chars`` behind its columns.

    Units are code points, or the matches of ``pattern``, found from left to right."""
    names, fields = docs.columns, docs.schema.fields
    key, body = names.index(id_column), names.index(text)
    rule = regex.compile(pattern) if pattern is not None else None
    made = [("fim_text", T.StringType()), ("fim_form", T.StringType()), ("fim_units", T.LongType()), ("fim_prefix_chars", T.LongType()), ("fim_middle_chars", T.LongType())]
    arrow = [pa.large_string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    kept = [f"c{i}" for i in range(len(names))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, kept[body]):
                raw, ends = text_arrays(part.column(body))
                rows = [arranged(raw[a:b], i, rule, seed) for a, b, i in zip(ends[:-1], ends[1:], part.column(key).to_pylist(), strict=True)]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                out = [pa.array(columns[0], pa.large_binary()).cast(pa.large_string()), *(pa.array(c, t) for c, t in zip(columns[1:], arrow[1:], strict=True))]
                yield tidied(pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), *out], names=kept + [n for n, _ in made]))

    plain = docs.toDF(*kept).withColumn(f"c{body}", F.coalesce(F.col(f"c{body}").cast("string"), F.lit("")))
    schema = T.StructType([*(T.StructField(k, T.StringType() if i == body else f.dataType) for i, (k, f) in enumerate(zip(kept, fields, strict=True))), *(T.StructField(n, t) for n, t in made)])
    return plain.mapInArrow(run, schema).toDF(*names, *(n for n, _ in made))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    p, s, m = (F.instr(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    width, end = F.lit(len(PREFIX)), F.length(output) + 1

    def between(start: Column, stop: Column) -> Column:
        return output.substr(start + width, stop - start - width)

    psm = F.concat(between(p, s), between(m, end), between(s, m))
    spm = F.concat(between(p, m), between(m, end), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = infilled(docs)
    return rows.select(
        "doc_id",
        F.col("fim_units").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim_text"), F.col("fim_form")).cast("binary"), 256).alias("restored_sha256"),
    )
