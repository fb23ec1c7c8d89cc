"""Helpers shared by the operators: reading documents, hashing words of whole
Arrow batches with numpy, and the two-way exchange between shards of documents
and buckets of keys."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one shard of documents holds on average.
SHARD_BYTES = 4 << 20
SMALL_SHARDS = 50_000
#: Rows an Arrow-batch operator turns to numpy arrays at a time.
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) of every row; other columns are not read."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def crc_mod(column: str, n: int):
    """crc32 of the id's decimal text, modulo ``n`` (a null id counts as the empty string)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


# ---------------------------------------------------------------- Arrow to numpy


def text_arrays(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column as one uint8 array, and its n+1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            column = pa.array([], column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch | pa.Table, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch | pa.Table]:
    """Cuts a batch so that each part has about ``most`` bytes of text (one row at least)."""
    sizes = np.diff(text_arrays(batch.column(column))[1])
    at = 0
    while at < batch.num_rows:
        n = int(np.searchsorted(np.cumsum(sizes[at:]), most, side="right"))
        yield batch.slice(at, max(1, n))
        at += max(1, n)


# ---------------------------------------------------------------- hashes of byte ranges

_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so that it has an inverse modulo 2**64
_BASE = (_BASE & ~7) | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: dict[int, np.ndarray] = {}
_POWERS: dict[int, np.ndarray] = {}


def _byte_table(seed: int) -> np.ndarray:
    """A fixed pseudo-random 64-bit value for each byte."""
    if seed not in _TABLES:
        with np.errstate(over="ignore"):
            _TABLES[seed] = mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000003))
    return _TABLES[seed]


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64 (kept per process)."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = -(-n // (1 << 20)) << 20
        have = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            while len(have) < size:
                have = np.concatenate([have, have[: size - len(have)] * np.uint64(pow(base, len(have), 1 << 64))])
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every input bit over the whole word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """n+1 prefix sums of values[i] * base**i modulo 2**64."""
    out = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range [start, end) from its prefix sums: equal content, equal hash."""
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts] + (ends - starts).astype(np.uint64))


def block_hashes(raw: np.ndarray, offsets: np.ndarray, values: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """Hashes of ascending byte ranges that lie in one row each, ``values`` (by byte) summed for some ``most`` bytes of rows at a time."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(raw):
        to = int(offsets[min(max(np.searchsorted(offsets, at + most, side="right") - 1, np.searchsorted(offsets, at, side="right")), len(offsets) - 1)])
        i, j = np.searchsorted(starts, [at, to])
        out[i:j] = range_hashes(prefix_sums(values[raw[at:to]]), starts[i:j] - at, ends[i:j] - at)
        at = to
    return out


#: Fixed: bytes that part words (space, and 0x09 to 0x0D).
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Byte to byte, A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """White-space separated words of a column of texts, A-Z lower-cased.

    ``starts`` and ``ends`` are byte positions in ``raw``; ``doc`` the row of
    each word; ``first`` the index of each row's first word (n+1 entries)."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, seed: int = 0):
        self.raw, self.offsets = text_arrays(column)
        inside = ~WHITE[self.raw]
        edge = np.zeros(len(self.raw) + 1, bool)
        edge[self.offsets] = True  # a row's edge parts words as white space does
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        finishes = inside.copy()
        finishes[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.doc = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))
        self.hashes = block_hashes(self.raw, self.offsets, _byte_table(seed)[LOWER], self.starts, self.ends)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and row of every n-word shingle; a row of 1 to n-1 words has one shingle, all of them."""
        counts = np.diff(self.first)
        per = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
        rows = np.repeat(np.arange(len(counts)), per)
        begin = np.repeat(self.first[:-1] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(per.sum())
        end = np.minimum(begin + n, self.first[rows + 1])
        return range_hashes(prefix_sums(self.hashes), begin, end), rows


# ---------------------------------------------------------------- shards and buckets


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def shard_count(total: int, shard_bytes: int = SHARD_BYTES) -> int:
    """Shards for so much text.  Beyond ``SMALL_SHARDS`` of them they grow, 16-fold at most,
    so that what a shard sends to a bucket stays more than a few keys."""
    return max(1, math.ceil(total / max(shard_bytes, min(total // SMALL_SHARDS, 16 * shard_bytes))))


def sharded(docs: DataFrame, shards: int) -> DataFrame:
    """Adds ``shard``, a hash of the row: about ``SHARD_BYTES`` of text in each, whatever the key's skew."""
    return docs.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))


PARCEL = "shard long, bucket long, payload binary"
_PARCEL = pa.schema([("shard", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])


def parcels(rows: Iterable[tuple[int, int, bytes]]) -> pa.Table:
    rows = list(rows)
    return pa.table([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else ([], [], []), _PARCEL, strict=True)], schema=_PARCEL)


def tidied(table: pa.Table) -> pa.Table:
    """Gives memory that Arrow keeps for later back to the system: workers live on between stages."""
    pa.default_memory_pool().release_unused()
    return table


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in sorted uint64 keys (buckets + 1 entries); a bucket is an equal range of the keys' high 32 bits."""
    cuts = (np.arange(1, buckets, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets) << np.uint64(32)
    return np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]])


def send(shard_rows: DataFrame, emit: Callable[[int, pa.Table], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """Runs ``emit(shard, rows)`` on each shard: parcels (bucket, payload) addressed to buckets."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        return tidied(parcels((shard, bucket, payload) for bucket, payload in emit(shard, rows)))

    return shard_rows.groupBy("shard").applyInArrow(run, PARCEL)


def answer(sent: DataFrame, reduce: Callable[[int, list[int], list[bytes]], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """Runs ``reduce(bucket, shards, payloads)`` on each bucket's parcels: (shard, payload) replies.

    A key occurs once per shard at most, so one very common key adds one entry
    per shard to its bucket and never one per occurrence."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        order = np.argsort(rows.column("shard").to_numpy(), kind="stable")
        shards, payloads = rows.column("shard").to_pylist(), rows.column("payload").to_pylist()
        out = reduce(bucket, [shards[i] for i in order], [payloads[i] for i in order])
        return tidied(parcels((shard, bucket, payload) for shard, payload in out))

    return sent.groupBy("bucket").applyInArrow(run, PARCEL)


def meet(shard_rows: DataFrame, replies: DataFrame, finish: Callable[[int, pa.Table, dict[int, bytes]], pa.Table], schema: str) -> DataFrame:
    """Brings each shard's rows and its replies (by bucket) together again."""

    def run(key: tuple, rows: pa.Table, got: pa.Table) -> pa.Table:
        by_bucket = dict(zip(got.column("bucket").to_pylist(), got.column("payload").to_pylist(), strict=True))
        return tidied(finish(key[0].as_py(), rows, by_bucket))

    return shard_rows.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(run, schema)
