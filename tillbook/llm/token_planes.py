"""Token-id output: bit-plane shuffled blocks with a chunk index.

Method: a shard's ids (documents in ascending order) are cut into blocks of a
fixed number of ids.  A block is transposed into planes - plane k holds byte k
(or bit k) of every id - and each plane is compressed by itself with
zstandard: the high planes hold few distinct values and shrink to little.

File format: a folder of Parquet files written by Spark's committed writer (a
lost or repeated task leaves no half file); a row is a chunk::

    shard, chunk      place of the chunk in the shard (0, 1, ...)
    first_id, n_ids   the shard's ids that it holds
    plane_kind        'byte' or 'bit'
    planes            array<binary>, one zstandard frame per plane
    docs              chunk index: array<struct<doc, doc_id, first_id, last, n_ids>>,
                      the pieces of documents in it (doc: place in the shard)

All columns but ``planes`` are the index; Parquet reads them without the planes.

Defined cases: a null or empty text holds the end id only; null doc_ids come
first; equal doc_ids are ordered by text; a document longer than a block
spans chunks; an empty table gives an empty folder; further columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.byte_bpe import byte_characters
from tillbook.llm.common import id_and_text, read_table, slices, text_bytes
from tillbook.session import run_folder

#: Ids in a block.
BLOCK_IDS = 1 << 16
#: Bytes of text that one shard holds on average.
FILE_TEXT_BYTES = 16 << 20
#: Shards at most (then they hold more text): what is known of each when the files are read back fits the driver.
MOST_FILES = 100_000
#: Words a worker remembers before it forgets all of them.
REMEMBERED = 1_000_000
ZSTD_LEVEL = 3


# ---------------------------------------------------------------- planes


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """Compressed planes of uint32 ids; planes that hold only zeros at the top are left out."""
    packer = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        planes = list(np.ascontiguousarray(octets.T))
    else:
        planes = list(np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1))
    while len(planes) > 1 and not planes[-1].any():
        planes.pop()
    return [packer.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n_ids: int, kind: str = "byte") -> np.ndarray:
    opener = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(opener.decompress(p), np.uint8) for p in planes]
    if kind == "byte":
        octets = np.zeros((n_ids, 4), np.uint8)
        for k, plane in enumerate(raw):
            octets[:, k] = plane
    else:
        bits = np.zeros((32, n_ids), np.uint8)
        for k, plane in enumerate(raw):
            bits[k] = np.unpackbits(plane)[:n_ids]
        octets = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


# ---------------------------------------------------------------- crc32 of joined pieces

_CRC_POLY = 0xEDB88320


def _crc_times(a: int, b: int) -> int:
    """Product of two polynomials modulo the crc polynomial (bits reflected)."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (_CRC_POLY if b & 1 else 0)
    return out


@lru_cache(maxsize=4096)
def _crc_shift(n_bytes: int) -> int:
    """x ** (8 * n_bytes) modulo the crc polynomial."""
    power, square, n = 1 << 31, 1 << 30, 8 * n_bytes
    while n:
        if n & 1:
            power = _crc_times(power, square)
        square, n = _crc_times(square, square), n >> 1
    return power


def joined_crc(pieces: Iterable[tuple[int, int]]) -> int:
    """crc32 of bytes from the (crc32, length) of their consecutive pieces."""
    out = 0
    for crc, n in pieces:
        out = _crc_times(_crc_shift(n), out) ^ crc
    return out


# ---------------------------------------------------------------- encoding


#: Characters of texts whose pieces a plain pattern finds: Latin letters, digits, ASCII signs but the apostrophe.
_SIGNS = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"""
_PLAIN = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ÿ0-9 \n{_SIGNS}]*")
_PIECES = re.compile(rf"[a-zß-öø-ÿ]+|[0-9]|[{_SIGNS}]+")


class WordCoder:
    """A tokenizers file whose merges never cross a space, with what words encode to remembered.

    A text of plain characters is lower-cased and cut to letters, single digits
    and runs of signs, as the file's own steps do; the library's merges then
    run on new pieces alone.  In other texts, words go through all its steps."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merges = self.tokenizer.model
        self.characters = dict(enumerate(byte_characters()))
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str], plain: bool) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(words)
        if plain:
            tokenize, characters = self.merges.tokenize, self.characters
            for w in new:
                shown = w if w.isascii() else w.encode().decode("latin-1").translate(characters)
                self.known[w] = array("I", [t.id for t in tokenize(shown)]).tobytes()
        elif new:
            self.known.update(zip(new, (array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Each text's ids and the end id, as uint32."""
        last = np.array([end], "<u4").tobytes()
        out: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        for plain in (True, False):
            at = [i for i, t in enumerate(texts) if (_PLAIN.fullmatch(t) is not None) == plain]
            parts = [_PIECES.findall(texts[i].lower()) if plain else texts[i].replace("\n", " ").split(" ") for i in at]
            self.learn(set().union(*parts), plain)
            known = self.known.__getitem__
            for i, own in zip(at, parts, strict=True):
                out[i] = np.frombuffer(b"".join([*map(known, own), last]), "<u4")
        return out


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordCoder(path)


# ---------------------------------------------------------------- writing and reading

_PIECE = pa.struct([("doc", pa.int64()), ("doc_id", pa.int64()), ("first_id", pa.int64()), ("last", pa.bool_()), ("n_ids", pa.int64())])
_CHUNK = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("plane_kind", pa.string()), ("planes", pa.list_(pa.binary())), ("docs", pa.list_(_PIECE))])
CHUNK = "shard long, chunk long, first_id long, n_ids long, plane_kind string, planes array<binary>, docs array<struct<doc: long, doc_id: long, first_id: long, last: boolean, n_ids: long>>"


class _Blocks:
    """Cuts a stream of documents' ids into chunks."""

    def __init__(self, shard: int, block: int, kind: str):
        self.shard, self.block, self.kind = shard, block, kind
        self.chunk = self.docs = self.first = 0
        self.held: list[np.ndarray] = []
        self.size, self.pieces = 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.block - self.size)
            self.held.append(ids[at : at + n])
            self.pieces.append({"doc": self.docs, "doc_id": doc_id, "first_id": self.first + self.size, "last": at + n == len(ids), "n_ids": n})
            self.size, at = self.size + n, at + n
            if self.size == self.block:
                yield self.flush()
        self.docs += 1

    def flush(self) -> pa.RecordBatch:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        row = [self.shard, self.chunk, self.first, self.size, self.kind, to_planes(ids, self.kind), self.pieces]
        self.chunk, self.first = self.chunk + 1, self.first + self.size
        self.held, self.size, self.pieces = [], 0, []
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK, strict=True)], schema=_CHUNK)


def write(docs: DataFrame, folder: str, path: str, end: int, block: int = BLOCK_IDS, kind: str = "byte") -> None:
    """Encodes every text of ``docs`` with the tokenizers file ``path`` and writes the chunks to ``folder``, shards in ascending doc_id order."""
    rows = id_and_text(docs)
    shards = min(max(1, math.ceil(text_bytes(rows) / FILE_TEXT_BYTES)), MOST_FILES)
    rows = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        blocks = _Blocks(TaskContext.get().partitionId(), block, kind)
        for batch in batches:
            for part in slices(batch):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), words.encode(part.column("text").to_pylist(), end), strict=True):
                    yield from blocks.add(doc_id, ids)
        if blocks.size:
            yield blocks.flush()

    # the planes are compressed already
    rows.mapInArrow(run, CHUNK).write.option("compression", "none").parquet(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Reads a folder back: ``doc_id, start, n_tokens, ids_crc32`` per document.

    A chunk is opened by itself; a document that spans chunks is put together
    from its pieces' checksums, so no task holds more than a chunk of ids."""
    chunks = spark.read.parquet(folder)
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # MOST_FILES rows at most, from the index columns
    before, starts = 0, {}
    for row in totals:
        starts[row.shard], before = before, before + row.n

    out = pa.schema([("shard", pa.int64()), ("doc", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), ("crc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                raw = from_planes(chunk["planes"], chunk["n_ids"], chunk["plane_kind"]).tobytes()
                rows = []
                for piece in chunk["docs"]:
                    at = 4 * (piece["first_id"] - chunk["first_id"])
                    crc = zlib.crc32(raw[at : at + 4 * piece["n_ids"]])
                    rows.append((chunk["shard"], piece["doc"], piece["doc_id"], starts[chunk["shard"]] + piece["first_id"], piece["n_ids"], crc))
                columns = zip(*rows, strict=True) if rows else [[]] * len(out)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    pieces = chunks.mapInArrow(run, "shard long, doc long, doc_id long, start long, n_ids long, crc long")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            crcs = [own[0]["crc"] if len(own) == 1 else joined_crc((p["crc"], 4 * p["n_ids"]) for p in own) for own in columns["pieces"]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    per_doc = pieces.groupBy("shard", "doc").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.sum("n_ids").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("start", "n_ids", "crc"))).alias("pieces"),  # a document's length / BLOCK_IDS entries
    )
    return per_doc.select("doc_id", "start", "n_tokens", "pieces").mapInArrow(join, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = run_folder(spark, "token-planes")
    write(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return read_documents(spark, folder)
