"""Byte-level BPE encoding and decoding.

Method: the tokenizers library runs the merges over Arrow batches.  Bytes are
mapped to printable characters before the merges, and ids are decoded by
turning that table round; offsets are kept in bytes and in characters.

* A rank file gives the vocabulary; every way to part a token into two known
  tokens becomes a merge of that token's rank.
* Text is first cut by the pattern; each match is encoded by itself, and
  what a match encodes to is remembered per worker (bounded).  The ``regex``
  module and the rank library follow different Unicode versions: a text with a
  character that Python's own tables don't know yet goes to that library whole.
* Decoding works on bytes, so a character whose bytes lie in several tokens
  comes out whole; ``decode_text`` replaces bytes that are not UTF-8, and
  ``character_offsets`` gives the characters that a token touches.

Defined cases: a null or empty text has no tokens; repeated rows give repeated
results; a null doc_id is carried along; other columns are not read (or, in
``encode``, carried along unchanged, whatever their names).
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillbook.llm.common import id_and_text, read_table, slices

#: Matches a worker remembers before it forgets all of them.
REMEMBERED = 400_000
#: Ids that are made Python numbers at a time.
DECODED = 500_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


def too_young(text: str) -> bool:
    """Whether a character is not in Python's Unicode tables."""
    return not text.isascii() and any(unicodedata.category(c) == "Cn" for c in text)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import models

        self.ranks = read_ranks(path)
        self.table: dict[int, bytes] = {rank: token for token, rank in self.ranks.items()}
        table = byte_characters()
        shown = {token: "".join(table[b] for b in token) for token in self.ranks}
        merges = [
            (shown[token[:cut]], shown[token[cut:]])
            for token, _ in sorted(self.ranks.items(), key=lambda item: item[1])
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        self.merges = models.BPE(vocab={shown[t]: r for t, r in self.ranks.items()}, merges=merges, ignore_merges=True)
        self.characters = dict(enumerate(table))
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}  # ids of a match, as uint32
        self.pattern_text = pattern
        self.young: set[str] = set()  # matches with such a character

    def learn(self, matches: set[str]) -> None:
        new = [m for m in matches if m not in self.known]
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known, self.young, new = {}, set(), list(matches)
            self.young.update(filter(too_young, new))
            tokenize, characters = self.merges.tokenize, self.characters
            for m in new:  # a match is one word to the merges: its bytes, shown as characters
                self.known[m] = array("I", [t.id for t in tokenize(m.encode().decode("latin-1").translate(characters))]).tobytes()

    @cached_property
    def whole_text(self):
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=self.pattern_text, mergeable_ranks=self.ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        parts = [self.pattern.findall(text) for text in texts]
        self.learn(set().union(*parts))
        known = self.known.__getitem__
        out = [np.frombuffer(b"".join(map(known, own)), "<u4").tolist() for own in parts]
        for n, own in enumerate(parts if self.young else []):
            if not self.young.isdisjoint(own):
                out[n] = self.whole_text.encode_ordinary(texts[n])
        return out

    def decode(self, ids: list[int]) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids])

    def decode_text(self, ids: list[int]) -> str:
        return self.decode(ids).decode("utf-8", errors="replace")

    def byte_ends(self, ids: list[int]) -> np.ndarray:
        """Byte position after each token."""
        return np.cumsum([len(self.table[i]) for i in ids], dtype=np.int64)

    def character_offsets(self, ids: list[int]) -> list[tuple[int, int]]:
        """For each token the characters [first, end) that it holds bytes of."""
        raw = np.frombuffer(self.decode(ids), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # a continuation byte belongs to the character before
        ends = self.byte_ends(ids)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return [(int(character[a]), int(character[b - 1]) + 1) for a, b in zip(starts, ends, strict=True)]


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return ByteBpe(path, pattern)


_OFFSET = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", prefix: str = "bpe_", offsets: bool = True, decoded: bool = False) -> DataFrame:
    """All columns of ``docs`` and ``<prefix>ids`` array<int>, with ``offsets`` the characters [first, end) of
    each token, and with ``decoded`` the text that the ids give (``<prefix>text``).

    The rank file is read from ``path`` on each executor."""
    position = docs.columns.index(text)
    added = [T.StructField(f"{prefix}ids", T.ArrayType(T.IntegerType()))]
    added += [T.StructField(f"{prefix}offsets", T.ArrayType(_OFFSET))] * offsets + [T.StructField(f"{prefix}text", T.StringType())] * decoded
    kinds = [pa.list_(pa.int32())] + [pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))] * offsets + [pa.string()] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        bpe = coder(path, pattern)
        for batch in batches:
            for part in slices(batch, batch.schema.names[position], 1 << 20):
                ids = bpe.encode([t or "" for t in part.column(position).to_pylist()])
                new: list[list] = [ids]
                if offsets:
                    new.append([[{"first": a, "end": b} for a, b in bpe.character_offsets(own)] for own in ids])
                if decoded:
                    new.append([bpe.decode_text(own) for own in ids])
                yield [*part.columns, *(pa.array(v, k) for v, k in zip(new, kinds, strict=True))]

    return _with_columns(docs, added, run)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "bpe_ids", name: str = "bpe_text") -> DataFrame:
    """All columns of ``docs`` and the text of each row's ids (null ids: no tokens); bytes that are no UTF-8 are replaced."""
    position = docs.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        bpe = coder(path, pattern)
        for batch in batches:
            ends = np.cumsum(batch.column(position).value_lengths().fill_null(0).to_numpy())
            at = 0
            while at < batch.num_rows:  # so many ids at a time, or one row
                seen = ends[at - 1] if at else 0
                n = max(1, int(np.searchsorted(ends, seen + DECODED, side="right")) - at)
                part = batch.slice(at, n)
                yield [*part.columns, pa.array([bpe.decode_text(own or []) for own in part.column(position).to_pylist()], pa.string())]
                at += n

    return _with_columns(docs, [T.StructField(name, T.StringType())], run)


def _with_columns(docs: DataFrame, added: list[T.StructField], run) -> DataFrame:
    """Runs ``run`` over Arrow batches; columns are known by place, so that clashing names don't matter."""
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate([*docs.schema.fields, *added])]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(batches):
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(named, T.StructType(fields)).toDF(*docs.columns, *(f.name for f in added))


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_bytes", pa.int64())])


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256, n_bytes decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        shown = {i: str(i) for i in bpe.table}
        for batch in batches:
            for part in slices(batch):
                ids = bpe.encode(part.column("text").to_pylist())
                decoded = [bpe.decode(own) for own in ids]
                columns = [
                    part.column("doc_id"),
                    [len(own) for own in ids],
                    [hashlib.sha256(",".join([shown[i] for i in own]).encode()).hexdigest() for own in ids],
                    [hashlib.sha256(b).hexdigest() for b in decoded],
                    [len(b) for b in decoded],
                ]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _DIGEST, strict=True)], schema=_DIGEST)

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
