"""Suffix-array deduplication of repeated byte strings across documents.

A byte goes if a ``length``-byte string that covers it also starts in a
document with a smaller doc_id.

Method: column-wise construction of a collection's Burrows-Wheeler transform
and longest common prefixes.  Each round inserts one symbol of every string:
the new suffixes' places follow from the transform so far by counting symbols
(LF mapping), their common prefixes from range minima.  In the finished order,
strings of ``length`` equal bytes stand together.

The rounds needed are as many as the longest string has symbols, and only
strings that repeat matter, so whole documents are not inserted.  They are cut
to runs first: a window of ``length`` bytes belongs to the smallest hash of the
``GRAM``-byte strings in it, and consecutive windows of one such minimiser form
a run of at most ``RUN`` windows.  Equal windows have equal minimisers, so

1. shards tell the buckets which minimisers they hold; those of one document
   alone are done with (the answer is a bit for each);
2. of the others the runs' hashes are sent.  A window in two kinds of run has the
   minimiser at one place in both, so they agree on the bytes around it that all windows
   near that place hold: four hashes, one for each quarter of the places.  Where no
   other kind has an equal hash, the first document that has the kind is the whole answer;
3. the bytes of the remaining kinds of run are sent, each kind once per shard,
   and inserted column by column (a symbol is five bytes, so each is inserted from five starts, in
   17 rounds instead of 81), which says for each window where it is first.

A minimiser with more than ``HOT_KINDS`` kinds of run that may share windows (a
passage that very many documents share in different surroundings) has the windows of its
runs sent one by one, each to the bucket of its own hash: the shared ones go once
from each shard, and the others spread over all buckets.  Nothing is left out; the
buckets hold the collection that a single machine would keep in external files.

Runs are compared by 64-bit hashes within one minimiser's group, windows by
their bytes.

Defined cases: null or empty texts and texts shorter than ``length`` lose
nothing; rows with a null doc_id neither lose nor cause anything; rows with
equal doc_ids are one document to each other (neither is earlier); repeated
rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillbook.llm.common import (
    _INVERSE,
    _byte_table,
    answer,
    bucket_edges,
    id_and_text,
    meet,
    mix,
    parcels,
    powers,
    prefix_sums,
    range_hashes,
    read_table,
    send,
    shard_count,
    sharded,
    slices,
    text_arrays,
    text_bytes,
    tidied,
)

LENGTH = 50
GRAM = 24
#: Kinds of run of one minimiser beyond which their windows go on one by one.
HOT_KINDS = 20_000
#: Windows in a run at most.
RUN = 32
NO_DOC = np.iinfo(np.int64).max


# ---------------------------------------------------------------- the construction


_SPAN = 512  # a power of two


def _sparse_minima(values: np.ndarray, most: int) -> list[np.ndarray]:
    """Minima of 1, 2, 4, ... up to ``most`` neighbours."""
    levels = [values]
    while 2 << len(levels) - 1 <= min(len(values), most):
        half = 1 << len(levels) - 1
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def _lookup(levels: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    level = np.frexp(last - first + 1)[1] - 1
    out = np.empty(len(first), levels[0].dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(levels[k][first[at]], levels[k][last[at] - (1 << int(k)) + 1])
    return out


class _RangeMin:
    """Minima of ranges [first, last], both inclusive; long ones by spans of ``_SPAN``."""

    def __init__(self, values: np.ndarray):
        self.near = _sparse_minima(values, _SPAN)
        whole = len(values) // _SPAN
        self.far = _sparse_minima(values[: whole * _SPAN].reshape(whole, _SPAN).min(1), whole) if whole else []

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        long = last - first >= _SPAN
        if not long.any():
            return _lookup(self.near, first, last)
        out = np.empty(len(first), np.uint8)
        out[~long] = _lookup(self.near, first[~long], last[~long])
        a, b = first[long], last[long]
        edge = np.minimum(_lookup(self.near, a, a + _SPAN - 1), _lookup(self.near, b - _SPAN + 1, b))
        begin, end = -(-a // _SPAN), (b + 1) // _SPAN - 1  # spans that lie inside
        inner = begin <= end
        edge[inner] = np.minimum(edge[inner], _lookup(self.far, begin[inner], end[inner]))
        out[long] = edge
        return out


_PLACE = np.int64((1 << 32) - 1)


def construct(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transform (ranks of symbols from 1 on, 0 for an end), common prefixes (uint8) and LF order of strings of at most 254 symbols.

    Round j inserts, for every string that has so many symbols, its suffix of
    j symbols; ends sort before all symbols and by string.  ``keys`` has symbol and place of
    each row, ascending: what LF mapping counts in.  Insertion keeps the
    order of the rows that are there, so a round merges its few new keys."""
    count = len(offsets) - 1
    data = np.unique(data, return_inverse=True)[1].astype(np.uint32) + np.uint32(1)
    left = np.diff(offsets)  # symbols not inserted yet
    bwt, lcp = np.zeros(count, np.uint32), np.zeros(count, np.uint8)
    alive = np.flatnonzero(left > 0)
    bwt[alive] = data[offsets[1:][alive] - 1]
    place, symbol = alive.copy(), bwt[alive]
    keys = np.sort(bwt.astype(np.int64) << 32 | np.arange(count))
    while len(alive):
        n = len(bwt)
        own = symbol.astype(np.int64) << 32 | place
        ascending = np.argsort(own)
        alive, symbol = alive[ascending], symbol[ascending]
        rank = np.searchsorted(keys, own[ascending])
        ends = int(np.searchsorted(keys, 1 << 32))  # rows whose symbol is an end have no suffix before them
        least = _RangeMin(lcp)

        def prefix(k: np.ndarray, keys=keys, least=least) -> np.ndarray:
            """Common prefix of the suffixes that the rows of ranks k - 1 and k lead to."""
            out = np.zeros(len(k), np.uint8)
            before, here = keys[np.maximum(k - 1, 0)], keys[k]
            same = (k > 0) & (before >> 32 == here >> 32)
            out[same] = least((before[same] & _PLACE) + 1, here[same] & _PLACE) + 1
            return out

        left[alive] -= 1
        more = left[alive] > 0
        new_symbol = np.zeros(len(alive), np.uint32)
        new_symbol[more] = data[offsets[alive[more]] + left[alive[more]] - 1]
        target = count + rank - ends
        old = np.ones(n + len(alive), bool)
        old[target] = False
        grown = np.empty(n + len(alive), np.uint32)
        common = np.empty(n + len(alive), np.uint8)
        grown[old], common[old] = bwt, lcp
        grown[target], common[target] = new_symbol, prefix(rank)
        after = rank + 1  # whose predecessor may be new
        after = after[after < n]
        common[count + after - ends] = prefix(after)
        # the old keys with their new places, the new ones between them
        moved = keys & ~_PLACE | np.flatnonzero(old)[keys & _PLACE]
        fresh = np.sort(new_symbol.astype(np.int64) << 32 | target)
        at = np.searchsorted(moved, fresh) + np.arange(len(fresh))
        kept = np.ones(n + len(fresh), bool)
        kept[at] = False
        keys = np.empty(n + len(fresh), np.int64)
        keys[kept], keys[at] = moved, fresh
        bwt, lcp = grown, common
        alive, place, symbol = alive[more], target[more], new_symbol[more]
    return bwt, lcp, keys & _PLACE


def build(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transform and common prefixes of strings of bytes."""
    return construct(data, offsets)[:2]


def symbol_bytes(length: int) -> int:
    """Bytes that one symbol of the construction holds: windows are a whole number of symbols."""
    return next(n for n in (7, 6, 5, 4, 3, 2, 1) if length % n == 0)


def first_seen(data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each string (rows) and start (columns, RUN at most) the smallest document with an equal window; NO_DOC where the string is over.

    A symbol is ``unit`` bytes, so a string is inserted ``unit`` times, from its first ``unit``
    starts: as many symbols in all as bytes, in that many times fewer rounds.  Every window begins
    at a symbol of one of them, and equal windows are equal symbols."""
    unit, count = symbol_bytes(length), len(offsets) - 1
    windows = np.diff(offsets) - length + 1
    begins = np.repeat(np.arange(count), np.clip(windows, 0, unit))  # the string of each insertion
    shift = np.arange(len(begins)) - np.searchsorted(begins, begins)
    own = -(-(windows[begins] - shift) // unit)  # windows that begin at its symbols
    sizes = own - 1 + length // unit
    ends = np.cumsum(sizes)
    at = np.repeat(offsets[:-1][begins] + shift, sizes) + (np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)) * unit
    symbols = np.zeros(len(at), np.int64)
    for k in range(unit):
        symbols = symbols << 8 | data[at + k]
    starts = max(1, int(windows.max(initial=0)))
    out = np.full((count, starts), NO_DOC)
    if not len(begins):
        return out
    bwt, lcp, order = construct(symbols, np.concatenate([[0], ends]))
    lf = np.empty(len(bwt), np.int64)
    lf[order] = np.arange(len(bwt))
    lf += len(begins) - np.count_nonzero(bwt == 0)
    doc_at = np.full(len(bwt), NO_DOC)
    where = np.full((count, starts), -1, np.int64)
    place = np.arange(len(begins))
    for size in range(1, int(sizes.max()) + 1):  # the rows of the suffixes of each size, by walking back from the ends
        going = np.flatnonzero(sizes >= size)
        place[going] = lf[place[going]]
        if size * unit >= length:
            where[begins[going], shift[going] + (sizes[going] - size) * unit] = place[going]
            doc_at[place[going]] = docs[begins[going]]
    group = np.flatnonzero(lcp < length // unit)
    least = np.minimum.reduceat(doc_at, group)
    group_of = np.cumsum(lcp < length // unit) - 1
    return np.where(where >= 0, least[group_of[where]], NO_DOC)


# ---------------------------------------------------------------- runs of a shard


def gram_hashes(sums: np.ndarray, at: slice | np.ndarray, gram: int) -> np.ndarray:
    """Hashes of the ``gram`` bytes at some places."""
    after = slice(at.start + gram, at.stop + gram) if isinstance(at, slice) else at + gram
    with np.errstate(over="ignore"):
        h = (sums[after] - sums[at]) * powers(_INVERSE, len(sums))[at]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def minima(sums: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each gram, and the smallest in each window of ``length`` bytes."""
    n = len(sums) - 1
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = gram_hashes(sums, slice(0, n - gram + 1), gram)
    wide, step, least = length - gram + 1, 1, h
    while 2 * step <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return h, np.minimum(least[: len(least) - (wide - step)], least[wide - step :]) if step < wide else least


def places(grams: np.ndarray, least: np.ndarray, start: np.ndarray, stop: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each run the last place of its minimiser, and whether it has others."""
    wide = np.arange(length - gram + 1)
    place, twice = np.zeros(len(start), np.int64), np.zeros(len(start), bool)
    for at in range(0, len(start), 1 << 14):
        a, b = start[at : at + (1 << 14)], stop[at : at + (1 << 14)]
        own = least[a][:, None]
        last = b - 1 + wide[-1] - np.argmax(grams[(b - 1)[:, None] + wide[::-1]] == own, axis=1)
        place[at : at + len(a)] = last
        twice[at : at + len(a)] = a + np.argmax(grams[a[:, None] + wide] == own, axis=1) != last
    return place, twice


def cut_to_runs(raw: np.ndarray, offsets: np.ndarray, docs: np.ndarray, gram: int, length: int):
    """Runs of some rows: start, stop (last window + 1), place of the minimiser and whether it has others."""
    rows, sums = len(offsets) - 1, prefix_sums(_byte_table(0)[raw])
    grams, least = minima(sums, gram, length)
    n = len(least)
    sizes = np.diff(offsets)
    valid = np.where(docs != NO_DOC, np.maximum(sizes - length + 1, 0), 0)
    # no window opens at a row's last bytes, so windows of two rows are never neighbours
    inside = np.repeat(np.tile([True, False], rows), np.stack([valid, sizes - valid], 1).ravel())[:n]
    first = inside.copy()
    first[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    pieces = -(-(stop - start) // RUN)  # long runs (text that repeats itself) are cut
    if len(start) and pieces.max() > 1:
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        end_of = np.repeat(stop, pieces)
        start = np.repeat(start, pieces) + nth * RUN
        stop = np.minimum(start + RUN, end_of)
    return start, stop, *places(grams, least, start, stop, gram, length)


#: A run in 16 bits: its windows less one, its minimiser's distance from the last window, whether the minimiser has other places.
_WINDOWS, _PLACE_AT, _TWICE_AT = 31, 5, 11


def with_cuts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Adds ``cuts``: the runs of each text, one after another (they lie side by side from its first byte)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                raw, offsets = text_arrays(part.column("text"))
                start, stop, place, twice = cut_to_runs(raw, offsets, part.column("doc_id").fill_null(NO_DOC).to_numpy(), GRAM, length)
                packed = (stop - start - 1 | (place - stop + 1) << _PLACE_AT | twice.astype(np.int64) << _TWICE_AT).astype("<u2")
                edges = 2 * np.searchsorted(start, offsets)
                cuts = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(edges.astype("<i8").tobytes()), pa.py_buffer(packed.tobytes())])
                yield tidied(pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), cuts], names=["doc_id", "text", "cuts"]))

    return docs.mapInArrow(run, "doc_id long, text string, cuts binary")


def sides(sums: np.ndarray, start: np.ndarray, stop: np.ndarray, place: np.ndarray, twice: np.ndarray, length: int) -> np.ndarray:
    """For each run and each part of a window's possible places, a 16-bit hash (2 or more) of the bytes around the minimiser
    that all windows of the part hold; 0 where the run has too few, 1 in all where the minimiser has several places."""
    spare = length - GRAM  # bytes of a window left and right of its minimiser
    lows = [spare * i // 4 for i in range(5)]
    out = np.zeros((len(start), 4), np.uint16)
    for k in range(4):
        # windows that begin lows[k] to lows[k + 1] - 1 (or all) bytes before the minimiser
        left, right = place - lows[k], place + GRAM + spare - (lows[k + 1] - 1 if k < 3 else spare)
        fits = (left >= start) & (right <= stop + length - 1)
        out[fits, k] = (range_hashes(sums, left[fits], right[fits]) >> np.uint64(48)).astype(np.uint16) | np.uint16(2)
    out[twice] = 1
    return out


class Runs:
    """Runs of the documents of a shard (rows with ``cuts``); byte positions count from the shard's first.

    ``key`` is the minimiser (mixed: minima alone lie at the low end, and buckets are ranges), ``kind`` the hash of the content."""

    def __init__(self, table: pa.Table, length: int = LENGTH, with_sides: bool = False):
        self.table, self.length = table, length
        self.raw, self.offsets = text_arrays(table.column("text"))
        self.docs = table.column("doc_id").fill_null(NO_DOC).to_numpy()
        cuts, ends = text_arrays(table.column("cuts"))
        packed = np.ascontiguousarray(cuts).view("<u2").astype(np.int64)
        row = np.repeat(np.arange(len(self.docs)), np.diff(ends) // 2)
        size = (packed & _WINDOWS) + 1
        until = np.cumsum(size)
        before = np.concatenate([[0], until])[ends[:-1] // 2]  # windows of the rows before
        stop = self.offsets[row] + until - before[row]
        place = stop - 1 + (packed >> _PLACE_AT & 63)
        start, twice = stop - size, (packed >> _TWICE_AT).astype(bool)
        self.start, self.stop, self.doc = start, stop, self.docs[row]
        self.key, self.kind, self.sides = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64), np.zeros((len(start), 4), np.uint16)
        first = 0
        for part in slices(table, most=1 << 20):
            base, end = self.offsets[first], self.offsets[first + part.num_rows]
            first += part.num_rows
            i, j = np.searchsorted(start, [base, end])
            sums = prefix_sums(_byte_table(0)[self.raw[base:end]])
            a, b, p = start[i:j] - base, stop[i:j] - base, place[i:j] - base
            self.key[i:j] = mix(gram_hashes(sums, p, GRAM))
            self.kind[i:j] = range_hashes(sums, a, b + length - 1)
            if with_sides:
                self.sides[i:j] = sides(sums, a, b, p, twice[i:j], length)

    def kinds(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the chosen runs the first occurrence (by document) of each kind, in order of kind, and whether several documents have it."""
        at = np.flatnonzero(chosen)
        order = at[np.lexsort((self.doc[at], self.kind[at]))]
        kind = self.kind[order]
        first = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(kind) else np.zeros(0, np.int64)
        last = np.concatenate([first[1:], [len(kind)]]) - 1 if len(kind) else first
        return order[first], self.doc[order[first]] < self.doc[order[last]]

    def replace(self, which: np.ndarray) -> None:
        """Puts every window of the runs at ``which`` (boolean) behind the others, as a run by itself with its own hash as key."""
        plain = [x[~which] for x in (self.start, self.stop, self.key, self.kind, self.doc, self.sides)]
        n = self.stop[which] - self.start[which]
        start = np.repeat(self.start[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        kind, row = np.zeros(len(start), np.uint64), 0
        for part in slices(self.table, most=1 << 20):
            base, end = self.offsets[row], self.offsets[row + part.num_rows]
            row += part.num_rows
            i, j = np.searchsorted(start, [base, end])
            kind[i:j] = range_hashes(prefix_sums(_byte_table(0)[self.raw[base:end]]), start[i:j] - base, start[i:j] - base + self.length)
        again = (start, start + 1, mix(kind), kind, np.repeat(self.doc[which], n), np.zeros((len(start), 4), np.uint16))
        self.start, self.stop, self.key, self.kind, self.doc, self.sides = (np.concatenate(c) for c in zip(plain, again, strict=True))


def _has(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in ``sorted_keys``, -1 where it isn't there."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


# ---------------------------------------------------------------- the three questions

_KIND = np.dtype([("key", "<u8"), ("kind", "<u8"), ("doc", "<i8"), ("sides", "<u2", 4), ("several", "?")])
#: Answers to the second question: the first document of a kind, or that its bytes (or those of its windows) are asked for.
_FOUND = np.dtype([("kind", "<u8"), ("doc", "<i8"), ("state", "u1")])
DONE, BYTES, AGAIN = 0, 1, 2
_MASK = np.dtype([("kind", "<u8"), ("doc", "<i8"), ("mask", "<u4")])


def _short(keys: np.ndarray) -> np.ndarray:
    """The high 48 bits: equal minimisers stay equal, and a rare wrong match only asks on."""
    return keys >> np.uint64(16) << np.uint64(16)


def _pack(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(payload[:4], "little")
    wide = np.zeros((n, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(payload, np.uint8, 6 * n, 4).reshape(-1, 6)
    return wide.view("<u8").reshape(-1), np.unpackbits(np.frombuffer(payload, np.uint8, offset=4 + 6 * n))[:n].astype(bool)


def _shard_keys(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers of a shard (sorted, 48 bits) and whether several documents have each."""
    key = _short(runs.key)
    order = np.argsort(key, kind="stable")
    ordered, docs = key[order], runs.doc[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    if not len(first):
        return ordered, np.zeros(0, bool)
    return ordered[first], np.minimum.reduceat(docs, first) < np.maximum.reduceat(docs, first)


def _partners(key: np.ndarray, sides_: np.ndarray) -> np.ndarray:
    """Which kinds of run may share a window with another kind of the same minimiser (keys numbered, ascending)."""
    out = np.zeros(len(key), bool)
    some = np.flatnonzero((np.bincount(key) > 1)[key])  # most minimisers have one kind of run
    key, sides_ = key[some], sides_[some]
    found = (np.bincount(key, weights=(sides_[:, 0] == 1)) > 0)[key]  # the minimiser's place is not clear
    for k in range(sides_.shape[1]):
        code = key.astype(np.uint64) << np.uint64(16) | sides_[:, k].astype(np.uint64)
        _, which, counts = np.unique(code, return_inverse=True, return_counts=True)
        found |= (counts[which] > 1) & (sides_[:, k] > 1)
    out[some] = found
    return out


def _by_bucket(keys: np.ndarray, rows: np.ndarray, buckets: int) -> Iterable[tuple[int, bytes]]:
    """Rows, sorted by key, as one parcel for each bucket."""
    order = np.argsort(keys, kind="stable")
    edges = bucket_edges(keys[order], buckets)
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), rows[order[edges[b] : edges[b + 1]]].tobytes()


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``kept`` (the remaining bytes)."""
    if not GRAM <= length <= min(254 - RUN, GRAM + 63):
        raise ValueError(f"length {length} is not between {GRAM} and {min(254 - RUN, GRAM + 63)}")
    rows = id_and_text(docs)
    shards = shard_count(text_bytes(rows))
    buckets = shards
    placed = sharded(with_cuts(rows, length), shards)  # texts are cut once, before the exchange that all steps read

    # 1. which minimisers do several documents have?
    def ask_keys(shard: int, table: pa.Table) -> Iterable[tuple[int, bytes]]:
        keys, several = _shard_keys(Runs(table, length))
        edges = bucket_edges(keys, buckets)
        for b in np.flatnonzero(np.diff(edges)):
            part = slice(edges[b], edges[b + 1])
            yield int(b), (edges[b + 1] - edges[b]).astype("<u4").tobytes() + _pack(keys[part]) + np.packbits(several[part]).tobytes()

    def tell_keys(bucket: int, shards_: list[int], payloads: list[bytes]) -> Iterable[tuple[int, bytes]]:
        parts = [_unpack(p) for p in payloads]
        every, several = (np.concatenate(c) for c in zip(*parts, strict=True))
        unique, which, counts = np.unique(every, return_inverse=True, return_counts=True)
        shared = counts > 1
        shared[which[several]] = True
        at = 0
        for shard, (keys, _) in zip(shards_, parts, strict=True):
            yield shard, np.packbits(shared[which[at : at + len(keys)]]).tobytes()
            at += len(keys)

    shared_keys = answer(send(placed, ask_keys), tell_keys)

    # 2. which kinds of run do they have, and in which document first?
    def ask_kinds(shard: int, table: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        runs = Runs(table, length, with_sides=True)
        keys, _ = _shard_keys(runs)
        edges = bucket_edges(keys, buckets)
        shared = np.zeros(len(keys), bool)
        for b, payload in replies.items():
            shared[edges[b] : edges[b + 1]] = np.unpackbits(np.frombuffer(payload, np.uint8))[: edges[b + 1] - edges[b]]
        at, several = runs.kinds(shared[np.searchsorted(keys, _short(runs.key))] if len(keys) else np.zeros(0, bool))
        out = np.zeros(len(at), _KIND)
        out["key"], out["kind"], out["doc"], out["several"] = runs.key[at], runs.kind[at], runs.doc[at], several
        out["sides"] = runs.sides[at]
        return _parcels(shard, _by_bucket(out["key"], out, buckets))

    def tell_kinds(bucket: int, shards_: list[int], payloads: list[bytes]) -> Iterable[tuple[int, bytes]]:
        parts = [np.frombuffer(p, _KIND) for p in payloads]
        every = np.concatenate(parts)
        order = np.lexsort((every["doc"], every["kind"], every["key"]))
        key, kind, doc = (every[c][order] for c in ("key", "kind", "doc"))
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new_kind = new_key | np.concatenate([[True], kind[1:] != kind[:-1]])
        key_no, kind_no = np.cumsum(new_key) - 1, np.cumsum(new_kind) - 1
        first_doc = doc[new_kind]
        partnered = _partners(key_no[new_kind], every["sides"][order][new_kind])
        many = np.bincount(key_no[new_kind], weights=partnered) > HOT_KINDS
        state = np.where(partnered, np.where(many[key_no[new_kind]], AGAIN, BYTES), DONE).astype(np.uint8)
        out = np.zeros(len(every), _FOUND)
        out["kind"] = every["kind"]
        out["doc"][order], out["state"][order] = first_doc[kind_no], state[kind_no]
        # a minimiser of one document alone can't lose anything, nor can a kind that is nowhere else
        least, most = np.minimum.reduceat(doc, np.flatnonzero(new_key)), np.maximum.reduceat(doc, np.flatnonzero(new_key))
        several_key = np.bincount(key_no, weights=every["several"][order]) > 0
        alone = np.zeros(len(every), bool)
        alone[order] = ((least == most) & ~several_key)[key_no]
        said = np.where(out["state"] == DONE, every["several"] | (out["doc"] < every["doc"]), ~alone)
        at = 0
        for shard, part in zip(shards_, parts, strict=True):
            own = out[at : at + len(part)][said[at : at + len(part)]]
            at += len(part)
            if len(own):
                yield shard, b"k" + own.tobytes()

    kinds = answer(meet(placed, shared_keys, ask_kinds, "shard long, bucket long, payload binary"), tell_kinds)

    # 3. bytes of the kinds whose windows may be elsewhere
    def prepare(table: pa.Table, found: np.ndarray) -> tuple[Runs, np.ndarray, np.ndarray]:
        """Runs (those of hot minimisers window by window), the place of each in ``found`` (sorted by kind), and whether its bytes are asked for."""
        runs = Runs(table, length)
        at = _has(found["kind"], runs.kind)
        again = (at >= 0) & (found["state"][at] == AGAIN) if len(found) else np.zeros(len(at), bool)
        if again.any():
            plain = len(at) - again.sum()
            runs.replace(again)
            at = np.concatenate([at[~again], np.full(len(runs.kind) - plain, -1)])
            asked = np.concatenate([(at[:plain] >= 0) & (found["state"][at[:plain]] == BYTES), np.ones(len(at) - plain, bool)])
        else:
            asked = (at >= 0) & (found["state"][at] == BYTES) if len(found) else again
        return runs, at, asked

    def ask_bytes(shard: int, table: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        found = _read(replies.values(), b"k", _FOUND)
        runs, _, asked = prepare(table, found)
        at, several = runs.kinds(asked)
        by_key = np.argsort(runs.key[at], kind="stable")
        at, several = at[by_key], several[by_key]
        edges = bucket_edges(runs.key[at], buckets)
        rows = []
        for b in np.flatnonzero(np.diff(edges)):
            own = at[edges[b] : edges[b + 1]]
            head = np.zeros(len(own), _CONTENT)
            head["kind"], head["doc"], head["size"] = runs.kind[own], runs.doc[own], runs.stop[own] + length - 1 - runs.start[own]
            head["several"] = several[edges[b] : edges[b + 1]]
            text = runs.raw[np.repeat(runs.start[own] - (np.cumsum(head["size"].astype(np.int64)) - head["size"]), head["size"]) + np.arange(head["size"].sum(dtype=np.int64))]
            rows.append((int(b), len(own).to_bytes(4, "little") + head.tobytes() + text.tobytes()))
        return _parcels(shard, rows)

    def tell_windows(bucket: int, shards_: list[int], payloads: list[bytes]) -> Iterable[tuple[int, bytes]]:
        counts = [int.from_bytes(p[:4], "little") for p in payloads]
        heads = [np.frombuffer(p, _CONTENT, n, 4) for p, n in zip(payloads, counts, strict=True)]
        every = np.concatenate(heads)
        text = np.concatenate([np.frombuffer(p, np.uint8, offset=4 + n * _CONTENT.itemsize) for p, n in zip(payloads, counts, strict=True)])
        begin = np.cumsum(every["size"].astype(np.int64)) - every["size"]
        order = np.lexsort((every["doc"], every["kind"]))
        new = np.concatenate([[True], every["kind"][order][1:] != every["kind"][order][:-1]])
        one = order[new]  # each kind once, with its first document
        number = np.empty(len(every), np.int64)
        number[order] = np.cumsum(new) - 1
        size = every["size"][one].astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(size)])
        data = text[np.repeat(begin[one] - offsets[:-1], size) + np.arange(offsets[-1])]
        first = first_seen(data, offsets, every["doc"][one], length)
        lost = first < every["doc"][one][:, None]
        masks = (lost.astype(np.uint64) << np.arange(lost.shape[1], dtype=np.uint64)).sum(1).astype(np.uint32)
        at = 0
        for shard, head in zip(shards_, heads, strict=True):
            own = number[at : at + len(head)]
            at += len(head)
            out = np.zeros(len(head), _MASK)
            out["kind"], out["doc"], out["mask"] = head["kind"], every["doc"][one][own], masks[own]
            out = out[(out["mask"] > 0) | head["several"] | (out["doc"] < head["doc"])]
            if len(out):
                yield shard, b"w" + out.tobytes()

    windows = answer(meet(placed, kinds, ask_bytes, "shard long, bucket long, payload binary"), tell_windows)

    # the bytes that go
    def cut(shard: int, table: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        found = _read(replies.values(), b"k", _FOUND)
        masks = _read(replies.values(), b"w", _MASK)
        runs, at, asked = prepare(table, found)
        raw, offsets = runs.raw, runs.offsets
        edge = np.zeros(len(raw) + length + 1, np.int64)
        done = (at >= 0) & ~asked
        whole = done.copy()
        if len(found):
            whole[done] = (found["state"][at[done]] == DONE) & (runs.doc[done] > found["doc"][at[done]])
        in_masks = np.where(asked, _has(masks["kind"], runs.kind), -1)
        part = np.zeros(len(whole), bool)
        if len(masks):
            known = in_masks >= 0
            whole[known] = runs.doc[known] > masks["doc"][in_masks[known]]
            part = known & ~whole
            part[part] = runs.doc[part] == masks["doc"][in_masks[part]]
        np.add.at(edge, runs.start[whole], 1)
        np.add.at(edge, runs.stop[whole] + length - 1, -1)
        for bit in range(RUN):
            some = np.flatnonzero(part)
            some = some[(masks["mask"][in_masks[some]] >> np.uint32(bit) & np.uint32(1)).astype(bool)] if len(some) else some
            np.add.at(edge, runs.start[some] + bit, 1)
            np.add.at(edge, runs.start[some] + bit + length, -1)
        gone = np.cumsum(edge)[: len(raw)] > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = offsets[:-1][(offsets[:-1] < len(raw)) & (np.diff(offsets) > 0)]
        opens[inner] = gone[inner]  # a span ends with its document
        removed = np.concatenate([[0], np.cumsum(gone)])
        spans = np.concatenate([[0], np.cumsum(opens)])
        left = raw[~gone]
        kept_to = offsets - removed[offsets]
        kept = [left[a:b].tobytes() for a, b in zip(kept_to[:-1], kept_to[1:], strict=True)]
        return pa.table(
            {
                "doc_id": runs.table.column("doc_id"),
                "n_bytes": np.diff(offsets),
                "n_removed": np.diff(removed[offsets]),
                "n_spans": np.diff(spans[offsets]),
                "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
                "kept": pa.array(kept, pa.binary()),
            }
        )

    both = kinds.unionByName(windows.selectExpr("shard", f"bucket + {buckets} AS bucket", "payload"))
    return meet(placed, both, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


_CONTENT = np.dtype([("kind", "<u8"), ("doc", "<i8"), ("size", "u1"), ("several", "?")])


def _parcels(shard: int, rows: Iterable[tuple[int, bytes]]) -> pa.Table:
    return parcels((shard, b, payload) for b, payload in rows)


def _read(payloads: Iterable[bytes], tag: bytes, kind: np.dtype) -> np.ndarray:
    """Answers with this tag, sorted by kind."""
    parts = [np.frombuffer(p, kind, offset=1) for p in payloads if p[:1] == tag]
    out = np.concatenate(parts) if parts else np.zeros(0, kind)
    return out[np.argsort(out["kind"], kind="stable")]


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")
