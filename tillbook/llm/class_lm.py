"""Brown class-based n-gram language model: exchange clustering, then perplexity.

Method: P(w_i | w_{i-1}) = P(class_i | class_{i-1}) * P(w_i | class_i).

1. Words of all training texts are counted by an exchange between shards of
   documents and buckets of words (counts of every word, no cut-off); each
   shard gets the counts of its own words back.
2. The classes that step 4 starts from: words are gathered to units, the ``TOP_WORDS``
   most frequent ones each to its own, all others by their ending
   (``ENDING_UNITS`` hash values of the last three bytes).  Bigrams of units are
   counted over all training texts.
3. The exchange algorithm moves one unit after another to the class where the
   class bigram likelihood is highest, until a sweep moves none (``MOST_SWEEPS``
   at most).  It works on the matrix of step 2, whose size the two parameters fix.
4. Every word of the training texts, however rare, leaves its unit and goes to the class that
   fits its own neighbours: shards of documents count how often each of their words has each class
   before and after it, buckets of words sum the counts and move each word to the class where the
   likelihood is highest, all other words staying where they are, and tell the shards.
   This goes on for ``ROUNDS`` rounds, or until no word moves; a round after which the
   likelihood over all training texts is lower is taken back and ends it.
5. Each text is scored: class transitions are interpolated with class
   frequencies, emissions use absolute discounting; a class keeps the
   discounted mass for one unseen word.  Words of no training text have no
   neighbours to go by and take the class of their ending's unit.

Words are known by a 64-bit hash (a chance of about 1e-2 for one wrong pair
among 1e9 distinct words).  Text is held as UTF-8 bytes, A-Z lower-cased, parted at
0x20 and 0x09-0x0D; each text ends with one end token, which is also what the
first word follows.

Defined cases: a null or empty text is the end token alone; a null doc_id
counts as the empty string for the fold; repeated rows are counted and scored
each; an empty table gives no rows; without training texts every word is unseen.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import (
    PARCEL,
    Words,
    answer,
    bucket_edges,
    crc_mod,
    id_and_text,
    meet,
    parcels,
    prefix_sums,
    range_hashes,
    read_table,
    send,
    shard_count,
    sharded,
    slices,
    text_bytes,
)
from tillbook.session import pin, remove, run_folder

TOP_WORDS = 512
ENDING_UNITS = 511
CLASSES = 48
#: Unit and class of the end token.
END = 0
#: Weight of the class frequencies in a transition.
PRIOR = 5.0
MOST_SWEEPS = 20
#: Rounds in which all words may change their class.
ROUNDS = 2
UNITS = 1 + TOP_WORDS + ENDING_UNITS


# ---------------------------------------------------------------- words of a shard


def endings(words: Words, which: np.ndarray) -> np.ndarray:
    """Unit of the words' last three bytes."""
    ends = words.ends[which]
    starts = np.maximum(words.starts[which], ends - 3)
    raw = words.raw
    at = starts[:, None] + np.arange(3)
    codes = np.where(at < ends[:, None], raw[np.minimum(at, max(len(raw) - 1, 0))] if len(raw) else 0, 0).astype(np.uint64)
    codes = np.where((codes >= 65) & (codes < 91), codes + np.uint64(32), codes)
    key = codes[:, 0] | codes[:, 1] << np.uint64(8) | codes[:, 2] << np.uint64(16)
    return (range_hashes(prefix_sums(key), np.arange(len(key)), np.arange(1, len(key) + 1)) % np.uint64(ENDING_UNITS)).astype(np.int64) + 1 + TOP_WORDS


@dataclass
class Top:
    """The most frequent words, sorted by hash; ``unit`` of each."""

    hashes: np.ndarray

    def units(self, hashes: np.ndarray, ending: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return ending
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at + 1, ending)


# ---------------------------------------------------------------- step 1: counts of words

_WORD = np.dtype([("hash", "<u8"), ("count", "<i8"), ("ending", "<u2")])


def count_words(rows: DataFrame, buckets: int) -> DataFrame:
    """Replies (shard, bucket, counts) and, at shard -1, each bucket's statistics."""

    def emit(shard: int, table: pa.Table) -> Iterable[tuple[int, bytes]]:
        words = Words(table.column("text"))
        unique, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        train = table.column("train").to_numpy(zero_copy_only=False).astype(bool)[words.doc]
        out = np.zeros(len(unique), _WORD)
        out["hash"], out["count"], out["ending"] = unique, np.bincount(which[train], minlength=len(unique)), endings(words, first)
        edges = bucket_edges(unique, buckets)
        for b in np.flatnonzero(np.diff(edges)):
            yield int(b), out[edges[b] : edges[b + 1]].tobytes()

    def reduce(bucket: int, shards: list[int], payloads: list[bytes]) -> Iterable[tuple[int, bytes]]:
        parts = [np.frombuffer(p, _WORD) for p in payloads]
        every = np.concatenate(parts)
        unique, first, which = np.unique(every["hash"], return_index=True, return_inverse=True)
        count = np.bincount(which, weights=every["count"], minlength=len(unique)).astype(np.int64)
        at = 0
        for shard, part in zip(shards, parts, strict=True):
            own = count[which[at : at + len(part)]]
            at += len(part)
            yield shard, own.astype("<u4" if own.max(initial=0) < 1 << 32 else "<u8").tobytes()
        seen = np.zeros(len(unique), _WORD)
        seen["hash"], seen["count"], seen["ending"] = unique, count, every["ending"][first]
        seen = seen[count > 0]
        per_unit = np.bincount(seen["ending"], minlength=UNITS)
        best = seen[np.lexsort((seen["hash"], -seen["count"]))[:TOP_WORDS]]
        head = struct.pack("<4q", seen["count"].sum(), len(seen), (seen["count"] == 1).sum(), (seen["count"] == 2).sum())
        yield -1, head + per_unit.astype("<i8").tobytes() + best.tobytes()

    return answer(send(rows, emit), reduce)


def statistics(replies: DataFrame) -> tuple[dict[int, int], np.ndarray]:
    """Sums over the buckets (-4..-1: tokens, words, words seen once and twice; else: words of that ending) and the top words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                head = np.frombuffer(payload, "<i8", 4 + UNITS)
                best = np.frombuffer(payload, _WORD, offset=8 * (4 + UNITS))
                keys = np.concatenate([np.arange(-4, UNITS), best["ending"]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(len(keys)) >= 4 + UNITS),
                        pa.array(keys.astype(np.int64)),
                        pa.array(np.concatenate([np.zeros(4 + UNITS, np.int64), best["hash"].view(np.int64)])),
                        pa.array(np.concatenate([head, best["count"]])),
                    ],
                    names=["word", "key", "hash", "n"],
                )

    rows = replies.where("shard = -1").select("payload").mapInArrow(run, "word boolean, key long, hash long, n long")
    sums = {r.key: r.n for r in rows.where("not word").groupBy("key").agg(F.sum("n").alias("n")).collect()}  # 4 + UNITS rows
    best = rows.where("word").orderBy(F.desc("n"), "hash").limit(TOP_WORDS).collect()
    top = np.zeros(len(best), _WORD)
    for i, r in enumerate(best):
        top[i] = (r.hash & (1 << 64) - 1, r.n, r.key)
    return sums, top


# ---------------------------------------------------------------- step 2: bigrams of units


def _with_ends(words: Words, units: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """Units with the end token before and after each text, and the row of each."""
    rows = len(words.offsets) - 1
    at = np.arange(len(units)) + words.doc + 1
    out = np.full(len(units) + rows + 1, end, units.dtype)
    out[at] = units
    row = np.repeat(np.arange(rows + 1), np.concatenate([np.diff(words.first) + 1, [1]]))
    return out, row


#: Cells of the unit matrix that one bucket of the sum holds.
CELLS = 1 << 16


def count_units(rows: DataFrame, top: Top) -> np.ndarray:
    """Bigram counts of units over the training texts (UNITS x UNITS)."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(UNITS * UNITS, np.int64)
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                units, _ = _with_ends(words, top.units(words.hashes, endings(words, np.arange(len(words.hashes)))))
                cells += np.bincount(units[:-1] * UNITS + units[1:], minlength=UNITS * UNITS)
        for b in range(0, UNITS * UNITS, CELLS):
            used = np.flatnonzero(cells[b : b + CELLS])
            if len(used):
                payload = used.astype("<u2").tobytes() + cells[b + used].astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([b // CELLS]), pa.array([payload], pa.binary())], names=["bucket", "payload"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:  # one after another: memory does not grow with the tasks that sent
            for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = len(payload) // 10
                own = sums.setdefault(bucket, np.zeros(CELLS, np.int64))
                own[np.frombuffer(payload, "<u2", n)] += np.frombuffer(payload, "<i8", n, 2 * n)
        for bucket, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([own.tobytes()], pa.binary())], names=["bucket", "payload"])

    kind = "bucket long, payload binary"
    sent = rows.where("train").select("text").mapInArrow(tally, kind)
    out = np.zeros(-(-UNITS * UNITS // CELLS) * CELLS, np.int64)
    for r in sent.repartition(-(-UNITS * UNITS // CELLS), "bucket").mapInArrow(add, kind).collect():  # the fixed matrix
        out[r.bucket * CELLS : (r.bucket + 1) * CELLS] = np.frombuffer(r.payload, "<i8")
    return out[: UNITS * UNITS].reshape(UNITS, UNITS)


# ---------------------------------------------------------------- step 3: exchange clustering


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = MOST_SWEEPS) -> np.ndarray:
    """Class of each unit.  Unit ``END`` keeps class ``END`` to itself; the others
    start dealt round by frequency and move, one at a time, to their best class.

    The likelihood is sum f(N(c,d)) - sum f(N(c,.)) - sum f(N(.,d)), f(x) = x ln x."""
    pairs = pairs.astype(np.float64)
    weight = pairs.sum(0) + pairs.sum(1)
    order = [u for u in np.argsort(-weight, kind="stable") if u != END and weight[u] > 0]
    at = np.zeros(len(pairs), np.int64)
    at[[u for u in range(len(pairs)) if u != END]] = classes - 1
    for i, u in enumerate(order):
        at[u] = 1 + i % (classes - 1)
    member = np.zeros((len(pairs), classes))
    member[np.arange(len(pairs)), at] = 1
    table = member.T @ pairs @ member
    for _ in range(sweeps):
        moved = 0
        for u in order:
            own = pairs[u, u]
            right = pairs[u] @ member - own * member[u]  # u followed by each class, without u itself
            left = pairs[:, u] @ member - own * member[u]
            a = at[u]
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= own
            rows, columns = table.sum(1), table.sum(0)
            base = _f(table)
            by_row = _f(table + right[None, :]) - base
            by_column = _f(table + left[:, None]) - base
            both = _f(np.diag(table) + right + left + own) - np.diag(base)
            gain = by_row.sum(1) - np.diag(by_row) + by_column.sum(0) - np.diag(by_column) + both
            gain -= _f(rows + right.sum() + own) - _f(rows) + _f(columns + left.sum() + own) - _f(columns)
            # right.sum() and left.sum() also touch the other rows and columns, alike for every class
            gain[END] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += right
            table[:, b] += left
            table[b, b] += own
            if b != a:
                member[u, a], member[u, b], at[u] = 0, 1, b
                moved += 1
        if not moved:
            break
    return at


# ---------------------------------------------------------------- step 4: classes of all words

#: What a word has beside it: each class after it, each class before it, itself.
SIDES = 2 * CLASSES + 1
#: Counts of (word, side) that are weighed at a time.
ENTRIES = 1 << 13
#: Likelihood that a move gains at least.
GAIN = 1e-4


def better(table: np.ndarray, classes: np.ndarray, word: np.ndarray, side: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The class where each word's likelihood is highest, all others staying in theirs (not ``END``).

    ``table``: bigrams of classes; ``word`` (ascending, each has an entry), ``side`` and
    ``count``: how often a word has a class before or after it, or itself.
    A word that moves to class b takes its counts along in row b and column b; cell (b, b) has both."""
    table = table.astype(np.float64)
    rows, columns = table.sum(1), table.sum(0)
    first = np.searchsorted(word, np.arange(len(classes) + 1))
    out = classes.copy()
    at = 0
    while at < len(classes):
        to = max(at + 1, int(np.searchsorted(first, first[at] + ENTRIES, side="right")) - 1)
        own = slice(first[at], first[to])
        w, s, n = word[own] - at, side[own], count[own].astype(np.float64)
        each, a = np.arange(to - at), classes[at:to]
        beside = np.zeros((to - at, SIDES))
        beside[w, s] = n
        right, left, itself = beside[:, :CLASSES], beside[:, CLASSES:-1], beside[:, -1]
        # cells of the table without the word, for each entry and each class it may move to
        after, before = s < CLASSES, s < 2 * CLASSES
        d = s % CLASSES
        cells = np.where(after[:, None], table.T[d], table[d])
        among = np.flatnonzero(before & (d == a[w]))
        cells[among] -= np.where(after[among, None], left[w[among]], right[w[among]])
        cells[np.arange(len(w)), a[w]] -= n
        moved = _f(cells + n[:, None]) - _f(cells)
        moved[np.arange(len(w)), d] = 0  # cell (b, b), below
        moved[~before] = 0
        gain = np.add.reduceat(moved, first[at:to] - first[at], axis=0)
        both = right + left + itself[:, None]
        corner = np.repeat(np.diag(table)[None, :], to - at, axis=0)
        corner[each, a] -= both[each, a]
        gain += _f(corner + both) - _f(corner)
        for sums, more in ((rows, right.sum(1) + itself), (columns, left.sum(1) + itself)):
            others = np.repeat(sums[None, :], to - at, axis=0)
            others[each, a] -= more
            gain -= _f(others + more[:, None]) - _f(others)
        gain[:, END] = -np.inf
        best = gain.argmax(1)
        out[at:to] = np.where(gain[each, best] > gain[each, a] + GAIN, best, a)
        at = to
    return out


def _sums(keys: np.ndarray, values: np.ndarray) -> bytes:
    return np.stack([keys, values], 1).astype("<i8").tobytes()


def totals(sent: DataFrame) -> dict[int, int]:
    """Sums by key over payloads of ``_sums``, whose keys are fixed in number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                pairs = np.frombuffer(payload, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["key", "n"])

    rows = sent.select("payload").mapInArrow(run, "key long, n long")
    return {r.key: r.n for r in rows.groupBy("key").agg(F.sum("n").alias("n")).collect()}


@dataclass
class Classes:
    """Classes of the units, and of the words as the buckets told the shards (``told``; none: all as their units)."""

    top: Top
    units: np.ndarray
    told: DataFrame | None = None

    def of(self, words: Words, unique: np.ndarray, first: np.ndarray, by_bucket: dict[int, bytes], buckets: int) -> np.ndarray:
        """Class of each distinct word of a shard; one that the buckets have in no training text follows its unit."""
        out = self.units[self.top.units(unique, endings(words, first))]
        edges = bucket_edges(unique, buckets)
        for b, payload in by_bucket.items():
            told = np.frombuffer(payload, np.uint8)
            out[edges[b] : edges[b + 1]] = np.where(told != END, told, out[edges[b] : edges[b + 1]])
        return out


def count_beside(placed: DataFrame, buckets: int, classes: Classes, further: bool) -> DataFrame:
    """Parcels for the buckets (if ``further``): each shard's words, their classes and what is beside them in training
    texts; and, at bucket -1, the shard's bigrams of classes."""
    plain = Classes(classes.top, classes.units)

    def emit(table: pa.Table, by_bucket: dict[int, bytes]) -> Iterable[tuple[int, bytes]]:
        words = Words(table.column("text"))
        unique, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        kinds = np.append(plain.of(words, unique, first, by_bucket, buckets), END)
        end = len(unique)
        run, row = _with_ends(words, which, end)
        train = np.append(table.column("train").to_numpy(zero_copy_only=False).astype(bool), False)[row[:-1]]
        x, y = run[:-1][train], run[1:][train]
        cells = np.bincount(kinds[x] * CLASSES + kinds[y], minlength=CLASSES * CLASSES)
        used = np.flatnonzero(cells)
        if len(used):
            yield -1, _sums(used, cells[used])
        if not further:
            return
        twin = (x == y) & (x != end)
        right, left = (x != end) & ~twin, (y != end) & ~twin
        key = np.concatenate([x[right] * SIDES + kinds[y[right]], y[left] * SIDES + CLASSES + kinds[x[left]], x[twin] * SIDES + SIDES - 1])
        key, count = np.unique(key, return_counts=True)
        begin = np.searchsorted(key, np.arange(end + 1) * SIDES)
        edges = bucket_edges(unique, buckets)
        for b in np.flatnonzero(np.diff(edges)):
            own = slice(edges[b], edges[b + 1])
            n = count[begin[edges[b]] : begin[edges[b + 1]]]
            wide = n[n >= 255]
            head = np.array([edges[b + 1] - edges[b], len(n), len(wide)], "<i8")
            yield int(b), b"".join(
                part.tobytes()
                for part in (
                    head,
                    unique[own],
                    wide.astype("<i8"),
                    kinds[:-1][own].astype(np.uint8),
                    np.diff(begin)[own].astype(np.uint8),
                    (key[begin[edges[b]] : begin[edges[b + 1]]] % SIDES).astype(np.uint8),
                    np.minimum(n, 255).astype(np.uint8),
                )
            )

    if classes.told is None:
        return send(placed, lambda shard, table: emit(table, {}))

    def run(shard: int, table: pa.Table, by_bucket: dict[int, bytes]) -> pa.Table:
        return parcels((shard, bucket, payload) for bucket, payload in emit(table, by_bucket))

    return meet(placed, classes.told, run, PARCEL)


def _beside(payload: bytes) -> tuple[np.ndarray, ...]:
    """Hashes and classes of a parcel's words, number of sides of each, sides and their counts."""
    words, entries, wide = np.frombuffer(payload, "<i8", 3).tolist()
    at, parts = 24, []
    for kind, size in (("<u8", words), ("<i8", wide), ("u1", words), ("u1", words), ("u1", entries), ("u1", entries)):
        parts.append(np.frombuffer(payload, kind, size, at))
        at += parts[-1].nbytes
    hashes, large, kinds, number, sides, small = parts
    count = small.astype(np.int64)
    count[small == 255] = large
    return hashes, kinds, number, sides, count


#: Keys of a bucket's sums: words that moved, words of each class (0 and on), class of each top word.
_MOVED, _TOP_CLASS = -1, CLASSES


def move_words(top: Top, table: np.ndarray) -> Callable[[int, list[int], list[bytes]], Iterable[tuple[int, bytes]]]:
    """Replies of a bucket: the new class of each of a shard's words (``END``: in no training text), and sums at shard -1."""

    def reduce(bucket: int, shards: list[int], payloads: list[bytes]) -> Iterable[tuple[int, bytes]]:
        parts = [_beside(p) for p in payloads]
        hashes, kinds, number, sides, count = (np.concatenate(c) for c in zip(*parts, strict=True))
        unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        key, at = np.unique(np.repeat(which, number) * SIDES + sides, return_inverse=True)
        count = np.bincount(at, weights=count, minlength=len(key)).astype(np.int64)
        seen, word = np.unique(key // SIDES, return_inverse=True)
        before = kinds[first][seen].astype(np.int64)
        after = better(table, before, word, key % SIDES, count)
        new = np.full(len(unique), END, np.uint8)
        new[seen] = after
        at = 0
        for shard, part in zip(shards, parts, strict=True):
            yield shard, new[which[at : at + len(part[0])]].tobytes()
            at += len(part[0])
        per_class = np.bincount(after, minlength=CLASSES)
        places = np.searchsorted(top.hashes, unique[seen])
        is_top = np.append(top.hashes, 0)[places] == unique[seen] if len(top.hashes) else np.zeros(len(seen), bool)
        is_top &= places < len(top.hashes)
        yield -1, _sums(np.concatenate([[_MOVED], np.arange(CLASSES), _TOP_CLASS + places[is_top]]), np.concatenate([[(after != before).sum()], per_class, after[is_top]]))

    return reduce


def likelihood(table: np.ndarray) -> float:
    table = table.astype(np.float64)
    return float(_f(table).sum() - _f(table.sum(1)).sum() - _f(table.sum(0)).sum())


def regroup(placed: DataFrame, buckets: int, classes: Classes, kinds: np.ndarray) -> tuple[Classes, np.ndarray, np.ndarray]:
    """Classes of all words after ``ROUNDS`` rounds at most, the bigrams of these classes and how many distinct words each has (``kinds``: before)."""
    spark, best = placed.sparkSession, None
    for turn in range(ROUNDS + 1):
        folder = run_folder(spark, "lm-beside")
        count_beside(placed, buckets, classes, turn < ROUNDS).write.parquet(folder)
        sent = spark.read.parquet(folder)
        cells = totals(sent.where("bucket = -1"))
        table = np.zeros(CLASSES * CLASSES, np.int64)
        table[list(cells)] = list(cells.values())
        table = table.reshape(CLASSES, CLASSES)
        lower = best is not None and likelihood(table) < likelihood(best[1])
        if not lower:
            best = classes, table, kinds
        if lower or turn == ROUNDS:
            remove(spark, folder)
            break
        told = pin(answer(sent.where("bucket >= 0"), move_words(classes.top, table)), "lm-classes")
        remove(spark, folder)
        sums = totals(told.where("shard = -1"))
        if not sums.get(_MOVED):
            break
        kinds = np.array([sums.get(c, 0) for c in range(CLASSES)], np.int64)
        classes = Classes(classes.top, classes.units, told.where("shard >= 0"))
        tops = {key - _TOP_CLASS: n for key, n in sums.items() if key >= _TOP_CLASS}
        classes.units = classes.units.copy()
        classes.units[[1 + place for place in tops]] = list(tops.values())
    return best


# ---------------------------------------------------------------- step 5: the model


@dataclass
class Model:
    top: Top
    classes: np.ndarray  # of each unit (a top word by itself)
    transition: np.ndarray  # log10 P(class | class before)
    size: np.ndarray  # training tokens of each class
    unseen: np.ndarray  # log10 P(unseen word | class)
    discount: float
    tokens: int
    words: int
    ends: int

    def emission(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            known = np.log10(np.maximum(counts - self.discount, 1e-300) / np.maximum(self.size[classes], 1))
        return np.where(counts > 0, known, self.unseen[classes])


def kinds_of(sums: dict[int, int], top: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Distinct words of each class, all words being in the class of their unit."""
    distinct = np.array([sums.get(u, 0) for u in range(UNITS)], np.int64)
    np.subtract.at(distinct, top["ending"].astype(np.int64), 1)  # the top words are units by themselves
    distinct[1 : 1 + len(top)] = 1
    return np.bincount(units, weights=distinct, minlength=CLASSES).astype(np.int64)


def build(sums: dict[int, int], classes: Classes, table: np.ndarray, kinds: np.ndarray, ends: int) -> Model:
    tokens, words, once, twice = (sums.get(k, 0) for k in (-4, -3, -2, -1))
    size = table.sum(0).astype(np.float64)
    prior = (size + 1) / (size.sum() + CLASSES)
    transition = np.log10((table + PRIOR * prior[None, :]) / (table.sum(1, keepdims=True) + PRIOR))
    discount = once / (once + 2 * twice) if once and twice else 0.5
    with np.errstate(divide="ignore"):
        unseen = np.where(size > 0, np.log10(np.maximum(discount * kinds, 1e-3) / np.maximum(size, 1)), 0.0)
    return Model(classes.top, classes.units, transition, size, unseen, discount, tokens + ends, words + (ends > 0), ends)


_SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(docs: DataFrame, held_out) -> DataFrame:
    """Trains on the rows of ``docs`` where ``held_out`` (a boolean column) is false and scores all rows."""
    rows = id_and_text(docs).withColumn("train", ~held_out)
    shards = shard_count(text_bytes(rows))
    placed = sharded(rows, shards)
    replies = pin(count_words(placed, shards), "lm-counts")
    sums, top = statistics(replies)
    ends = rows.where("train").count()
    known = Top(np.sort(top["hash"]))
    units = exchange(count_units(rows, known))
    classes, table, kinds = regroup(placed, shards, Classes(known, units), kinds_of(sums, top, units))
    model = build(sums, classes, table, kinds, ends)
    plain = Classes(classes.top, classes.units)

    def finish(shard: int, table: pa.Table, by_bucket: dict[int, bytes]) -> pa.Table:
        words = Words(table.column("text"))
        n = table.num_rows
        unique, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        edges = bucket_edges(unique, shards)
        counts = np.zeros(len(unique), np.int64)
        for b, payload in by_bucket.items():
            if b >= shards:
                continue
            size = edges[b + 1] - edges[b]
            counts[edges[b] : edges[b + 1]] = np.frombuffer(payload, "<u4" if len(payload) == 4 * size else "<u8")
        kinds = plain.of(words, unique, first, {b - shards: payload for b, payload in by_bucket.items() if b >= shards}, shards)
        per_word = model.emission(kinds, counts)
        base_word = np.log10((counts + 1) / (model.tokens + model.words + 1))
        run, row = _with_ends(words, kinds[which])
        step = np.bincount(row[:-1], weights=model.transition[run[:-1], run[1:]], minlength=n) if n else np.zeros(0)
        own = np.bincount(words.doc, weights=per_word[which], minlength=n)
        base = np.bincount(words.doc, weights=base_word[which], minlength=n) + np.log10((model.ends + 1) / (model.tokens + model.words + 1))
        tokens = np.diff(words.first) + 1
        total = step + own
        columns = {
            "doc_id": table.column("doc_id"),
            "held_out": ~table.column("train").to_numpy(zero_copy_only=False).astype(bool),
            "n_tokens": tokens,
            "n_known": np.bincount(words.doc, weights=(counts > 0)[which], minlength=n).astype(np.int64) + int(model.ends > 0),
            "train_tokens": np.full(n, model.tokens),
            "base_score": base,
            "score": total,
            "perplexity": 10 ** np.minimum(-total / tokens, 300),
        }
        return pa.table(columns)

    told = replies.where("shard >= 0")
    if classes.told is not None:
        told = told.unionByName(classes.told.withColumn("bucket", F.col("bucket") + shards))  # beside the counts
    return meet(placed, told, finish, _SCORE)


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)
