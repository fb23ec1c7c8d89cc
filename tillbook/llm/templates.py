"""Benchmark decontamination by template canonicalisation.

Method: words of documents and benchmark items become template tokens - a
number, a name or a unit is replaced by its type - and windows of ``WINDOW``
tokens are joined by hash.  Every matching window is lined up with its item
word by word: literal words must be equal, and each slot of the item must take
the same value wherever it occurs, which tells a question asked with other
numbers or names from text that merely has the same shape.

Template tokens: a word is a maximal run of letters, digits and bytes of other
scripts; A-Z are lower-cased.

* number: a word that begins with a digit, or a number word;
* unit: one of ``UNITS``, right after a number;
* name: a word with an upper-case first letter (A-Z, or a two-byte Latin,
  Greek or Cyrillic capital) that doesn't open a sentence;
* anything else stands for itself.

Texts are read in three ways, and the verdicts of each are taken together:

* ``words``: as above;
* ``names``: what another number or name may write in more or fewer words is
  one token - digits parted by a comma or a point, number words and what
  precedes them, names in a row - and a word that opens a sentence is a name
  if the same text has it as a name elsewhere;
* ``openers``: the same, and every upper-case word that opens a sentence is a name.

Items of under ``LEAST`` tokens are compared as ``words`` only.

An item's windows are all its runs of ``WINDOW`` tokens, or the whole item if
it is shorter; an item under ``LEAST`` tokens only counts where it is a whole
document.  A document is contaminated by an item where

* it holds the whole item word for word, and the item has a literal token or is the whole document;
* ``RUN`` tokens in a row match word for word and at least half of them are literal; or
* aligned windows, either with consistent slots or word for word, cover ``SHARE`` of the
  item's windows and at least half of the covered tokens are literal; windows
  that lie up to ``WINDOW`` tokens further or nearer, where words were put in or
  left out, count along if their slots take the same values.

A single window that matches word for word (``exact``) is no contamination by
itself: a stock phrase or a row of numbers is as long.

The benchmark's windows are joined by broadcast up to ``BROADCAST_WINDOWS``;
beyond that, documents' windows are shuffled to them by hash.

Defined cases: null or empty documents and items match nothing; null ids are
carried; repeated rows give repeated rows; equal items each give a row; empty
tables give no rows; further columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import LOWER, _byte_table, mix, prefix_sums, range_hashes, read_table, slices, text_arrays

WINDOW = 8
LEAST = 5
SHARE = 0.5
RUN = 13
BROADCAST_WINDOWS = 2_000_000

# Number words and units of measurement.
NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNITS = (
    "mm cm dm m km inch inches foot feet ft yard yards mile miles mg g kg t gram grams kilogram kilograms ton tons tonnes oz ounce ounces lb lbs pound pounds "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "hz khz mhz w kw v a j n pa mph kmh percent degree degrees dollar dollars euro euros cent cents usd eur gbp"
).split()

NUMBER, NAME, UNIT = (np.uint64(x) for x in (0xA5A5A5A500000001, 0xA5A5A5A500000002, 0xA5A5A5A500000003))

_INSIDE = np.zeros(256, bool)  # bytes of words
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)  # bytes that end a sentence
_STOP[[ord(c) for c in ".!?:\n"]] = True


def word_hash(word: str) -> int:
    raw = LOWER[np.frombuffer(word.encode(), np.uint8)]
    return int(range_hashes(prefix_sums(_byte_table(0)[raw]), np.array([0]), np.array([len(raw)]))[0])


_NUMBERS = np.sort(np.array([word_hash(w) for w in NUMBER_WORDS], np.uint64))
_UNITS = np.sort(np.array([word_hash(w) for w in UNITS], np.uint64))


def _among(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


WAYS = ("words", "names", "openers")


class Templates:
    """Template tokens of a column of texts: ``literal`` (hash of the word itself), ``token`` (of its type or itself)."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        raw, offsets = text_arrays(column)
        self.raw, self.offsets = raw, offsets
        inside = _INSIDE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        finishes[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        starts, n = self.starts, len(self.starts)
        self.first = np.searchsorted(starts, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.literal = range_hashes(prefix_sums(_byte_table(0)[LOWER[raw]]), starts, self.ends)
        head = raw[starts]
        number = (head >= 48) & (head < 58)
        # word lists are short words: only those are looked up
        short = np.flatnonzero(self.ends - starts <= 10)
        number[short] |= _among(_NUMBERS, self.literal[short])
        unit = np.zeros(n, bool)
        unit[short] = _among(_UNITS, self.literal[short])
        same_doc = np.concatenate([[False], self.doc[1:] == self.doc[:-1]]) if n else np.zeros(0, bool)
        unit[1:] &= number[:-1]
        unit &= same_doc & ~number
        second = raw[np.minimum(starts + 1, max(len(raw) - 1, 0))] if n else head
        upper = (head >= 65) & (head < 91)
        upper |= (head == 0xC3) & (second >= 0x80) & (second < 0x9F) & (second != 0x97)
        upper |= ((head == 0xCE) & (second >= 0x91) & (second < 0xAA)) | ((head == 0xD0) & (second >= 0x80) & (second < 0xB0))
        stops = np.concatenate([[0], np.cumsum(_STOP[raw])])
        opens = ~same_doc
        opens[1:] |= stops[starts[1:]] > stops[self.ends[:-1]]
        name = upper & ~opens & ~number & ~unit
        self._kinds = number, unit, name, upper & opens & ~number & ~unit, same_doc
        self._tell(number, unit, name)

    def _tell(self, number: np.ndarray, unit: np.ndarray, name: np.ndarray) -> None:
        self.slot = number | unit | name
        self.token = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, self.literal)))
        self.literals = np.concatenate([[0], np.cumsum(~self.slot)])

    def read(self, way: str) -> Templates:
        """The same texts read in another of ``WAYS``."""
        if way == "words" or not len(self.starts):
            return self
        number, unit, name, opener, same_doc = self._kinds
        if way == "names":
            with np.errstate(over="ignore"):
                own = mix(self.literal + mix(self.doc.astype(np.uint64)))  # a word of one text
            name = name | (opener & np.isin(own, own[name]))
        else:
            name = name | opener
        # what goes on the token before it, by the one byte between them
        gap = self.raw[np.maximum(self.starts - 1, 0)]
        close = same_doc.copy()
        close[1:] &= self.starts[1:] - self.ends[:-1] == 1
        digit = (self.raw[self.starts] >= 48) & (self.raw[self.starts] < 58)
        last = self.raw[self.ends - 1]
        joined = np.zeros(len(close), bool)
        joined[1:] = digit[1:] & digit[:-1] & (last[:-1] >= 48) & (last[:-1] < 58) & ((gap[1:] == 44) | (gap[1:] == 46))
        joined[1:] |= number[1:] & ~digit[1:] & number[:-1] & ((gap[1:] == 32) | (gap[1:] == 45))
        joined[1:] |= name[1:] & name[:-1] & ((gap[1:] == 32) | (gap[1:] == 45) | (gap[1:] == 39))
        joined &= close
        begin = np.flatnonzero(~joined)
        end = np.append(begin[1:], len(joined))
        out = object.__new__(Templates)
        out.raw, out.offsets = self.raw, self.offsets
        out.starts, out.ends, out.doc = self.starts[begin], self.ends[end - 1], self.doc[begin]
        out.first = np.searchsorted(out.starts, out.offsets)
        out.literal = np.where(end - begin > 1, range_hashes(prefix_sums(self.literal), begin, end), self.literal[begin])
        out._tell(number[begin], unit[begin], name[begin])
        return out

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First token and hash of every window of ``size`` tokens that lies in one row."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return first, range_hashes(prefix_sums(self.token), first, first + size)


class Items:
    """Benchmark items and their windows, sorted by hash; ``words`` are the items' texts read in one way."""

    def __init__(self, ids: list[int | None], words: Templates, window: int = WINDOW):
        self.ids, self.window, self.words = ids, window, words
        size = np.diff(self.words.first)
        self.size = np.where(size >= window, window, size)  # of each item's windows
        self.count = np.where(size >= window, size - window + 1, (size > 0).astype(int))
        hashes, items, at, sizes = [], [], [], []
        for length in np.unique(self.size[self.size > 0]):
            first, found = self.words.windows(int(length))
            own = self.size[self.words.doc[first]] == length
            hashes.append(found[own])
            items.append(self.words.doc[first[own]])
            at.append(first[own])
            sizes.append(np.full(own.sum(), length))
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        order = np.argsort(join(hashes, np.uint64), kind="stable")
        self.hashes, self.item, self.at, self.sizes = (join(p, k)[order] for p, k in ((hashes, np.uint64), (items, np.int64), (at, np.int64), (sizes, np.int64)))

    def lengths(self) -> list[int]:
        return [int(x) for x in np.unique(self.sizes)]


_HIT = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("item_id", pa.int64()), ("n_windows", pa.int64()), ("item_windows", pa.int64()), ("share", pa.float64()), ("exact", pa.bool_()), ("consistent", pa.bool_()), ("contaminated", pa.bool_())])
HIT = "doc_id long, key long, item_id long, n_windows long, item_windows long, share double, exact boolean, consistent boolean, contaminated boolean"


def judge(docs: Templates, row: int, items: Items, item: int, pairs: list[tuple[int, int, int]]) -> tuple[int, bool, bool, bool] | None:
    """Lines up one document with one item.  ``pairs``: (document token, item token, size) of matching windows.

    Gives windows covered by the best alignment, whether a window matches word
    for word, whether the slots are consistent, and the verdict."""
    words = items.words
    length = int(items.size[item])
    total = int(docs.first[row + 1] - docs.first[row])
    if length < LEAST and total != length:
        return None
    by_shift: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for at, own, size in sorted(pairs):
        if (docs.token[at : at + size] == words.token[own : own + size]).all():  # a hash alone is no match
            by_shift[at - own].append((at, own, size))
    best = (0, False, False, False)
    shifts = sorted(by_shift)

    def slots(at: int, own: int, size: int) -> list[tuple[tuple[int, int], int]]:
        return [((int(words.token[own + k]), int(words.literal[own + k])), int(docs.literal[at + k])) for k in range(size) if words.slot[own + k]]

    for place, shift in enumerate(shifts):
        values: dict[tuple[int, int], int] = {}
        windows, exact, covered = set(), [], set()
        consistent = True
        for at, own, size in by_shift[shift]:
            windows.add(own)
            covered.update(range(own, own + size))
            if (docs.literal[at : at + size] == words.literal[own : own + size]).all():
                exact.append((own, own + size))
            for key, value in slots(at, own, size):
                consistent &= values.setdefault(key, value) == value
        # windows of the nearest other alignments, while they tell the same values
        near = shifts[bisect_left(shifts, shift - WINDOW) : place] + shifts[place + 1 : bisect_right(shifts, shift + WINDOW)]
        for other in sorted(near, key=lambda x: (abs(x - shift), x)) if consistent else ():
            for at, own, size in by_shift[other]:
                if own not in windows:
                    told = slots(at, own, size)
                    if all(values.get(key, value) == value for key, value in told) and len(dict(told)) == len(set(told)):
                        values.update(told)
                        windows.add(own)
                        covered.update(range(own, own + size))
        literal = sum(not words.slot[k] for k in covered)
        verdict = consistent and len(windows) >= SHARE * int(items.count[item]) and 2 * literal >= len(covered)
        verdict = verdict or _word_for_word(words, item, exact, SHARE * int(items.count[item]), total)
        best = max(best, (len(windows), bool(exact), consistent, bool(verdict)), key=lambda x: (x[3], x[0], x[1], x[2]))
    return best if best[0] else None


def _word_for_word(words: Templates, item: int, exact: list[tuple[int, int]], share: float, total: int) -> bool:
    """Verdict on the windows (ascending token ranges of the item) that match word for word in a document of ``total`` tokens."""
    runs: list[list[int]] = []
    for a, b in exact:
        if runs and a <= runs[-1][1]:
            runs[-1][1] = b
        else:
            runs.append([a, b])
    tokens = [b - a for a, b in runs]
    literal = [int(words.literals[b] - words.literals[a]) for a, b in runs]
    whole = int(words.first[item + 1] - words.first[item])
    if any(n == whole and (k or n == total) for n, k in zip(tokens, literal, strict=True)):
        return True
    if any(n >= RUN and 2 * k >= n for n, k in zip(tokens, literal, strict=True)):
        return True
    return bool(exact) and len(exact) >= share and 2 * sum(literal) >= sum(tokens)


_Found = list[tuple[Items, Templates, np.ndarray, np.ndarray, np.ndarray]]


def _hits(part, ways: _Found) -> pa.RecordBatch:
    """Rows for matching windows.  For each way of reading: items, documents, and of the windows document token, place in the items' windows, size."""
    ids = list(zip(part.column("doc_id").to_pylist(), part.column("key").to_pylist(), strict=True))
    said: dict[tuple[int, int], list[tuple[bool, float, int, int, bool, bool, int]]] = defaultdict(list)
    for way, (items, docs, first, match, sizes) in enumerate(ways):
        pairs: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
        for at, place, size in zip(first.tolist(), match.tolist(), sizes.tolist(), strict=True):
            pairs[int(docs.doc[at]), int(items.item[place])].append((at, int(items.at[place]), size))
        for (row, item), found in pairs.items():
            if way and items.size[item] < LEAST:  # as few tokens say nothing where names and numbers are joined
                continue
            if judged := judge(docs, row, items, item, found):
                n, total = judged[0], int(items.count[item])
                said[row, item].append((judged[3], n / total, -way, n, judged[1], judged[2], total))
    rows = []
    for (row, item), found in sorted(said.items()):
        verdict, share, _, n, _, consistent, total = max(found)
        rows.append((*ids[row], ways[0][0].ids[item], n, total, share, any(f[4] for f in found), consistent, verdict))
    columns = zip(*rows, strict=True) if rows else [[]] * len(_HIT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _HIT, strict=True)], schema=_HIT)


def _spread(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [left, right): number of the range and each place in it."""
    n = right - left
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + left[which]


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """A row for each document and benchmark item that share a template window, with the verdict ``contaminated``; ``key`` is a hash of the row's doc_id and text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text <> ''").withColumn("key", F.xxhash64("doc_id", "text"))
    given = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text <> ''")
    # a window takes two bytes of text at least, so this bounds what is collected and broadcast
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size // 2 <= broadcast_windows:
        found = given.orderBy("item_id", "text").collect()
        return _by_broadcast(rows, [r.item_id for r in found], [r.text for r in found], window)
    return _by_shuffle(rows, given, window)


def _matches(items: Items, docs: Templates, filters: dict[int, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of documents that items have too: document token, place in the items' windows, size."""
    found = [(np.zeros(0, np.int64),) * 3]
    for length in items.lengths():
        first, hashes = docs.windows(length)
        if filters:
            maybe = filters[length][hashes >> np.uint64(44)]
            first, hashes = first[maybe], hashes[maybe]
        left, right = (np.searchsorted(items.hashes, hashes, side) for side in ("left", "right"))
        which, place = _spread(left, right)
        same = items.sizes[place] == length
        found.append((first[which[same]], place[same], np.full(same.sum(), length)))
    first, place, sizes = (np.concatenate(c) for c in zip(*found, strict=True))
    return first, place, sizes


def _by_broadcast(rows: DataFrame, ids: list[int | None], texts: list[str], window: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast((ids, texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = sent.value
        words = Templates(pa.array(texts, pa.string()))
        every = [Items(ids, words.read(way), window) for way in WAYS]
        if not any(len(items.hashes) for items in every):
            return
        filters = []
        for items in every:  # a bit per hash prefix sends most windows away at once
            of_length = {}
            for length in items.lengths():
                bits = np.zeros(1 << 20, bool)
                bits[items.hashes[items.sizes == length] >> np.uint64(44)] = True
                of_length[length] = bits
            filters.append(of_length)
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                plain = Templates(part.column("text"))
                ways = []
                for way, items, of_length in zip(WAYS, every, filters, strict=True):
                    docs = plain.read(way)
                    ways.append((items, docs, *_matches(items, docs, of_length)))
                if any(len(way[2]) for way in ways):
                    yield _hits(part, ways)

    return rows.mapInArrow(run, HIT)


def _by_shuffle(rows: DataFrame, given: DataFrame, window: int) -> DataFrame:
    """Windows of items and of documents meet by hash; each matching document is then judged against the items it shares a window with."""

    def hashes_of(lengths: list[int] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, most=1 << 20):
                    plain, own = Templates(part.column("text")), []
                    for k, way in enumerate(WAYS):  # windows meet those that are read in the same way
                        words, salt = plain.read(way), np.uint64(k)
                        if lengths is None:
                            items = Items(part.column("id").to_pylist(), words, window)
                            own.append((items.item, items.hashes ^ salt, items.sizes))
                        else:
                            own += [(words.doc[f], h ^ salt, np.full(len(f), n)) for n in lengths for f, h in [words.windows(n)]]
                    which, found, sizes = (np.concatenate(c) for c in zip(*own, strict=True))
                    keyed = np.unique(np.rec.fromarrays([which, found.view(np.int64), sizes], names="row,hash,size"))
                    texts = part.column("name").take(pa.array(keyed["row"]))
                    yield pa.RecordBatch.from_arrays([texts, pa.array(keyed["hash"]), pa.array(keyed["size"])], names=["name", "hash", "size"])

        return run

    schema = "name binary, hash long, size long"
    # rows are known by their content, so that equal rows are judged once and rejoined
    doc_rows = rows.withColumn("name", F.unhex(F.sha2("text", 256)))
    item_rows = given.withColumn("name", F.unhex(F.sha2("text", 256))).withColumnRenamed("item_id", "id")
    every = [*range(1, window + 1)]
    items = item_rows.dropDuplicates(["name"]).mapInArrow(hashes_of(None), schema).withColumnRenamed("name", "item_name")
    windows = doc_rows.select("name", "text", F.col("doc_id").alias("id")).mapInArrow(hashes_of(every), schema)
    pairs = windows.join(items, ["hash", "size"]).select("name", "item_name").distinct()
    texts = item_rows.select(F.col("name").alias("item_name"), F.col("id").alias("item_id"), F.col("text").alias("item_text"))
    joined = pairs.join(texts, "item_name").join(doc_rows, "name").select("doc_id", "key", "text", "item_id", "item_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                words, plain = Templates(part.column("item_text")), Templates(part.column("text"))
                ways = []
                for way in WAYS:
                    items, docs = Items(part.column("item_id").to_pylist(), words.read(way), window), plain.read(way)
                    ways.append((items, docs, *_matches(items, docs)))
                if any(len(way[2]) for way in ways):
                    yield _hits(part, ways)

    return joined.mapInArrow(run, HIT)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without contaminated documents."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    doc_id, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    bad = find(docs.select("doc_id", "text"), benchmark).where("contaminated").select("key").distinct()
    keyed = plain.withColumn("key", F.xxhash64(doc_id.cast("long"), text.cast("string")))
    return keyed.join(bad, "key", "left_anti").drop("key").toDF(*names)


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the items that they hold."""
    return find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).where("contaminated").drop("key")
