"""Conversation prefix trie, built as a burst trie.

A node is a distinct sequence of first turns (role, text) of some
conversations; a training run that keeps the nodes' states reads each node once.

Method:

1. A turn's id is the MD5 of its role and text (16 bytes, the unit in which
   sequences are compared).  Turns are sorted by (conversation, number) over range
   partitions, so that one huge conversation is many partitions' work, and
   packed to blocks of ids.
2. A conversation is cut every ``CUT`` turns.  Each cut sequence is a suffix in a
   container under a trie head: the hash of all turns before the cut (whole
   conversations of up to ``CUT`` turns lie under the root).  Equal suffixes
   under one head are one row with a count.
3. Containers of more than ``CONTAINER`` turns burst: the turns that all its suffixes begin
   with (the common prefix of the least and the largest one) become trie nodes, and each
   suffix moves to the container of its next turn id.  Rounds go on until no
   container is oversized; each at least parts a container in two.
4. The remaining containers, dealt to shards by head, are sorted by Spark
   and swept: the common prefix of neighbours opens and closes nodes on a stack.
5. What subtrees add up to goes from containers to burst heads, last round first, and
   from later cuts of long conversations to their heads by sums along each
   conversation (``_below``).

``rebuilt`` gives the conversations of the query: the first h turns of another
conversation, then the own ones from there.

Defined cases: a null role or text counts as empty; a null turn number comes
first; turns with equal numbers come in the order of their ids' hashes, repeated
rows one after another; rows without a conversation id belong to no conversation and are left
out; a conversation may have any number of turns and a turn any length; other
columns are not read; an empty table has no conversation and so no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.llm.common import read_table
from tillbook.session import pin

#: Bytes of a turn's id and of its number of words.
ID, COUNT = 16, 4
#: Turns after which a conversation is cut: the most that a row holds.
CUT = 256
#: Turns beyond which a container bursts: what a sweep holds at a time.
CONTAINER = 1 << 14
#: Bytes of joined conversation ids that a row holds.
JOINED = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, words long, up1 long, up2 long"
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- conversations to blocks


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, id, words`` of every row with a conversation id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(named.cast("binary"))).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"),
    )


def blocks(rows: DataFrame, cut: int = CUT) -> DataFrame:
    """``conv_id, first, n, ids, words``: up to ``cut`` turns that follow each other, ``first`` the place of the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            convs = batch.column(0).to_numpy()
            if not len(convs):
                continue
            ids, words = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(">i4")
            out = []
            starts = np.concatenate([[0], np.flatnonzero(convs[1:] != convs[:-1]) + 1, [len(convs)]])
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                conv = int(convs[a])
                seen = seen if conv == last else 0
                last = conv
                for i in range(a, b, cut):
                    j = min(i + cut, b)
                    out.append((conv, part, seen, j - i, b"".join(ids[i:j]), words[i:j].tobytes()))
                    seen += j - i
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["conv_id", "part", "first", "n", "ids", "words"])

    ordered = rows.repartitionByRange("conv_id", "turn", "id").sortWithinPartitions("conv_id", "turn", "id")
    packed = pin(ordered.select("conv_id", "id", "words").mapInArrow(run, "conv_id long, part long, first long, n long, ids binary, words binary"), "turn-blocks")
    # a conversation that goes on from one partition to the next: only each partition's first one does
    per = packed.groupBy("conv_id", "part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    moved = per.select("conv_id", "part", before.alias("before")).where("before > 0")
    return packed.join(F.broadcast(moved), ["conv_id", "part"], "left").selectExpr("conv_id", "first + coalesce(before, 0) AS first", "n", "ids", "words")  # one row a partition at most


def _piece(column: str, unit: int, skip: str, size: str) -> str:
    return f"substring({column}, cast(({skip}) * {unit} + 1 AS int), cast(({size}) * {unit} AS int))"


def rebuilt(packed: DataFrame) -> DataFrame:
    """``conv_id, at, n, ids, words``: pieces of every conversation c rebuilt from the first h turns of
    conversation c - c % 20 and its own turns after its first h, h = crc32(c) % 4; ``at`` is a piece's place.
    Every conversation has a piece at 0, even an empty one."""
    sizes = packed.groupBy("conv_id").agg(F.sum("n").alias("turns"))
    sizes = sizes.selectExpr("conv_id", "turns", "crc32(cast(cast(conv_id AS string) AS binary)) % 4 AS h", "conv_id - conv_id % 20 AS base")
    # the first three turns of the conversations that others begin with
    opening = packed.where("conv_id % 20 = 0 AND first < 3").groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("first", F.substring("ids", 1, 3 * ID).alias("ids"), F.substring("words", 1, 3 * COUNT).alias("words")))).alias("parts"))  # 3 rows at most
    opening = opening.selectExpr(
        "base",
        "substring(aggregate(parts, cast('' AS binary), (a, p) -> concat(a, p.ids)), 1, 48) AS ids",
        "substring(aggregate(parts, cast('' AS binary), (a, p) -> concat(a, p.words)), 1, 12) AS words",
    )
    convs = sizes.join(opening, "base", "left").selectExpr(
        "conv_id", "h", f"substring(coalesce(ids, cast('' AS binary)), 1, cast(h * {ID} AS int)) AS ids", f"substring(coalesce(words, cast('' AS binary)), 1, cast(h * {COUNT} AS int)) AS words"
    )
    convs = pin(convs.selectExpr("conv_id", "h", f"cast(octet_length(ids) div {ID} AS long) AS n", "ids", "words"), "openings")
    own = packed.join(convs.selectExpr("conv_id", "h", "n AS taken"), "conv_id").selectExpr("*", "greatest(0, least(n, h - first)) AS skip").where("n > skip")
    own = own.selectExpr("conv_id", "taken + first + skip - h AS at", "n - skip AS n", _piece("ids", ID, "skip", "n - skip") + " AS ids", _piece("words", COUNT, "skip", "n - skip") + " AS words")
    return convs.selectExpr("conv_id", "0L AS at", "n", "ids", "words").unionByName(own)


def whole(packed: DataFrame) -> DataFrame:
    """The conversations as they are, as pieces."""
    return packed.selectExpr("conv_id", "first AS at", "n", "ids", "words")


# ---------------------------------------------------------------- suffixes under heads


def segments(pieces: DataFrame, cut: int = CUT) -> DataFrame:
    """``conv_id, s, ids, words, last, h1, h2, a1, a2``: each conversation's turns from s * cut on, the head before them and the one behind.

    A head is the exclusive or of two hashes of each segment and its place: it adds up in any order."""
    cuts = pieces.selectExpr("*", f"explode(sequence(at div {cut}, greatest(at, at + n - 1) div {cut})) AS s")
    cuts = cuts.selectExpr("*", f"greatest(at, s * {cut}) AS low", f"least(at + n, (s + 1) * {cut}) AS high")
    cuts = cuts.selectExpr("conv_id", "s", f"struct(low, {_piece('ids', ID, 'low - at', 'high - low')} AS ids, {_piece('words', COUNT, 'low - at', 'high - low')} AS words) AS part")
    rows = cuts.groupBy("conv_id", "s").agg(F.sort_array(F.collect_list("part")).alias("parts"))  # cut turns at most
    rows = rows.selectExpr("conv_id", "s", "aggregate(parts, cast('' AS binary), (a, p) -> concat(a, p.ids)) AS ids", "aggregate(parts, cast('' AS binary), (a, p) -> concat(a, p.words)) AS words")
    rows = pin(rows.where("s = 0 OR ids <> cast('' AS binary)").selectExpr("*", "xxhash64(1, s, ids) AS x1", "xxhash64(2, s, ids) AS x2"), "segments")
    place = Window.partitionBy("conv_id").orderBy("s")
    before, until = place.rowsBetween(Window.unboundedPreceding, -1), place.rowsBetween(Window.unboundedPreceding, 0)
    chain = rows.select(
        "conv_id", "s",
        *(F.coalesce(F.bit_xor(x).over(before), F.lit(0).cast("long")).alias(h) for x, h in (("x1", "h1"), ("x2", "h2"))),
        *(F.bit_xor(x).over(until).alias(a) for x, a in (("x1", "a1"), ("x2", "a2"))),
        F.lead("s").over(place).isNull().alias("last"),
    )  # a few numbers for every `cut` turns
    return pin(rows.drop("x1", "x2").join(chain, ["conv_id", "s"]), "suffixes")


def ended(rows: DataFrame, joined: int = JOINED) -> DataFrame:
    """``a1, a2, sha``: SHA-256 of the ascending ids of the conversations that end at a node.

    Ids are joined in range partitions first, so that a node where very many
    end is many tasks' work; the hash itself, which goes from left to right, reads joined ids only."""
    key = ["a1", "a2", "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a1, a2, convs = (batch.column(i).to_numpy() for i in range(3))
            starts = np.concatenate([[0], np.flatnonzero((a1[1:] != a1[:-1]) | (a2[1:] != a2[:-1])) + 1, [len(a1)]]) if len(a1) else [0]
            out = [(int(a1[i]), int(a2[i]), int(convs[i]), ",".join(map(str, convs[i : min(i + joined // 20, b)].tolist()))) for a, b in zip(starts[:-1], starts[1:], strict=True) for i in range(a, b, joined // 20)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=[*key, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            done = []
            for a1, a2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (a1, a2) == now:
                    sha.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, sha.hexdigest()))
                now, sha = (a1, a2), hashlib.sha256(ids.encode())
            yield shas(done)
        if now is not None:
            yield shas([(*now, sha.hexdigest())])

    def shas(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["a1", "a2", "sha"])

    ends = rows.where("last").select(*key).repartitionByRange(*key).sortWithinPartitions(*key)
    parts = ends.mapInArrow(join, "a1 long, a2 long, conv_id long, ids string")
    return parts.repartition("a1", "a2").sortWithinPartitions(*key).mapInArrow(digest, "a1 long, a2 long, sha string")


def suffixes(cut_rows: DataFrame, cut: int = CUT) -> DataFrame:
    """Distinct suffixes under each head, as rows of the containers that heads begin with.

    ``k1, k2``: the container; ``depth`` of its top node and that turn's ``top_words``; ``up1, up2``: the container
    it came from; ``up_conv``: smallest member of the node above; ``owned``: whether the top is a node of this
    container; ``n`` conversations, ``conv`` the smallest, ``sha`` of those that end behind the suffix, ``goes_on``: others do."""
    rows = cut_rows.groupBy("h1", "h2", "s", "ids", "words", "a1", "a2").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"), F.sum(F.col("last").cast("long")).alias("n_ends"))
    rows = rows.join(ended(cut_rows), ["a1", "a2"], "left")
    # the node that a later head continues: its members include those that end there
    tops = rows.where("n > n_ends").selectExpr("a1 AS h1", "a2 AS h2", "conv AS up_conv")
    return pin(
        rows.join(tops, ["h1", "h2"], "left").selectExpr(
            "h1 AS k1", "h2 AS k2", "s", f"s * {cut} AS depth", "0L AS top_words", "cast(null AS long) AS up1", "cast(null AS long) AS up2", "up_conv",
            "s = 0 AS owned", "ids", "words", "n", "conv", "sha", "n > n_ends AS goes_on", "a1", "a2",
        ),
        "trie-suffixes",
    )


def burst(rows: DataFrame, container: int = CONTAINER) -> tuple[list[DataFrame], list[DataFrame]]:
    """Containers that are small enough, and the heads that burst, by round."""
    small, heads = [], []
    key = ["k1", "k2"]
    while True:
        stats = rows.groupBy(*key).agg(F.count("*").alias("rows"), F.sum(F.octet_length("ids").cast("long")).alias("bytes"), F.min("ids").alias("low"), F.max("ids").alias("high"), F.sum("n").alias("total"), F.min("conv").alias("least"), *(F.first(c).alias(c) for c in ("s", "depth", "top_words", "up1", "up2", "up_conv", "owned")))
        shared = f"if(octet_length(low) = 0, 0, size(filter(sequence(1, greatest(1, octet_length(low) div {ID})), i -> substring(low, 1, i * {ID}) = substring(high, 1, i * {ID}))))"
        big = pin(stats.where((F.col("bytes") > container * ID) & (F.col("rows") > 1)).selectExpr("*", f"cast({shared} AS long) AS shared").selectExpr("*", "if(shared = 0 AND NOT owned, up_conv, least) AS branch").drop("low", "high", "rows", "bytes"), "burst-heads")
        if big.isEmpty():
            return [*small, rows], heads
        marked = pin(rows.join(big.select(*key, "shared", "branch"), key, "left"), "burst-rows")
        small.append(marked.where("shared IS NULL").drop("shared", "branch"))
        settled = marked.where(f"octet_length(ids) = shared * {ID}")  # one suffix a head at most: they are distinct
        moved = marked.where(f"octet_length(ids) > shared * {ID}")
        # the words of the turns that all suffixes begin with
        common = marked.where("shared IS NOT NULL").groupBy(*key).agg(F.min(F.substring("words", F.lit(1), (F.col("shared") * COUNT).cast("int"))).alias("chain"))
        heads.append(big.join(common, key).join(settled.select(*key, "sha", "goes_on", "a1", "a2"), key, "left"))
        step = f"substring(ids, 1, cast((shared + 1) * {ID} AS int))"
        rows = pin(
            moved.selectExpr(
                f"xxhash64(k1, k2, 1, {step}) AS k1", f"xxhash64(k2, k1, 2, {step}) AS k2", "s", "depth + shared + 1 AS depth",
                f"cast(conv(hex(substring(words, cast(shared * {COUNT} + 1 AS int), {COUNT})), 16, 10) AS long) AS top_words",
                "k1 AS up1", "k2 AS up2", "branch AS up_conv", "true AS owned",
                f"substring(ids, cast((shared + 1) * {ID} + 1 AS int)) AS ids", f"substring(words, cast((shared + 1) * {COUNT} + 1 AS int)) AS words",
                "n", "conv", "sha", "goes_on", "a1", "a2",
            ),
            "burst-rows",
        )


# ---------------------------------------------------------------- containers to nodes


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 7 + [pa.string()] + [pa.int64()] * 3
    names = [f.split()[0] for f in NODE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


class _Open:
    """A node on the sweep's stack."""

    __slots__ = ("words", "n", "conv", "children", "leaves", "saved", "sha", "kids")

    def __init__(self, words: int):
        self.words, self.n, self.conv, self.children, self.leaves, self.saved, self.sha, self.kids = words, 0, None, 0, 0, 0, None, []


def sweep(depth: int, top_words: int, owned: bool, up: tuple, up_conv: int | None, rows: list[tuple]) -> list[list]:
    """Nodes of one container from its sorted suffixes: (ids, words, n, conv, sha, below), ``below`` being
    (children, leaves, saved) of what goes on behind a suffix, or None."""
    out: list[list] = []
    stack = [_Open(top_words)]

    def close() -> None:
        node = stack.pop()
        for i in node.kids:
            out[i][2] = node.conv if stack or owned else up_conv
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.words
        if not stack:
            if owned:
                out.append([node.conv, depth, up_conv, node.n, node.children, leaves, saved, node.sha or _EMPTY_SHA, node.words, *up])
            return
        above = stack[-1]
        above.kids.append(len(out))
        out.append([node.conv, depth + len(stack), None, node.n, node.children, leaves, saved, node.sha or _EMPTY_SHA, node.words, None, None])
        above.n += node.n
        above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
        above.children += 1
        above.leaves += leaves
        above.saved += saved

    before = b""
    for ids, words, n, conv, sha, below in rows:
        size, shared = len(ids) // ID, 0
        most = min(size, len(before) // ID)
        while shared < most and ids[shared * ID : shared * ID + ID] == before[shared * ID : shared * ID + ID]:
            shared += 1
        while len(stack) - 1 > shared:
            close()
        stack.extend(_Open(w) for w in np.frombuffer(words, ">i4")[len(stack) - 1 :].tolist())
        node = stack[-1]
        node.sha = sha
        node.n += n
        node.conv = conv if node.conv is None else min(node.conv, conv)
        if below is not None:
            node.children += below[0]
            node.leaves += below[1]
            node.saved += below[2]
        before = ids
    while stack:
        close()
    return out


_ROW = ["k1", "k2", "ids", "words", "n", "conv", "sha", "goes_on", "children", "leaves", "saved", "depth", "top_words", "owned", "up1", "up2", "up_conv"]


def swept(containers: DataFrame) -> DataFrame:
    """Nodes of all containers (with ``children, leaves, saved`` of what goes on behind a suffix), each swept in sorted order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, top = None, [], ()
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key:
                    if held:
                        out += sweep(*top, held)
                    key, held = row[:2], []
                    top = row[11], row[12], row[13], (row[14], row[15]), row[16]
                held.append((*row[2:7], row[8:11] if row[7] else None))
            yield _nodes(out)
        if held:
            yield _nodes(sweep(*top, held))

    return containers.select(*_ROW).repartition("k1", "k2").sortWithinPartitions("k1", "k2", "ids").mapInArrow(run, NODE)


def chains(heads: DataFrame) -> DataFrame:
    """Nodes of burst heads from the sums of their children (``kids, kid_leaves, kid_saved``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                words = [r["top_words"], *np.frombuffer(r["chain"], ">i4").tolist()]
                below = (r["children"], r["leaves"], r["saved"]) if r["goes_on"] else (0, 0, 0)
                children, leaves, saved = r["kids"] + below[0], r["kid_leaves"] + below[1], r["kid_saved"] + below[2]
                sha = r["sha"] or _EMPTY_SHA
                for i in range(len(words) - 1, -1, -1):
                    saved += (r["total"] - 1) * words[i]
                    if i or r["owned"]:
                        top = (r["up1"], r["up2"]) if i == 0 else (None, None)
                        above = r["up_conv"] if i == 0 or i == 1 and not r["owned"] else r["least"]
                        out.append((r["least"], r["depth"] + i, above, r["total"], children, leaves, saved, sha, words[i], *top))
                    children, sha = 1, _EMPTY_SHA
            yield _nodes(out)

    return heads.mapInArrow(run, NODE)


def grown(small: list[DataFrame], heads: list[DataFrame], below: DataFrame) -> DataFrame:
    """All nodes, from containers up through the burst heads, last round first.

    ``below`` (a1, a2, children, leaves, saved): what goes on behind a suffix, in later cuts."""
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    nodes = pin(swept(rows.join(below, ["a1", "a2"], "left")), "trie-nodes")
    tops = nodes.where("up1 IS NOT NULL")
    for level in reversed(heads):
        sums = tops.groupBy(F.col("up1").alias("k1"), F.col("up2").alias("k2")).agg(F.count("*").alias("kids"), F.sum("n_leaves").alias("kid_leaves"), F.sum("saved_tokens").alias("kid_saved"))
        made = pin(chains(level.join(sums, ["k1", "k2"]).join(below, ["a1", "a2"], "left")), "trie-heads")
        nodes, tops = nodes.unionByName(made), tops.unionByName(made.where("up1 IS NOT NULL"))
    return nodes


def _below(rows: DataFrame, cut_rows: DataFrame, small: list[DataFrame], heads: list[DataFrame], cut: int) -> DataFrame:
    """Sums of the subtrees under heads of later cuts, and how many turns follow each.

    Every node counts for its smallest member, so what lies below a head is the
    sum, over the conversations that pass it, of what counts for them from there on."""
    first = rows.where("s > 0").groupBy(F.col("k1").alias("a1"), F.col("k2").alias("a2")).agg(F.count_distinct(F.substring("ids", 1, ID)).alias("children"))
    unknown = first.selectExpr("a1", "a2", "children", "0L AS leaves", "0L AS saved")
    later = cut_rows.where("s > 0").select("conv_id", "s", "h1", "h2")
    if later.isEmpty():
        return unknown
    nodes = grown([r.where("s > 0") for r in small], [r.where("s > 0") for r in heads], unknown)
    own = nodes.groupBy("conv_id", F.expr(f"(depth - 1) div {cut}").alias("s")).agg(F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    on = Window.partitionBy("conv_id").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    from_here = later.join(own, ["conv_id", "s"], "left").select("h1", "h2", *(F.sum(F.coalesce(c, F.lit(0))).over(on).alias(c) for c in ("leaves", "saved")))
    sums = from_here.groupBy(F.col("h1").alias("a1"), F.col("h2").alias("a2")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return pin(first.join(sums, ["a1", "a2"]).select("a1", "a2", "children", "leaves", "saved"), "below-heads")


def trie(pieces: DataFrame, cut: int = CUT, container: int = CONTAINER) -> DataFrame:
    """Nodes of the conversations given as ``pieces`` (of at most ``cut`` turns each).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, ``words``."""
    cut_rows = segments(pieces, cut)
    rows = suffixes(cut_rows, cut)
    small, heads = burst(rows, container)
    return grown(small, heads, _below(rows, cut_rows, small, heads, cut)).drop("up1", "up2")


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(blocks(turns(read_table(spark, sf_dir, "conversations"))))).drop("words")
