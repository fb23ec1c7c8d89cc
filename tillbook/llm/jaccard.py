"""N-gram Jaccard join by chosen paths.

Method: a document is the set of its ``WORDS``-word shingles; two are linked
at a Jaccard similarity of ``SIMILAR`` or more.

1. Equal sets are one class; its set joins once.  Each set has ``SAMPLED``
   MinHash tokens.
2. Chosen paths: a node of the tree holds the sets that share all tokens on
   the path to it.  Each node draws tokens at random (by a hash of its path, ``BRANCH``
   expected) and splits by their values; nodes of ``SMALL`` sets or fewer are
   leaves.  A pair at the threshold goes down ``BRANCH * SIMILAR`` children
   together on average; the runs (roots) are repeated until the chance to meet
   in some leaf at full depth reaches ``RECALL``.
3. In a leaf all pairs are compared by their sampled tokens; those that agree
   on ``PASS`` or more put their sets in one component.  A leaf of more than
   ``LEAF_BLOCK`` sets (near copies that no level parts) is cut to blocks, and
   every pair of blocks is compared in a task of its own.
4. Components are verified: every pair of their sets is compared exactly,
   large components block by block in many tasks.  A pair lies in one
   component, so each link is counted once, and only counts and a spanning
   forest leave a task.

Defined cases: words are white-space separated, A-Z lower-cased; a text of 1
to WORDS - 1 words is one shingle; null or empty texts have the empty set and
are one class; null doc_ids come last, and a class of only such has a null
class_id; repeated rows count each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import Words, id_and_text, mix, read_table, shard_count, sharded, slices, text_bytes
from tillbook.llm.graph import components, merge
from tillbook.llm.lines import LAST
from tillbook.session import pin

WORDS = 5
SIMILAR = (4, 5)  # 0.8 as a fraction, so that the test is exact
SAMPLED = 48
#: Sampled tokens that agree, at least, before a pair is verified: at similarity 0.8 fewer agree with a chance of 1e-5.
PASS = 26
#: Sets that are compared pair by pair: about as much work as sending each to its children.
SMALL = 1024
#: Sets of one leaf that are compared in one task, or that meet as many others there.
LEAF_BLOCK = 4096
DEPTH = 4
BRANCH = 1.875
RECALL = 0.9999
#: Sets in a block of an exact comparison.
BLOCK = 1024


def runs_needed(similar: float = 0.8, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall`` even if no node above ``depth`` is a leaf."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - (1 - BRANCH / SAMPLED * similar * meet) ** SAMPLED
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


# ---------------------------------------------------------------- sets


def sets(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, and where each row's begin (rows + 1 entries)."""
    hashes, rows = Words(column).shingles(WORDS)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    return hashes, np.searchsorted(rows, np.arange(len(column) + 1))


def _seeds() -> np.ndarray:
    return mix(np.arange(1, SAMPLED + 1, dtype=np.uint64)) | np.uint64(1)


def sample(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash tokens (rows x SAMPLED, uint32) of non-empty sets; rows of empty sets are zero."""
    out = np.zeros((len(first) - 1, SAMPLED), np.uint32)
    filled = np.flatnonzero(np.diff(first) > 0)
    if len(filled):
        with np.errstate(over="ignore"):
            for k, seed in enumerate(_seeds()):
                out[filled, k] = np.minimum.reduceat((hashes * seed) >> np.uint64(32), first[:-1][filled]).astype(np.uint32)
    return out


def set_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each whole set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes))])
    return mix(mix(sums[first[1:]] - sums[first[:-1]]) + np.diff(first).astype(np.uint64))


_SET = "doc_id long, doc long, tie long, shard long, node long, size long, tokens binary"


def describe(placed: DataFrame) -> DataFrame:
    """Class key, size and sampled tokens of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=2 << 20):
                hashes, first = sets(part.column("text"))
                tokens = [t.tobytes() for t in sample(hashes, first)]
                ids = part.column("doc_id")
                columns = [ids, ids.fill_null(LAST), part.column("tie"), part.column("shard"), set_keys(hashes, first).view(np.int64), np.diff(first), tokens]
                kinds = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "doc", "tie", "shard", "node", "size", "tokens"])

    return placed.mapInArrow(run, _SET)


# ---------------------------------------------------------------- chosen paths


def children(paths: np.ndarray, tokens: np.ndarray, branch: float = BRANCH) -> tuple[np.ndarray, np.ndarray]:
    """Rows and child paths: at each node every sampled token is drawn with probability branch / SAMPLED."""
    drawn = mix(paths[:, None] + _seeds()[None, :])
    row, k = np.nonzero(drawn < np.uint64(int(branch / SAMPLED * 2**64)))
    with np.errstate(over="ignore"):
        return row, mix(drawn[row, k] * np.uint64(3) + tokens[row, k].astype(np.uint64))


def _token_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, SAMPLED)


def leaves(nodes: DataFrame, runs: int) -> DataFrame:
    """``path, node, n`` (its sets) of every leaf of two sets or more; ``nodes``: node, tokens (distinct, not empty)."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mix(np.arange(1, runs + 1, dtype=np.uint64) << np.uint64(20))
        for batch in batches:
            tokens, names = _token_rows(batch.column("tokens")), batch.column("node").to_numpy()
            for root in roots:
                row, path = children(np.full(len(names), root), tokens)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(names[row])], names=["path", "node"])

    def deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("node").to_numpy()
            row, path = children(batch.column("path").to_numpy().view(np.uint64), _token_rows(batch.column("tokens")))
            yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(names[row])], names=["path", "node"])

    kind = "path long, node long"
    found = None
    level = nodes.select("node", "tokens").mapInArrow(start, kind)
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        level = pin(level.join(sizes, "path"), f"paths-{depth}")
        done = level if depth == DEPTH else level.where(F.col("n") <= SMALL)
        done = done.select("path", "node", "n")
        found = done if found is None else found.unionByName(done)
        if depth == DEPTH:
            break
        large = level.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        level = large.join(nodes.select("node", "tokens"), "node").select("path", "node", "tokens").mapInArrow(deeper, kind)
    return found


def blocks(members: DataFrame) -> DataFrame:
    """``leaf, side, node, tokens``: what is compared in one task; ``members``: path, node, tokens, n.

    A leaf of up to ``LEAF_BLOCK`` sets is one; of a larger one, every block and every two blocks.
    Sides 0 and 1 are compared with each other, side 2 also within itself."""
    n = F.ceil(F.col("n") / LEAF_BLOCK)
    dealt = members.where(F.col("n") > LEAF_BLOCK).withColumn("own", F.pmod(F.xxhash64("node", "path"), n))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    side = "CASE WHEN own = other THEN 2 WHEN own < other THEN 0 ELSE 1 END AS side"
    dealt = dealt.selectExpr("xxhash64(path, least(own, other), greatest(own, other)) AS leaf", side, "node", "tokens")
    return members.where(F.col("n") <= LEAF_BLOCK).selectExpr("path AS leaf", "2 AS side", "node", "tokens").unionByName(dealt)


def compared(members: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of each leaf that agree on ``PASS`` sampled tokens, a spanning forest of each block or two; ``members``: path, node, tokens, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            paths = batch.column("leaf").to_numpy()
            cut = int(np.searchsorted(paths, paths[-1]))  # the last leaf may go on in the next batch
            if cut or (carried and carried[0].column("leaf")[0].as_py() != paths[0]):
                yield pairs([*carried, batch.slice(0, cut)])
                carried = []
            carried.append(batch.slice(cut))
        if carried:
            yield pairs(carried)

    def pairs(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        paths, names, side = (table.column(c).to_numpy() for c in ("leaf", "node", "side"))
        tokens = _token_rows(table.column("tokens"))
        labels = np.arange(len(paths))
        active, d = np.arange(len(paths)), 0
        while len(active):
            d += 1
            active = active[active + d < len(paths)]
            active = active[paths[active + d] == paths[active]]
            meet = active[(side[active] == 2) | (side[active] != side[active + d])]
            for at in range(0, len(meet), 1 << 16):
                some = meet[at : at + (1 << 16)]
                near = some[(tokens[some] == tokens[some + d]).sum(1) >= PASS]
                merge(labels, near, near + d)
        labels = labels[labels]
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.RecordBatch.from_arrays([pa.array(names[labels[linked]]), pa.array(names[linked])], names=["a", "b"])

    return blocks(members).repartition("leaf").sortWithinPartitions("leaf", "side", "node").mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- exact comparison


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    sides = [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in (left, right)]
    owners = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)]
    common = np.intersect1d(*sides)
    out = np.zeros((len(left), len(right)), np.float32)
    at = [np.searchsorted(common, s) for s in sides]
    keep = [(a < len(common)) & (common[np.minimum(a, max(len(common) - 1, 0))] == s) if len(common) else np.zeros(len(s), bool) for a, s in zip(at, sides, strict=True)]
    places = [a[k] for a, k in zip(at, keep, strict=True)]
    who = [o[k] for o, k in zip(owners, keep, strict=True)]
    step = 4096
    for begin in range(0, len(common), step):  # tokens by the thousand, so that the matrices stay small
        matrices = []
        for side, place, own in zip((left, right), places, who, strict=True):
            m = np.zeros((len(side), min(step, len(common) - begin)), np.float32)
            inside = (place >= begin) & (place < begin + step)
            m[own[inside], place[inside] - begin] = 1
            matrices.append(m)
        out += matrices[0] @ matrices[1].T
    return out.astype(np.int64)


_FOUND = "kind string, a long, b long, n_sets long, n_docs long"


def verified(rows: DataFrame) -> DataFrame:
    """Exact comparison of each block of a component; ``rows``: root, i, j, side, node, docs, members (set as binary).

    Gives 'count' rows (node a: linked sets and documents) and 'link' rows (a, b), a spanning forest of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j", "side", "node", "docs", "members")), strict=True))
        for (_, i, j), group in groupby(stream, key=lambda r: r[:3]):
            own = list(group)
            left = [r for r in own if r[3] == 0]
            right = [r for r in own if r[3] == 1] if i != j else left
            a, b = ([np.frombuffer(r[6], np.uint64) for r in side] for side in (left, right))
            shared = shared_counts(a, b)
            union = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :] - shared
            linked = SIMILAR[1] * shared >= SIMILAR[0] * union
            if i == j:
                np.fill_diagonal(linked, False)
            names = np.array([r[4] for r in left] + ([r[4] for r in right] if i != j else []), np.int64)
            docs = [np.array([r[5] for r in side], np.int64) for side in (left, right)]
            counts = [(names[: len(left)], linked.sum(1), linked @ docs[1])]
            labels = np.arange(len(names))
            x, y = np.nonzero(linked)
            merge(labels, x, y + (len(left) if i != j else 0))
            if i != j:
                counts.append((names[len(left) :], linked.sum(0), linked.T @ docs[0]))
            labels = labels[labels]
            forest = np.flatnonzero(labels != np.arange(len(labels)))
            node, n_sets, n_docs = (np.concatenate(c) for c in zip(*counts, strict=True))
            some = n_sets > 0
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": pa.array(["count"] * int(some.sum()) + ["link"] * len(forest), pa.string()),
                    "a": np.concatenate([node[some], names[labels[forest]]]),
                    "b": np.concatenate([node[some], names[forest]]),
                    "n_sets": np.concatenate([n_sets[some], np.zeros(len(forest), np.int64)]),
                    "n_docs": np.concatenate([n_docs[some], np.zeros(len(forest), np.int64)]),
                }
            )

    return rows.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "side", "node").mapInArrow(run, _FOUND)


def _fetch(placed: DataFrame, asked: DataFrame) -> DataFrame:
    """The asked sets (node, root, blocks, docs, doc, tie, shard), made again from their first document."""

    def run(key: tuple, rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("node", "root", "blocks", "docs", "members")}
        if wanted.num_rows and rows.num_rows:
            ids = rows.column("doc_id").fill_null(LAST).to_pylist()
            where = dict(zip(zip(ids, rows.column("tie").to_pylist(), strict=True), range(len(ids)), strict=True))
            at = [where[r["doc"], r["tie"]] for r in wanted.select(["doc", "tie"]).to_pylist()]
            hashes, first = sets(rows.column("text").take(pa.array(at)))
            out["members"] = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            for c in ("node", "root", "blocks", "docs"):
                out[c] = wanted.column(c).to_pylist()
        return pa.table({c: pa.array(v, pa.binary() if c == "members" else pa.int64()) for c, v in out.items()})

    return placed.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(run, "node long, root long, blocks long, docs long, members binary")


# ---------------------------------------------------------------- the operator


def join(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, class_id`` (smallest doc_id of all documents connected by links), ``n_links`` (documents
    it is linked to, copies of its set among them), ``n_linked_sets`` (different sets), and ``tie`` and ``stays``:
    whether it is its class's first document, in order of doc_id and a hash of the text."""
    placed = id_and_text(docs)
    placed = sharded(placed, shard_count(text_bytes(placed))).withColumn("tie", F.xxhash64("text"))
    members = pin(describe(placed), "sets")
    nodes = pin(members.groupBy("node").agg(F.min("tokens").alias("tokens"), F.min(F.struct("doc", "tie", "shard")).alias("place"), F.max("size").alias("size"), F.count("*").alias("docs")), "nodes")
    filled = nodes.where("size > 0")

    met = leaves(filled, runs_needed())
    near = components(compared(met.join(filled.select("node", "tokens"), "node").select("path", "node", "tokens", "n")))

    sizes = near.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    asked = near.join(sizes, "root").join(nodes.select("node", "docs", "place.*"), "node").select("node", "root", "blocks", "docs", "doc", "tie", "shard")
    fetched = _fetch(placed, asked)
    # block i of a component meets every block j >= i once
    own = F.pmod(F.xxhash64("node"), "blocks")
    dealt = fetched.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.selectExpr("root", "least(own, other) AS i", "greatest(own, other) AS j", "CASE WHEN own <= other THEN 0 ELSE 1 END AS side", "node", "docs", "members")
    found = pin(verified(dealt), "links")

    root = components(found.where("kind = 'link'").select("a", "b"))
    counts = found.where("kind = 'count'").groupBy(F.col("a").alias("node")).agg(F.sum("n_sets").alias("n_sets"), F.sum("n_docs").alias("n_docs"))
    known = nodes.select("node", "place", "docs").join(root, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = known.groupBy("root").agg(F.min("place").alias("head"))
    known = known.join(heads, "root").select("node", "docs", "head", F.coalesce("n_sets", F.lit(0)).alias("n_sets"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"))
    out = members.select("doc_id", "doc", "tie", "node").join(known, "node")
    return out.select(
        "doc_id",
        F.when(F.col("head.doc") != LAST, F.col("head.doc")).alias("class_id"),
        (F.col("docs") - 1 + F.col("n_docs")).alias("n_links"),
        F.col("n_sets").alias("n_linked_sets"),
        "tie",
        ((F.col("doc") == F.col("head.doc")) & (F.col("tie") == F.col("head.tie"))).alias("stays"),
    )


def firsts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are the first document of their class (of rows equal in doc_id and text, one)."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    doc_id, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    keyed = plain.withColumn("doc", F.coalesce(doc_id.cast("long"), F.lit(LAST))).withColumn("tie", F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))
    stays = join(docs.select("doc_id", "text")).where("stays").select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "tie")
    return keyed.join(stays, ["doc", "tie"], "left_semi").dropDuplicates(["doc", "tie"]).drop("doc", "tie").toDF(*names)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read_table(spark, sf_dir, "documents")).drop("tie", "stays")
