"""Approximate nearest neighbours by multiprobe p-stable hashing.

Method: each of ``TABLES`` tables hashes a vector to the cells of some
random projections, floor((a.x + b) / WIDTH) with normal a.  A query visits its
own cell and perturbed ones (up to ``MOVED`` coordinates moved by -1 or 1) in order of
estimated success: the sum of squared distances to the borders that are
crossed.  What any table finds is ranked by exact inner products; a query is
compared with the entries of the cells that it visits.

Nearness is the inner product, so vectors get one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm (0 for queries): then the nearest by
distance is the largest by product.  Scores use the original vectors.

How many projections make a cell and how many cells a query visits follow the
number of rows.  Both are fitted on ``SAMPLE`` vectors (by a hash of the id):
among the K nearest of N rows about K * SAMPLE / N are in the sample, so those
are what the sample's queries have to find (one at least, which lies farther
away).  For each entry of ``HASHES`` the first step of ``LADDER`` with a recall of
``RECALL`` is taken; the entry wins that makes the expected work smallest,
``PROBE`` comparisons for each probe and one for each entry visited.  So more
rows mean finer cells and a smaller share of rows visited, as far as the
vectors have structure: 64 independent components have none that any cells
could use.  Every row is indexed.

Equal vectors are one entry with their ``K + 1`` smallest ids - no other can be
among K nearest - and cells of more than ``PIECE`` entries are dealt to several
pieces, all of which a probe of the cell visits.

Defined cases: vectors that are null, zero or hold null or non-finite
components take no part, nor do null ids and vectors whose dimension is not the most
common one (ties: the largest); a repeated vec_id counts once, with its smallest
vector; with fewer than K others a query gets all of them that were found, or
all if its sample holds them; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillbook.llm.common import mix, read_table
from tillbook.session import pin

K = 20
TABLES, HASHES, WIDTH, MOVED = 8, (6, 8, 10, 12), 2.0, 3
#: A probe is a row that is joined and shuffled, a comparison some 64 multiplications: about 50 to 1.
SAMPLE, SAMPLE_QUERIES, RECALL, PROBE = 2000, 200, 0.95, 50
LADDER = (1, 2, 3, 5, 8, 12, 18, 25, 50, 75, 100, 150, 200, 300, 400, 600, 1000, 2000, 4000, 8000)
#: Whether queries are compared with the sample as well.
FALLBACK = True
#: Entries of a cell in one piece, and index rows in one task.
PIECE, PART_ROWS = 4096, 32_768


@lru_cache(maxsize=None)
def moves(hashes: int) -> np.ndarray:
    """All moves of up to ``MOVED`` coordinates by -1 or 1."""
    out = [np.zeros(hashes, np.int64)]
    for n in range(1, min(MOVED, hashes) + 1):
        for places in combinations(range(hashes), n):
            for signs in product((-1, 1), repeat=n):
                move = np.zeros(hashes, np.int64)
                move[list(places)] = signs
                out.append(move)
    return np.array(out)


class Hash:
    """The tables' projections for vectors of ``size`` components with norms up to ``largest``."""

    def __init__(self, size: int, largest: float, hashes: int):
        rng = np.random.default_rng(20)
        self.largest, self.hashes = largest, hashes
        self.a = rng.normal(size=(TABLES, size + 1, hashes))
        self.b = rng.uniform(0, WIDTH, (TABLES, hashes))

    def cells(self, table: int, vectors: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """Cell coordinates and places in the cells."""
        scaled = vectors / self.largest
        last = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(1 - np.square(scaled).sum(1), 0))
        at = (np.column_stack([scaled, last]) @ self.a[table] + self.b[table]) / WIDTH
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def names(self, table: int, cells: np.ndarray) -> np.ndarray:
        """A 64-bit name of each cell (last axis: coordinates)."""
        out = np.full(cells.shape[:-1], table + 1, np.uint64)
        for k in range(self.hashes):
            out = mix(out + cells[..., k].astype(np.uint64))
        return out.view(np.int64)

    def probes(self, table: int, vectors: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` likeliest cells of each query, likeliest first."""
        cell, place = self.cells(table, vectors, True)
        crossed = np.stack([place**2, np.zeros_like(place), (1 - place) ** 2], 2)  # of moves -1, 0, 1
        moves_ = moves(self.hashes)
        out = np.empty((len(vectors), min(count, len(moves_))), np.int64)
        for i in range(len(vectors)):
            cost = crossed[i, 0][moves_[:, 0] + 1]
            for k in range(1, self.hashes):
                cost = cost + crossed[i, k][moves_[:, k] + 1]
            best = np.argsort(cost, kind="stable")[:count]
            out[i] = self.names(table, cell[i] + moves_[best])
        return out


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def first_met(hash_: Hash, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """In how manyth cell a query first meets each vector (beyond all cells: the number of moves)."""
    most = len(moves(hash_.hashes))
    out = np.full((len(queries), len(vectors)), most, np.int32)
    for t in range(TABLES):
        names, which = np.unique(hash_.names(t, hash_.cells(t, vectors, False)[0]), return_inverse=True)
        probes = hash_.probes(t, queries, most)
        for i in range(len(queries)):
            order = np.argsort(probes[i])
            at = np.minimum(np.searchsorted(probes[i][order], names), most - 1)
            met = probes[i][order][at] == names
            np.minimum(out[i], np.where(met, order[at], most)[which], out=out[i])
    return out


def fit(size: int, largest: float, vectors: np.ndarray, rows: int) -> tuple[Hash, int]:
    """The hash, and the cells to visit in each table, for a table of ``rows`` vectors like these."""
    queries = vectors[:SAMPLE_QUERIES]
    score = queries @ vectors.T
    score[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    k = min(max(1, math.ceil(K * len(vectors) / max(1, rows))), len(vectors) - 1)
    if k < 1:
        return Hash(size, largest, HASHES[0]), LADDER[0]
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    options = []
    for hashes in HASHES:
        hash_ = Hash(size, largest, hashes)
        met = first_met(hash_, queries, vectors)
        places, most = np.take_along_axis(met, near, 1), len(moves(hashes))
        count = next((n for n in LADDER if (places < n).mean() >= RECALL), most)
        found, work = (places < count).mean(), TABLES * PROBE * min(count, most) + (met < count).mean() * rows
        options.append((found < RECALL, work if found >= RECALL else -found, hashes, hash_, count))
    return min(options, key=lambda o: o[:3])[3:]


# ---------------------------------------------------------------- the search

_ROW = "part long, cell long, piece long, node long, ids array<long>, vector binary"
_NEAR = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def best(query_ids: np.ndarray, queries: np.ndarray, entries: np.ndarray, ids: list[list[int]], visited: list[np.ndarray] | None) -> pa.Table:
    """Each query's K nearest among the entries that it visits (all, if None), by exact products."""
    out_q, out_v, out_s = [], [], []
    products = queries @ entries.T if visited is None else None
    for i, own in enumerate(query_ids.tolist()):
        line = products[i] if products is not None else entries[visited[i]] @ queries[i]
        if not len(line):
            continue
        top = min(K + 1, len(line))
        least = np.partition(line, len(line) - top)[len(line) - top]
        chosen = np.flatnonzero(line >= least - 1e-9)
        if visited is not None:
            chosen = visited[i][chosen]
        exact = (entries[chosen] * queries[i]).sum(1)  # summed the same way wherever the entry lies
        found = sorted((-s, v) for s, e in zip(exact.tolist(), chosen.tolist(), strict=True) for v in ids[e] if v != own)[:K]
        out_q += [own] * len(found)
        out_v += [v for _, v in found]
        out_s += [-s for s, _ in found]
    return pa.table([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())], schema=_NEAR)


def search(vectors: DataFrame, is_query) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the K nearest found; ``vectors``: vec_id, embedding; ``is_query``: a condition on vec_id."""
    spark = vectors.sparkSession
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    limit = F.lit(float("inf"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists("v", lambda x: x != 0)
    plain = plain.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(whole).groupBy("vec_id").agg(F.min("v").alias("v"))
    sizes = plain.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("square")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    size = sizes[0]["size"]
    plain = plain.where(F.size("v") == size)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("v").flatten().to_numpy().reshape(-1, size)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in rows + 0.0], pa.binary())], names=["vec_id", "vector"])

    packed = pin(plain.mapInArrow(pack, "vec_id long, vector binary"), "vectors")
    some = packed.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sample = np.frombuffer(b"".join(r.vector for r in some), np.float64).reshape(-1, size)
    hash_, count = fit(size, math.sqrt(sizes[0].square), sample, sizes[0].n)

    # equal vectors are one entry; the window's limit is applied before its shuffle too
    ranked = packed.withColumn("nth", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("nth") <= K + 1)
    entries = pin(ranked.groupBy("vector").agg(F.min("vec_id").alias("node"), F.collect_list("vec_id").alias("ids")), "entries")
    parts = max(1, math.ceil(entries.count() * TABLES / PART_ROWS))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("vector"), size)
            for t in range(TABLES):
                names = hash_.names(t, hash_.cells(t, rows, False)[0])
                yield pa.RecordBatch.from_arrays([pa.array(names), batch.column("node"), batch.column("ids"), batch.column("vector")], names=["cell", "node", "ids", "vector"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names = matrix(batch.column("vector"), size), batch.column("vec_id").to_numpy()
            for t in range(TABLES):
                cells = hash_.probes(t, rows, count)
                yield pa.RecordBatch.from_arrays([pa.array(cells.reshape(-1)), pa.array(np.repeat(names, cells.shape[1]))], names=["cell", "node"])

    queries = packed.where(is_query(F.col("vec_id"))).withColumnRenamed("vec_id", "node")
    indexed = entries.select("node", "ids", "vector").mapInArrow(index, "cell long, node long, ids array<long>, vector binary")
    probed = queries.withColumnRenamed("node", "vec_id").mapInArrow(probe, "cell long, node long")
    large = indexed.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > PIECE).select("cell", F.ceil(F.col("n") / PIECE).alias("pieces"))
    piece = F.coalesce(F.pmod(F.xxhash64("node"), "pieces"), F.lit(0).cast("long"))
    indexed = indexed.join(large, "cell", "left").withColumn("piece", piece)
    probed = probed.join(large, "cell", "left").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("pieces", F.lit(1)) - 1)))
    part = F.pmod(F.xxhash64("cell", "piece"), F.lit(parts))
    # each is read more than once: hashed once, written
    indexed = pin(indexed.withColumn("part", part).select("part", "cell", "piece", "node", "ids", "vector"), "cells")
    probed = pin(probed.withColumn("part", part).select("part", "cell", "piece", "node"), "probes")
    asked = probed.select("part", "node").distinct().join(queries, "node")
    empty = F.lit(None).cast("array<long>")
    rows = (
        indexed.unionByName(probed.select("part", "cell", "piece", "node", empty.alias("ids"), F.lit(None).cast("binary").alias("vector")))
        .unionByName(asked.select("part", F.lit(0).cast("long").alias("cell"), F.lit(-1).cast("long").alias("piece"), "node", empty.alias("ids"), "vector"))
    )

    def rank(key: tuple, table: pa.Table) -> pa.Table:
        kind = np.where(table.column("piece").to_numpy() < 0, 2, np.where(np.asarray(table.column("ids").is_valid()), 0, 1))
        own, asks, who = (table.filter(pa.array(kind == k)) for k in range(3))
        if not own.num_rows or not who.num_rows:
            return _NEAR.empty_table()
        node, first, entry = np.unique(own.column("node").to_numpy(), return_index=True, return_inverse=True)
        vectors_ = matrix(own.column("vector").take(pa.array(first)), size)
        ids = own.column("ids").take(pa.array(first)).to_pylist()
        place = [mix(t.column("cell").to_numpy().view(np.uint64) + mix(t.column("piece").to_numpy().astype(np.uint64))) for t in (own, asks)]
        order = np.argsort(place[0], kind="stable")
        entry, cells = entry[order], place[0][order]
        names = np.sort(who.column("node").to_numpy())
        query = matrix(who.column("vector").take(pa.array(np.argsort(who.column("node").to_numpy(), kind="stable"))), size)
        asker = np.searchsorted(names, asks.column("node").to_numpy())
        left, right = np.searchsorted(cells, place[1], "left"), np.searchsorted(cells, place[1], "right")
        hit = right > left
        asker, left, right = asker[hit], left[hit], right[hit]
        by = np.argsort(asker, kind="stable")
        asker, left, right = asker[by], left[by], right[by]
        edges = np.searchsorted(asker, np.arange(len(names) + 1))
        out = []
        step = max(1, (1 << 20) // max(1, len(node)))
        seen = np.zeros(len(node), bool)
        for a in range(0, len(names), step):  # queries by the block
            b = min(a + step, len(names))
            visited = []
            for i in range(a, b):
                seen[:] = False
                for x, y in zip(left[edges[i] : edges[i + 1]].tolist(), right[edges[i] : edges[i + 1]].tolist(), strict=True):
                    seen[entry[x:y]] = True
                visited.append(np.flatnonzero(seen))
            out.append(best(names[a:b], query[a:b], vectors_, ids, visited))
        return pa.concat_tables(out)

    # a stated number of partitions: small parts are not put together to one task
    found = rows.repartition(2 * parts, "part").groupBy("part").applyInArrow(rank, "query_id long, vec_id long, score double")

    # the sample's entries are compared with every query as well: a query always finds something
    sent = spark.sparkContext.broadcast((sample, [[r.vec_id] for r in some]))

    def against_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part_ = batch.slice(at, 1000)
                yield from best(part_.column("node").to_numpy(), matrix(part_.column("vector"), size), *sent.value, None).to_batches()

    if FALLBACK:
        found = found.unionByName(queries.mapInArrow(against_sample, "query_id long, vec_id long, score double"))
    found = found.dropDuplicates(["query_id", "vec_id"])
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


def op3_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0)
