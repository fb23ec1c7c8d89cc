import numpy as np
from pyspark.sql import functions as F

from tillbook.llm import neighbours

QUERY = lambda i: F.pmod(i, F.lit(20)) == 0


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, 0) for i, v in rows], "vec_id long, embedding array<float>, node int, part int")


def exact(rows, k=20):
    size = 2
    own = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == size and None not in v and np.isfinite(v).all() and any(v):
            own[i] = min(own.get(i, v), v)
    out = []
    for q in sorted(own):
        if q % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(own[q], own[j])), j) for j in own if j != q)[:k]
            out += [(q, n, j, -s) for n, (s, j) in enumerate(near, 1)]
    return out


def test_odd_vectors_ties_and_copies(spark):
    rows = [(i, [1.0, 0.0] if i % 3 == 0 else [float(i % 7 - 3), float(i % 5)]) for i in range(100)]
    rows += [(200, None), (201, [0.0, 0.0]), (202, [float("nan"), 1.0]), (203, [None, 1.0]), (204, [1.0]), (205, [float("inf"), 1.0]), (None, [1.0, 1.0]), (40, [9.0, 9.0]), (60, [1.0, 0.0])]
    got = neighbours.search(frame(spark, rows), QUERY).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == exact(rows)


def test_fewer_rows_than_neighbours(spark):
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (3, [-1.0, 0.0])]
    assert [tuple(r) for r in neighbours.search(frame(spark, rows), QUERY).orderBy("query_id", "rank").collect()] == exact(rows)
    assert neighbours.search(frame(spark, [(0, [1.0, 2.0])]), QUERY).count() == 0
    assert neighbours.search(frame(spark, []), QUERY).count() == 0
    assert neighbours.search(frame(spark, [(0, None)]), QUERY).count() == 0


def recall(spark, vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "PIECE", 50)  # cells are dealt to several pieces
    monkeypatch.setattr(neighbours, "PART_ROWS", 8000)
    monkeypatch.setattr(neighbours, "SAMPLE", 500)  # far from all rows
    monkeypatch.setattr(neighbours, "FALLBACK", False)  # what the cells find alone
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = neighbours.search(frame(spark, rows), QUERY).collect()
    own = np.array(vectors, np.float32).astype(np.float64)
    found, hits = {}, []
    for r in got:
        found.setdefault(r.query_id, []).append(r)
        assert abs(r.score - own[r.query_id] @ own[r.vec_id]) < 1e-9 * max(1, abs(r.score))
    for q in range(0, len(own), 20):
        score = own @ own[q]
        score[q] = -np.inf
        near = set(np.argsort(-score, kind="stable")[:20].tolist())
        mine = sorted(found[q], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21)) and all(a.score > b.score or (a.score == b.score and a.vec_id < b.vec_id) for a, b in zip(mine, mine[1:]))
        hits.append(len(near & {r.vec_id for r in mine}) / 20)
    return np.mean(hits)


def test_recall_without_structure(spark, monkeypatch):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(4000, 32))
    assert recall(spark, vectors / np.linalg.norm(vectors, axis=1, keepdims=True), monkeypatch) >= 0.9


def test_recall_with_clusters_and_lengths(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    vectors = centres[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    assert recall(spark, vectors * rng.uniform(0.2, 3, (3000, 1)), monkeypatch) >= 0.9


def test_probes_come_in_order_of_cost():
    hash_ = neighbours.Hash(8, 1.0, 8)
    vector = np.random.default_rng(2).normal(size=(1, 8)) / 4
    names = hash_.probes(0, vector, 500)[0]
    cell, place = hash_.cells(0, vector, True)
    assert names[0] == hash_.names(0, cell)[0] and len(set(names.tolist())) == 500
    costs = {int(hash_.names(0, cell[0] + m)): float((np.where(m < 0, place[0], np.where(m > 0, 1 - place[0], 0)) ** 2).sum()) for m in neighbours.moves(8)}
    assert [costs[n] for n in names.tolist()] == sorted(costs.values())[:500]


def test_the_share_of_rows_visited_falls_as_rows_grow():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(400, 32))
    every = centres[rng.integers(0, 400, 50_000)] + 0.35 * rng.normal(size=(50_000, 32))
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    shares = []
    for n in (2000, 50_000):
        vectors = every[:n]
        hash_, count = neighbours.fit(32, 1.0, vectors[rng.permutation(n)[: neighbours.SAMPLE]], n)
        asked = rng.permutation(n)[:40]
        met = neighbours.first_met(hash_, vectors[asked], vectors) < count
        score = vectors[asked] @ vectors.T
        score[np.arange(40), asked] = -np.inf
        near = np.argpartition(-score, 19, axis=1)[:, :20]
        recall_, share = np.take_along_axis(met, near, 1).mean(), met.mean()
        print(f"{n} rows: {hash_.hashes} projections, {count} cells a table, recall {recall_:.3f}, {share:.1%} of rows visited")
        assert recall_ >= 0.9
        shares.append(share)
    assert shares[1] < 0.6 * shares[0]
