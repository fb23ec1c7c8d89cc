import random
from collections import Counter

import numpy as np

from tests.llm.helpers import ODD, documents, prose
from tillbook.llm import common, graph, jaccard

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    words = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets, n = [shingles(t) for _, t in rows], len(rows)
    root, links, others, where = list(range(n)), [0] * n, [set() for _ in range(n)], {}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        for g in own or [None]:
            where.setdefault(g, []).append(i)
    for i, own in enumerate(sets):
        shared = Counter(j for g in own or [None] for j in where[g])
        for j, k in shared.items():
            if j != i and (own == sets[j] or 5 * k >= 4 * (len(own) + len(sets[j]) - k)):
                links[i] += 1
                root[find(i)] = find(j)
                if own != sets[j]:
                    others[i].add(sets[j])
    heads = {}
    for i, (d, _) in enumerate(rows):
        heads.setdefault(find(i), []).extend([d] if d is not None else [])
    return sorted((str(rows[i][0]), str(min(heads[find(i)], default=None)), links[i], len(others[i])) for i in range(n))


def corpus(rng, n):
    base = [prose(rng, rng.randint(3, 200), 500).split() for _ in range(40)]
    hot = prose(rng, 150, 500).split()
    rows = []
    for i in range(n):
        words = list(hot if rng.random() < 0.4 else rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(words))
            words[k : k + rng.randint(0, 1)] = [prose(rng, 1, 500)]
        text = rng.choice([None, "", " \n"]) if rng.random() < 0.05 else rng.choice([" ", "\n"]).join(words)
        rows.append((rng.choice([100 + i, 100 + i, 100 + i, None]), text.upper() if text and rng.random() < 0.1 else text))
    return rows + rows[:5] + ODD


def test_against_brute_force(spark, monkeypatch):
    """A third of the rows are near copies of one text: more sets than a block or a leaf holds."""
    monkeypatch.setattr(jaccard, "BLOCK", 60)
    monkeypatch.setattr(jaccard, "SMALL", 16)
    monkeypatch.setattr(common.shard_count, "__defaults__", (30_000,))
    rows = corpus(random.Random(5), 400)
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links, r.n_linked_sets) for r in jaccard.join(documents(spark, rows)).collect())
    assert got == brute(rows)


def test_one_of_each_class_stays(spark):
    rows = corpus(random.Random(6), 120)
    docs = documents(spark, rows)
    kept = jaccard.firsts(docs)
    assert kept.columns == docs.columns
    classes = {r[1] if r[1] != "None" else (r[0], r[2]) for r in brute(rows)}
    texts = [r.text for r in kept.collect()]
    named = {c for c in classes if isinstance(c, str)}
    assert len([r for r in kept.collect() if r.doc_id is not None]) == len(named)
    sets = [shingles(t) for t in texts]
    assert len(set(sets)) == len(sets)


def test_no_rows_and_no_links(spark):
    assert jaccard.join(documents(spark, [])).count() == 0
    rows = jaccard.join(documents(spark, [(1, "a b c d e f"), (2, "g h i j k l"), (None, "m n")])).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in rows) == [("1", "1", 0), ("2", "2", 0), ("None", "None", 0)]


def test_runs_reach_the_recall():
    """Pairs at the threshold meet in a leaf at full depth in nearly all trials of the stated number of runs."""
    rng = np.random.default_rng(0)
    runs, met, trials = jaccard.runs_needed(), 0, 300
    for _ in range(trials):
        a = rng.integers(0, 2**32, jaccard.SAMPLED).astype(np.uint32)
        b = np.where(rng.random(jaccard.SAMPLED) < 0.8, a, rng.integers(0, 2**32, jaccard.SAMPLED).astype(np.uint32))
        paths = rng.integers(0, 2**63, runs).astype(np.uint64)
        for _ in range(jaccard.DEPTH):
            left = jaccard.children(paths, np.tile(a, (len(paths), 1)))[1]
            right = jaccard.children(paths, np.tile(b, (len(paths), 1)))[1]
            paths = np.intersect1d(left, right)
        met += len(paths) > 0
    assert met >= 0.99 * trials


def test_components(spark):
    rng = random.Random(0)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(40)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert set(got) == linked
    assert all((got[x] == got[y]) == (find(x) == find(y)) for x in linked for y in linked)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_large_leaves_are_compared_block_by_block(spark, monkeypatch):
    """Leaves of 3 to 90 near copies: no task holds more than two blocks, every two sets of a leaf meet, links are those of all pairs."""
    monkeypatch.setattr(jaccard, "LEAF_BLOCK", 20)
    rng = np.random.default_rng(7)
    rows, groups = [], {}
    for path, n in ((11, 3), (12, 20), (13, 21), (14, 90)):
        base = rng.integers(0, 2**32, (3, jaccard.SAMPLED))
        for k in range(n):
            own = np.where(rng.random(jaccard.SAMPLED) < 0.75, base[k % 3], rng.integers(0, 2**32, jaccard.SAMPLED)).astype(np.uint32)
            groups.setdefault(path, {})[1000 * path + k] = own
            rows.append((path, 1000 * path + k, bytearray(own.tobytes()), n))
    members = spark.createDataFrame(rows, "path long, node long, tokens binary, n long")
    tasks = {}
    for r in jaccard.blocks(members).collect():
        tasks.setdefault(r.leaf, []).append((r.side, r.node))
    assert max(map(len, tasks.values())) < 80, "a block is about LEAF_BLOCK sets"
    met = {frozenset((a, b)) for own in tasks.values() for s, a in own for t, b in own if a != b and (s == 2 or s != t)}
    assert met == {frozenset((a, b)) for own in groups.values() for a in own for b in own if a != b}

    def roots(pairs):
        root = {r[1]: r[1] for r in rows}
        for a, b in pairs:
            x, y = root[a], root[b]
            root = {k: x if v == y else v for k, v in root.items()}
        return {frozenset(k for k in root if root[k] == v) for v in root.values()}

    expected = [(a, b) for own in groups.values() for a in own for b in own if a < b and (own[a] == own[b]).sum() >= jaccard.PASS]
    assert roots((r.a, r.b) for r in jaccard.compared(members).collect()) == roots(expected)
