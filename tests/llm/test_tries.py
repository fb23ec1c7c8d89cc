import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tillbook.llm import tries

SCHEMA = "conv_id long, turn long, role string, text string, k1 long, words string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def conversations(rows):
    """Ordered (role, text) lists by conversation; equal turn numbers by the hash of what they say."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said = f"{len(role.encode())}:{role}{text}".encode()
            found.setdefault(conv, []).append(((turn is not None, turn or 0, hashlib.md5(said).digest()), (role, text)))
    return {c: [v for _, v in sorted(t)] for c, t in found.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - int(c - 20 * int(c / 20)), [])[:h] + own[h:]
    return out


def nodes_of(convs):
    """Every node from the definition."""
    members, ends = {}, {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for n in members:
        if n:
            kids[n[:-1]] = kids.get(n[:-1], 0) + 1
    for n, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in kids
            saved[n[:d]] += (len(m) - 1) * words
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids.get(n, 0), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
        for n, m in members.items()
    )


def got(frame):
    return sorted(tuple(r)[:8] for r in frame.collect())


def family(rng, convs, turns, phrases):
    """Conversations that often begin alike, some of them equal, some parts of others."""
    rows, seen = [], [[]]
    for c in convs:
        seq = list(rng.choice(seen)[: rng.randrange(turns + 1)])
        while len(seq) < rng.randrange(turns + 1):
            seq.append((rng.choice(["user", "assistant"]), rng.choice(phrases)))
        seen.append(seq)
        rows += [(c, t, *v) for t, v in enumerate(seq)]
    rng.shuffle(rows)
    return rows


PHRASES = ["", "a", "b c", " d\te  f ", "é 中 g", "long " * 50]


@pytest.mark.parametrize("cut,container", [(256, 1 << 14), (2, 3), (3, 1), (5, 12)])
def test_equals_the_definition(spark, cut, container):
    rng = random.Random(cut * 100 + container)
    rows = family(rng, [0, 5, 20, *rng.sample(range(-60, 300), 60)], 9, PHRASES)
    data = table(spark, rows)
    packed = tries.blocks(tries.turns(data), cut)
    assert got(tries.trie(tries.rebuilt(packed), cut, container)) == nodes_of(rebuilt(conversations(rows)))
    assert got(tries.trie(tries.whole(packed), cut, container)) == nodes_of(conversations(rows))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x y"), (1, 0, "user", "x y"), (1, 0, "bot", "z"), (None, 0, "user", "lost"), (2, None, "", ""), (2, 7, "user", "x y"), (0, 3, "a", "1:b"), (21, 1, "a1", ":b")]
    convs = conversations(rows)
    packed = tries.blocks(tries.turns(table(spark, rows)))
    assert got(tries.trie(tries.whole(packed))) == nodes_of(convs)
    assert got(tries.trie(tries.rebuilt(packed), 2, 1)) == nodes_of(rebuilt(convs))
    assert tries.trie(tries.rebuilt(tries.blocks(tries.turns(table(spark, rows).limit(0))))).count() == 0


def test_huge_and_copied_conversations(spark):
    """One conversation with a third of all rows and its copy, and one that a third of all conversations are."""
    rng = random.Random(7)
    long = [("user", f"turn {i} of it") for i in range(700)]
    convs = {40: long, 61: long, 62: long[:300], 63: long[:512], 64: long[:512] + [("user", "else")]}
    convs |= {c: [("user", "hello"), ("bot", "hi there")] for c in range(100, 300)}
    convs |= {c: [("user", "hello"), ("bot", f"{rng.random()}")] for c in range(300, 400)}
    rows = [(c, t, *v) for c, seq in convs.items() for t, v in enumerate(seq)]
    rng.shuffle(rows)
    packed = tries.blocks(tries.turns(table(spark, rows)), 16)
    parts = packed.where("conv_id = 40").select("first", "n").collect()
    assert sum(r.n for r in parts) == 700 and sorted(r.first for r in parts)[0] == 0
    # every depth of the long ones is a node: looked at in sum, as a plain list of prefixes grows with the square
    nodes = tries.trie(tries.whole(packed), 16, 64)
    assert nodes.count() == 1 + 700 + 1 + 2 + 100
    top = {r.depth: r for r in nodes.where("conv_id = 40").collect()}
    words = 4
    assert [top[d].n_convs for d in (1, 300, 301, 512, 513, 700)] == [5, 5, 4, 4, 2, 2]
    assert (top[512].n_children, top[512].n_leaves, top[700].n_children, top[700].n_leaves) == (2, 2, 0, 1)
    assert top[700].saved_tokens == words and top[513].saved_tokens == 188 * words
    assert top[1].saved_tokens == words * (300 * 4 + 212 * 3 + 188 * 1) and top[1].n_leaves == 2
    assert top[300].ends_sha256 == hashlib.sha256(b"62").hexdigest() and top[700].ends_sha256 == hashlib.sha256(b"40,61").hexdigest()
    assert top[0].n_convs == 305 and top[0].n_leaves == 2 + 1 + 100
    common = nodes.where("conv_id = 100 AND depth = 2").first()
    assert common.n_convs == 200 and common.ends_sha256 == hashlib.sha256(",".join(map(str, range(100, 300))).encode()).hexdigest()


def test_containers_burst_and_stay_small(spark):
    rng = random.Random(9)
    rows = family(rng, range(200), 8, PHRASES)
    cut_rows = tries.segments(tries.whole(tries.blocks(tries.turns(table(spark, rows)))))
    small, heads = tries.burst(tries.suffixes(cut_rows), 20)
    assert len(heads) > 1
    most = 0
    for frame in small:
        sizes = frame.groupBy("k1", "k2").agg(F.count("*").alias("rows"), (F.sum(F.octet_length("ids")) / tries.ID).alias("turns")).collect()
        assert all(r.turns <= 20 or r.rows == 1 for r in sizes)
        most += sum(r.rows for r in sizes)
    settled = sum(h.where("goes_on IS NOT NULL").count() for h in heads)
    assert most + settled == tries.suffixes(cut_rows).count()


def test_many_ids_are_joined_in_order(spark):
    ends = spark.range(5000).selectExpr("1L AS a1", "2L AS a2", "id * 3 AS conv_id", "true AS last")
    want = hashlib.sha256(",".join(str(3 * i) for i in range(5000)).encode()).hexdigest()
    assert [tuple(r) for r in tries.ended(ends, 400).collect()] == [(1, 2, want)]


def test_query_on_the_given_table(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    rows = [tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    out = tries.op12_burst_trie(spark, "/root/testdata/sf0.01")
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got(out) == nodes_of(rebuilt(conversations(rows)))
