import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import ODD, documents
from tillbook.llm import common, repeats


def test_transform_and_common_prefixes():
    rng = random.Random(0)
    for _ in range(200):
        strings = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.choice([0, 3, 12, 120]))) for _ in range(rng.randint(1, 12))]
        alphabet = [None, *sorted(set(b"".join(strings)))]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        bwt, lcp = repeats.build(np.frombuffer(b"".join(strings), np.uint8), offsets)
        # ends sort before all bytes, and by string
        suffixes = sorted(([c + 1 for c in s[i:]] + [k - 1000], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
        assert bwt.tolist() == [alphabet.index(strings[k][i - 1]) if i else 0 for _, k, i in suffixes]
        shared = [0]
        for (a, *_), (b, *_) in zip(suffixes, suffixes[1:]):
            shared.append(next(n for n, (x, y) in enumerate(zip(a, b)) if x != y))
        assert lcp.tolist() == shared


def brute(rows, length=50):
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1 if doc is not None else 0):
            first[raw[i : i + length]] = min(first.get(raw[i : i + length], doc), doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1 if doc is not None else 0):
            if first[raw[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((str(doc), len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(spark, rows):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(documents(spark, rows)).collect())


@pytest.mark.parametrize("hot", [20_000, 1])
def test_against_brute_force(spark, monkeypatch, hot):
    """Shared passages, near copies, text that repeats itself; with ``hot`` 1 every shared minimiser goes on window by window."""
    monkeypatch.setattr(repeats, "HOT_KINDS", hot)
    monkeypatch.setattr(common.shard_count, "__defaults__", (3000,))
    rng = random.Random(hot)
    passages = ["".join(rng.choice("abcd ") for _ in range(rng.randint(40, 130))) for _ in range(12)]

    def text():
        parts = [rng.choice([rng.choice(passages), "x" * rng.randint(0, 80), "é" * rng.randint(0, 40), "".join(rng.choice("efgh ") for _ in range(rng.randint(0, 90)))]) for _ in range(rng.randint(0, 5))]
        return "".join(parts)

    rows = [(rng.choice([i, i, i, i // 2, None]), rng.choice([text(), text(), text(), None, ""])) for i in range(200)]
    rows += rows[:5] + ODD + [(1000, "yz" * 3000), (1001, "a" + "yz" * 2000)]
    expected = brute(rows)
    assert sum(r[2] for r in expected) > 5000
    assert found(spark, rows) == expected


def test_windows_of_just_the_length(spark):
    base = "".join(chr(97 + i % 23) for i in range(120))
    rows = [(1, base[:50]), (2, "#" + base[:50] + "#"), (3, base[:49] + "!"), (4, base[1:51]), (5, base[:51])]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_a_passage_of_just_the_length_in_a_third_of_all_documents(spark, monkeypatch):
    """Each time in other surroundings: its windows leave the minimiser's bucket, the one that repeats goes once from a shard."""
    monkeypatch.setattr(repeats, "HOT_KINDS", 50)
    monkeypatch.setattr(common.shard_count, "__defaults__", (20_000,))
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz "
    passage = "".join(rng.choice(letters) for _ in range(50))
    rows = []
    for i in range(600):
        text = "".join(rng.choice(letters) for _ in range(200))
        rows.append((i, text[:90] + passage + text[90:] if i % 3 == 0 else text))
    assert found(spark, rows) == brute(rows)
    table = repeats.with_cuts(documents(spark, [r for r in rows if r[0] % 3 == 0]).select("doc_id", "text")).toArrow()
    runs = repeats.Runs(table)
    same, counts = np.unique(runs.key, return_counts=True)
    hot = np.isin(runs.key, same[counts > 50])
    assert hot.sum() >= 200
    runs.replace(hot)
    fresh = runs.key[~np.isin(runs.key, same)]
    _, counts = np.unique(fresh, return_counts=True)
    assert len(fresh) > 1000 and counts.max() == 200 and np.sort(counts)[-2] < 30, "only the passage itself repeats often"


def test_lengths_that_do_not_fit(spark):
    for length in (10, 240):
        with pytest.raises(ValueError, match="not between"):
            repeats.remove_repeats(documents(spark, ODD), length)


@pytest.mark.parametrize("length", [30, 53, 70])
def test_other_lengths(spark, length):
    rng = random.Random(length)
    passages = ["".join(rng.choice("abcd ") for _ in range(rng.randint(length - 5, 3 * length))) for _ in range(6)]
    rows = [(i, "".join(rng.choice(passages) + "".join(rng.choice("efgh") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 4)))) for i in range(60)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(documents(spark, rows), length).collect())
    assert got == brute(rows, length)
