import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, documents
from tillbook.llm import class_lm, common

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER)), None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def grammar(rng, n):
    """Text whose next word depends on the class of the word before."""
    out, kind = [], 0
    for _ in range(n):
        out.append(f"{'abc'[kind]}{rng.randrange(30)}")
        kind = (kind + 1) % 3 if rng.random() < 0.9 else rng.randrange(3)
    return " ".join(out)


def test_base_score_and_counts(spark, monkeypatch):
    monkeypatch.setattr(common.shard_count, "__defaults__", (2000,))
    rng = random.Random(1)
    rows = ODD + [(i, grammar(rng, rng.randrange(60)).replace("a1", "A1")) for i in range(100, 260)]
    out = class_lm.score(documents(spark, rows), common.crc_mod("doc_id", 7) == 2).collect()
    count = Counter(t for d, x in rows if not held_out(d) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    expected = []
    for d, x in rows:
        own = tokens(x)
        expected.append((str(d), held_out(d), len(own), sum(count[t] > 0 for t in own), n, round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in own), 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(got) == sorted(expected)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out)
    apart = [r for r in out if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart), "classes predict held-out text better than single words"


def test_exchange_finds_the_classes():
    rng = np.random.default_rng(0)
    kinds = np.concatenate([[0], np.repeat([1, 2, 3], 10)])
    pairs = np.zeros((31, 31), np.int64)
    for a in range(1, 31):
        for b in range(1, 31):
            pairs[a, b] = rng.poisson(40 if kinds[b] == kinds[a] % 3 + 1 else 1)
    classes = class_lm.exchange(pairs, classes=4)
    for k in (1, 2, 3):
        assert len(set(classes[kinds == k])) == 1
    assert len(set(classes[1:])) == 3 and classes[0] == 0


def test_a_word_goes_to_its_best_class():
    """``better`` against the likelihood of the whole table with one word moved at a time."""
    rng = np.random.default_rng(5)
    n, end = 60, class_lm.END
    classes = np.concatenate([[end], rng.integers(1, 6, n - 1)])
    pairs = rng.poisson(0.6, (n, n))
    pairs[np.arange(1, n), np.arange(1, n)] += rng.poisson(1.0, n - 1)

    def table(classes):
        member = np.zeros((n, class_lm.CLASSES), np.int64)
        member[np.arange(n), classes] = 1
        return member.T @ pairs @ member

    word, side, count = [], [], []
    for u in range(1, n):
        beside = np.zeros(class_lm.SIDES, np.int64)
        for v in range(n):
            if v != u:
                beside[classes[v]] += pairs[u, v]
                beside[class_lm.CLASSES + classes[v]] += pairs[v, u]
        beside[-1] = pairs[u, u]
        used = np.flatnonzero(beside)
        word, side, count = word + [u - 1] * len(used), side + used.tolist(), count + beside[used].tolist()
    got = class_lm.better(table(classes), classes[1:], np.array(word), np.array(side), np.array(count))
    assert (got != classes[1:]).any()
    for u in range(1, n):
        every = [class_lm.likelihood(table(np.where(np.arange(n) == u, b, classes))) for b in range(1, class_lm.CLASSES)]
        assert every[got[u - 1] - 1] >= max(every) - 2 * class_lm.GAIN


def test_words_beyond_the_top_go_by_their_neighbours(spark, monkeypatch):
    """1,200 words of one ending: more than the units hold, whose neighbours alone tell their classes apart."""
    monkeypatch.setattr(common.shard_count, "__defaults__", (60_000,))
    rng = random.Random(4)
    rows, true = [], 0.0
    for i in range(120):
        words, kind = [], 0
        for _ in range(300):
            words.append(f"{'abc'[kind]}{rng.randrange(400)}zzz")
            go = rng.random() < 0.95
            true += math.log10(0.95 if go else 0.025)
            kind = (kind + 1) % 3 if go else (kind + rng.choice((0, 2))) % 3
        true += 300 * math.log10(1 / 400)
        rows.append((i, " ".join(words)))
    seen = {}
    real = class_lm.build
    monkeypatch.setattr(class_lm, "build", lambda *a: seen.setdefault("model", real(*a)))
    out = class_lm.score(documents(spark, rows), F.lit(False)).collect()
    total, n = sum(r.score for r in out), sum(r.n_tokens for r in out)
    assert total / n > true / n - 0.05, "per token about as probable as by the classes that made the texts"
    # the model holds every distinct word in some class
    held = round(sum((10 ** seen["model"].unseen * np.maximum(seen["model"].size, 1) / seen["model"].discount)[1:][seen["model"].size[1:] > 0]))
    assert held == len({t for _, x in rows for t in x.split()})


def test_scores_are_those_of_a_plain_class_bigram(spark, monkeypatch):
    """All words in classes found by the job: transitions, emissions and counts as a plain class bigram on the same classes has them."""
    monkeypatch.setattr(common.shard_count, "__defaults__", (3000,))
    seen = {}
    real = class_lm.build
    monkeypatch.setattr(class_lm, "build", lambda *a: seen.setdefault("model", real(*a)))
    rng = random.Random(7)
    rows = [(i, grammar(rng, rng.randrange(1, 40))) for i in range(200)]
    out = class_lm.score(documents(spark, rows), common.crc_mod("doc_id", 7) == 2).collect()
    model = seen["model"]
    train = [tokens(x) for d, x in rows if not held_out(d)]
    count = Counter(t for x in train for t in x)
    known = [t for t in count if t is not None]
    words = common.Words(__import__("pyarrow").array([t.decode() for t in known]))
    kind = dict(zip(known, model.classes[model.top.units(words.hashes, class_lm.endings(words, np.arange(len(known))))].tolist(), strict=True)) | {None: class_lm.END}
    pair = Counter((kind[a], kind[b]) for x in train for a, b in zip([None, *x], x, strict=False))
    before, size = Counter(), Counter()
    for (a, b), n in pair.items():
        before[a] += n
        size[b] += n
    distinct = Counter(kind[t] for t in known)
    tokens_ = sum(size.values())
    by_id = {r.doc_id: r.score for r in out}
    for d, x in rows:
        if not set(tokens(x)) <= set(count):
            continue
        score = 0.0
        for a, b in zip([None, *tokens(x)], tokens(x), strict=False):
            prior = (size[kind[b]] + 1) / (tokens_ + class_lm.CLASSES)
            score += math.log10((pair[kind[a], kind[b]] + class_lm.PRIOR * prior) / (before[kind[a]] + class_lm.PRIOR))
            if b is not None:
                score += math.log10((count[b] - model.discount) / size[kind[b]])
        assert math.isclose(score, by_id[d], rel_tol=1e-9)
    assert all(math.isclose(10 ** model.unseen[c] * size[c], model.discount * distinct[c], rel_tol=1e-9) for c in distinct)


def test_a_class_model_sums_to_one(spark, monkeypatch):
    """Known words and one unseen word of every class, after any class, have probability 1 together."""
    seen = {}
    real = class_lm.build
    monkeypatch.setattr(class_lm, "build", lambda *a: seen.setdefault("model", real(*a)))
    rng = random.Random(2)
    rows = [(i, grammar(rng, 50)) for i in range(60)]
    class_lm.score(documents(spark, rows), F.lit(False)).count()
    model, count = seen["model"], Counter(t for _, x in rows for t in tokens(x))
    assert np.allclose((10**model.transition).sum(1), 1)
    total = np.zeros(class_lm.CLASSES)
    known = [t for t in count if t is not None]
    words = common.Words(__import__("pyarrow").array([t.decode() for t in known]))
    kinds = model.classes[model.top.units(words.hashes, class_lm.endings(words, np.arange(len(known))))]
    np.add.at(total, kinds, 10 ** model.emission(kinds, np.array([count[t] for t in known])))
    used = (model.size > 0) & (np.arange(class_lm.CLASSES) != class_lm.END)
    assert np.allclose((total + 10**model.unseen)[used], 1)


def test_no_training_rows_and_no_rows(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    rows = class_lm.score(docs, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in rows} == {(0, 0, 0.0)}
    assert class_lm.score(docs.limit(0), F.lit(False)).count() == 0
