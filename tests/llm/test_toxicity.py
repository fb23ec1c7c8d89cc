import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, documents, prose
from tillbook.llm import toxicity

BAD = ["blockhead", "dunderhead", "nincompoop", "numbskull"]


def insulting(rng, n):
    words = prose(rng, n).split()
    for _ in range(2):
        words[rng.randrange(n)] = rng.choice(BAD)
    return " ".join(words)


def labelled(rng, n):
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        size = rng.choice([6, 20, 60, 400])
        rows.append((i, insulting(rng, size) if bad else prose(rng, size)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def one_by_one(model, text):
    """The model, word by word and window by window, on plain Python values."""

    def rows(word):
        spaced = b" " + word + b" "
        for n in toxicity.LENGTHS:
            for i in range(len(spaced) - n + 1):
                h = spaced[i]
                for b in spaced[i + 1 : i + n]:
                    h = (h * 0x01000193 + b) & 0xFFFFFFFF
                h = (h ^ (n * 0x3C6EF372 & 0xFFFFFFFF)) * 0x9E3779B1 & 0xFFFFFFFF
                yield ((h ^ h >> 15) * 0x85EBCA77 & 0xFFFFFFFF) >> (33 - toxicity.BUCKETS.bit_length())

    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = raw.translate(bytes(32 if b in (9, 10, 11, 12, 13) else b for b in range(256))).split(b" ")
    words = [w for w in words if w]
    values = []
    for w in words:
        own = [int(model.weights[r]) for r in rows(w)]
        values.append(round(sum(own) / len(own)) if own else 0)
    half = toxicity.WINDOW // 2
    windows = [values[i : i + toxicity.WINDOW] for i in range(0, max(1, len(values) - toxicity.WINDOW + half), half)] if values else [[]]
    odds = sum(math.exp(sum(w) / max(1, len(w)) / toxicity.UNIT + model.bias) for w in windows)
    return odds / (1 + odds)


def test_held_out_accuracy_on_the_given_tables(spark):
    rows = toxicity.op11_toxicity(spark, "/root/testdata/sf0.1")
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    apart = rows.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in apart}
    assert n.get((0, 0), 0) >= 0.97 * (n.get((0, 0), 0) + n.get((0, 1), 0)), "clean documents are left alone"
    assert n.get((1, 1), 0) >= 0.8 * (n.get((1, 0), 0) + n.get((1, 1), 0))


def test_scores_equal_a_plain_loop(spark):
    rows, labels = labelled(random.Random(0), 240)
    model = toxicity.learn(documents(spark, rows), table(spark, labels))
    some = rows[:40] + [r for r in ODD if r[0] != 5]
    docs = documents(spark, some)
    out = toxicity.scored(docs, model)
    assert out.columns == docs.columns + ["score"]
    for r in out.collect():
        assert abs(r.score - one_by_one(model, r.text)) < 1e-5 and 0 <= r.score <= 1
    long = toxicity.scored(documents(spark, [(5, "Long " * 20000), (6, "x" * 100_000)]), model).collect()
    assert all(0 <= r.score <= 1 for r in long)


def test_scores_do_not_depend_on_batches():
    rows, labels = labelled(random.Random(3), 120)
    texts = [t for _, t in rows]
    model = toxicity.fit(pa.array(texts), np.array([y for *_, y in labels], float))
    whole = model.score(pa.array(texts))
    assert whole.tolist() == [float(model.score(pa.array([t]))[0]) for t in texts]


def test_unseen_misspellings_are_caught():
    rng = random.Random(1)
    rows, labels = labelled(rng, 600)
    model = toxicity.fit(pa.array([t for _, t in rows]), np.array([y for *_, y in labels], float))
    clean = [prose(rng, rng.choice([6, 60, 400])) for _ in range(100)]
    bad = []
    for w in ("blockheadd", "bblockhead", "dunderheadz", "dunderhad", "ninncompoop", "nincompoops", "numbskulll", "numskull", "Numbskull!"):
        words = prose(rng, 200).split()
        words[rng.randrange(200)] = w
        words[rng.randrange(200)] = w
        bad.append(" ".join(words))
    assert (model.score(pa.array(clean)) < 0.5).mean() >= 0.97
    assert (model.score(pa.array(bad)) >= 0.5).mean() >= 0.85


def test_bounds_of_the_fit(spark):
    rows, labels = labelled(random.Random(2), 90)
    seen = []
    original = toxicity.fit
    toxicity.fit = lambda column, y, *a: seen.append((column.to_pylist(), y.tolist())) or original(column, y, *a)
    try:
        toxicity.learn(documents(spark, rows + rows[:9]), table(spark, labels * 2 + [(None, 1, 1), (4, 1, None)]), sample=20)
        toxicity.learn(documents(spark, rows), table(spark, labels), most=20_000)
    finally:
        toxicity.fit = original
    assert sorted(seen[0][1]) == [0.0] * 20 + [1.0] * 20, "at most so many texts of each label, each once"
    for y in (0.0, 1.0):
        assert 0 < sum(len(t) for t, z in zip(*seen[1], strict=True) if z == y) <= 10_000


def test_no_labels_one_label_and_no_rows(spark):
    docs = documents(spark, ODD)
    none = toxicity.learn(docs, table(spark, []))
    assert {r.score for r in toxicity.scored(docs, none, [0]).collect() if r.doc_id == 2} == {0.5}
    ones = toxicity.learn(docs, table(spark, [(1, 1, 1), (4, 1, 1), (6, 0, 1)]))
    assert all(r.score > 0.5 for r in toxicity.scored(docs, ones).collect())
    assert toxicity.scored(docs.limit(0), ones).count() == 0
    assert toxicity.learn(docs.limit(0), table(spark, [(1, 1, 1)])).score(pa.array([""])).tolist() == [0.5]


def test_the_fold_that_is_held_out(spark):
    rows = toxicity.op11_toxicity(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    wrong = rows.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) != F.col("held_out"))
    assert wrong.isEmpty() and rows.where("predicted <> if(score >= 0.5, 1, 0)").isEmpty()
