import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, documents, prose
from tillbook.llm import quality


def labelled(rng, n):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = prose(rng, rng.randint(20, 120)).split()
        text = " ".join(words) if good else rng.choice([" ".join([words[0]] * 40), "!! ".join(w.upper() for w in words), " | ".join(words)])
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_on_the_given_tables(spark):
    rows = quality.op2_quality(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    apart = rows.where("held_out").join(labels, "doc_id").groupBy("quality", "predicted").count().collect()
    n = {(r.quality, r.predicted): r["count"] for r in apart}
    assert n.get((1, 1), 0) >= 0.98 * (n.get((1, 0), 0) + n.get((1, 1), 0)), "clean documents stay"
    assert n.get((0, 0), 0) >= 0.95 * (n.get((0, 0), 0) + n.get((0, 1), 0))


def test_scores_are_the_exact_vote(spark):
    """Broadcast, blocked scores equal a plain loop over all neighbours."""
    rows, labels = labelled(random.Random(0), 150)
    model = quality.learn(documents(spark, rows + ODD), table(spark, labels + [(2, None, 0), (None, 1, 0), (999, 1, 0)]), "quality")
    assert len(model.labels) == 150 and np.allclose(np.linalg.norm(model.vectors, axis=1), 1)
    share = {k: (model.labels == k).sum() for k in (0, 1)}
    for r in quality.scored(documents(spark, rows[:20] + ODD), model).collect():
        v = model.project(*quality.terms(pa.array([r.text or ""])))[0]
        near = sorted((-round(float(v @ u), 6), i) for i, u in enumerate(model.vectors))[: quality.NEIGHBOURS]
        votes = [(max(-c, 1e-6) ** quality.SHARPNESS / share[int(model.labels[i])], model.labels[i]) for c, i in near]
        assert abs(r.score - sum(w * y for w, y in votes) / sum(w for w, _ in votes)) < 0.02
        assert 0 <= r.score <= 1


def test_accepted_keeps_columns_and_clean_rows(spark):
    rows, labels = labelled(random.Random(1), 200)
    model = quality.learn(documents(spark, rows), table(spark, labels), "quality")
    docs = documents(spark, rows)
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    good = {i for i, y, _ in labels if y}
    got = {r.doc_id for r in kept.collect()}
    assert len(got & good) >= 0.97 * len(good) and len(got - good) <= 0.1 * (200 - len(good))


def test_sample_bounds_the_fit(spark):
    rows, labels = labelled(random.Random(2), 200)
    model = quality.learn(documents(spark, rows), table(spark, labels * 2), "quality", sample=20)
    assert sorted(np.unique(model.labels, return_counts=True)[1]) == [20, 20]


def test_no_labels_and_no_rows(spark):
    docs = documents(spark, ODD)
    none = quality.learn(docs, table(spark, []), "quality")
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    one = quality.learn(docs, table(spark, [(1, 1, 0), (4, 1, 0)]), "quality")
    assert {r.score for r in quality.scored(docs, one).collect()} == {1.0}
    assert quality.scored(docs.limit(0), one).count() == 0


def test_the_fold_of_a_null_id(spark):
    out = spark.createDataFrame([(None,), (0,)], "doc_id long").select(quality.held_out().alias("h"), (F.crc32(F.lit("0").cast("binary")) % 5 == 0).alias("zero")).collect()
    assert out[0].h and out[1].h == out[1].zero
