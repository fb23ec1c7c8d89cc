"""The distributed exact percentile against a brute-force computation."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillbook.operators.percentile import percentile_cont, value_range


def brute(values, fraction):
    vals = sorted(v for v in values if v is not None)
    if not vals:
        return None
    pos = (len(vals) - 1) * fraction
    lo, hi = int(np.floor(pos)), int(np.ceil(pos))
    return vals[lo] + (vals[hi] - vals[lo]) * (pos - lo)


def check(spark, rows, fraction):
    df = spark.createDataFrame(rows, "g string, h int, v double")
    got = {
        (r["g"], r["h"]): r["p"]
        for r in percentile_cont(df, ["g", "h"], "v", fraction, alias="p").collect()
    }
    groups = {}
    for g, h, v in rows:
        groups.setdefault((g, h), []).append(v)
    want = {k: brute(v, fraction) for k, v in groups.items() if brute(v, fraction) is not None}
    assert set(got) == set(want)
    for k, w in want.items():
        assert abs(got[k] - w) < 1e-9, (k, got[k], w)


def test_hot_group_and_null_keys(spark):
    rng = np.random.default_rng(7)
    rows = [("hot", 1, float(x)) for x in rng.integers(0, 50, 3000)]  # a third-of-the-data group, many ties
    rows += [(None, 2, float(x)) for x in rng.normal(size=501)]  # NULL group key
    rows += [("a", None, 1.5), ("a", None, None), ("b", 3, None)]  # NULL values are ignored
    rows += [("even", 4, 1.0), ("even", 4, 2.0), ("even", 4, 3.35), ("even", 4, 100.0)]
    for fraction in (0.5, 0.1, 0.9):
        check(spark, rows, fraction)


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2), st.one_of(st.none(), st.integers(-5, 5))),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([0.0, 0.25, 0.5, 1.0]),
)
def test_matches_brute_force(spark, rows, fraction):
    rows = [(g, h, None if v is None else float(v)) for g, h, v in rows]
    check(spark, rows, fraction)


def test_ranges_follow_the_values(spark):
    values = sorted({0.0, *(s * m * 10.0**e for s in (1, -1) for m in (1, 1.004, 2.5, 9.99) for e in range(-300, 300, 23))})
    rows = spark.createDataFrame([(v,) for v in values], "v double").withColumn("r", value_range(F.col("v"))).orderBy("v").collect()
    assert all(a.r <= b.r for a, b in zip(rows, rows[1:]))
    assert all((r.r > 0) == (r.v > 0) and (r.r < 0) == (r.v < 0) for r in rows)


def test_values_of_every_size(spark):
    rng = np.random.default_rng(3)
    rows = [("g", 1, float(s * 10**e)) for s, e in zip(rng.choice([-1, 1], 400), rng.uniform(-9, 9, 400))] + [("g", 1, None)] * 5
    for fraction in (0.0, 0.31, 0.5, 1.0):
        check(spark, rows, fraction)
