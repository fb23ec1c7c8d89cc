"""A rebuild never shows half a table, and an append that two runs make at once lands once."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillbook.plans.graph import Project
from tillbook.plans.pipeline import build_all
from tillbook.session import run_folder
from tillbook.sources.tables import BATCH_DATE, land, read_landed
from tillbook.sources.versions import current, prune, publish, read_current, versions
from tillbook.streaming import daily


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_write_that_dies_leaves_the_old_table_whole(spark):
    table = run_folder(spark, "test-versions") + "/t"
    assert current(spark, table) is None
    with pytest.raises(FileNotFoundError):
        read_current(spark, table)
    publish(spark.range(100), table)
    # the last of eight tasks fails, when others have written their files
    broken = spark.range(0, 800, 1, 8).select(F.expr("if(id = 799, raise_error('lost'), id)").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, table)
    assert len(versions(spark, table)) == 2, "what was written of the new version is there, unused"
    assert ids(read_current(spark, table)) == list(range(100))
    publish(spark.range(5), table)
    assert ids(read_current(spark, table)) == list(range(5))


def test_a_reader_keeps_its_version(spark):
    table = run_folder(spark, "test-versions") + "/t"
    publish(spark.range(10), table)
    reader = read_current(spark, table)  # planned, not read yet
    publish(spark.range(20), table)
    assert prune(spark, table) == [] and ids(reader) == list(range(10))
    publish(spark.range(30), table)
    assert len(prune(spark, table)) == 1 and len(versions(spark, table)) == 2
    assert ids(read_current(spark, table)) == list(range(30))
    assert len(prune(spark, table, keep=1)) == 1 and ids(read_current(spark, table)) == list(range(30))


def test_partitioned_versions(spark):
    table = run_folder(spark, "test-versions") + "/t"
    publish(spark.range(100).withColumn("y", F.col("id") % 3), table, ["y"])
    assert read_current(spark, table).where("y = 1").count() == 33


def test_a_rebuild_over_an_earlier_one(spark):
    out = run_folder(spark, "test-rebuild")
    first = build_all(Project.from_dir(spark, SF_SMALL), out, with_checks=False)
    second = build_all(Project.from_dir(spark, SF_SMALL), out, with_checks=False)
    for name in ("fct_orders", "rpt_daily_revenue"):
        assert first.tables[name] != second.tables[name] == current(spark, f"{out}/marts/{name}")
        rows = [sorted(map(str, read.collect())) for read in (read_current(spark, f"{out}/marts/{name}"), spark.read.parquet(first.tables[name]))]
        assert rows[0] == rows[1], "the version before stays readable"


def test_two_appends_at_a_time_land_once(spark):
    p = Project.from_dir(spark, SF_SMALL)
    raw_dir = run_folder(spark, "test-race") + "/raw"
    for t in daily.BATCH_TABLES:
        land(p.table(t), raw_dir, t, mode="overwrite")
    base = {t: read_landed(spark, raw_dir, t).count() for t in daily.BATCH_TABLES}
    batches = daily.daily_batches(p.sources, p.as_of_text)
    # both runs read the table before either has written
    staged = {t: [daily.stage_batch(spark, raw_dir, t, batches[t], p.as_of_text) for _ in range(2)] for t in daily.BATCH_TABLES}
    for t, (one, other) in staged.items():
        daily.land_staged(spark, raw_dir, t, other, p.as_of_text)
        daily.land_staged(spark, raw_dir, t, one, p.as_of_text)
    for t, n in daily.BATCH_ROWS.items():
        landed = read_landed(spark, raw_dir, t)
        assert landed.count() == base[t] + n
        rows = daily.day_rows(landed, p.as_of_text).drop(BATCH_DATE)
        assert sorted(map(str, rows.collect())) == sorted(map(str, batches[t].select(rows.columns).collect()))
    assert [r.appended for r in daily.append_daily_batch(spark, raw_dir, batches, p.as_of_text)] == [0, 0, 0]


def test_two_appends_that_complete_a_batch(spark):
    """Forty rows have landed before; both runs bring the other sixty."""
    p = Project.from_dir(spark, SF_SMALL)
    raw_dir = run_folder(spark, "test-race") + "/raw"
    t = "raw_payments"
    batch = daily.daily_batches(p.sources, p.as_of_text)[t]
    land(batch.where("right(payment_id, 4) <= '0040'").withColumn(BATCH_DATE, daily.batch_day(p.as_of_text)), raw_dir, t)
    staged = [daily.stage_batch(spark, raw_dir, t, batch, p.as_of_text) for _ in range(2)]
    assert [n for _, n in staged] == [60, 60]
    for s in staged:
        daily.land_staged(spark, raw_dir, t, s, p.as_of_text)
    assert read_landed(spark, raw_dir, t).count() == 100 == read_landed(spark, raw_dir, t).select("payment_id").distinct().count()
    assert daily.append_daily_batch(spark, raw_dir, {t: batch}, p.as_of_text, (t,))[0].appended == 0


def test_an_older_run_does_not_replace_what_a_newer_one_completed(spark):
    """A whole batch staged early lands after another run's forty-row half was completed: no row twice, none lost."""
    p = Project.from_dir(spark, SF_SMALL)
    raw_dir = run_folder(spark, "test-race") + "/raw"
    t = "raw_payments"
    batch = daily.daily_batches(p.sources, p.as_of_text)[t]
    land(p.table(t).limit(5), raw_dir, t, mode="overwrite")
    early = daily.stage_batch(spark, raw_dir, t, batch, p.as_of_text)
    assert daily.append_daily_batch(spark, raw_dir, {t: batch}, p.as_of_text, (t,))[0].appended == 100
    daily.land_staged(spark, raw_dir, t, early, p.as_of_text)
    assert read_landed(spark, raw_dir, t).count() == 105


def test_samples_spread_over_large_keys_and_differ_by_day(spark):
    keys = spark.range(10**9, 11 * 10**9, 49999).toDF("k")  # 200,000 keys over more than a million residues each
    days = [[r.k for r in daily.sample_rows(keys, "k", 400, f"2001-08-{d:02d}").collect()] for d in (1, 2)]
    for got in days:
        assert len(set(got)) == 400
        tenths = [sum((k - 10**9) // 10**9 == i for k in got) for i in range(10)]
        assert min(tenths) >= 15, "small keys are not preferred"
        residues = [sum(k % 7 == i for k in got) for i in range(7)]
        assert min(residues) >= 30
    assert len(set(days[0]) & set(days[1])) <= 10, "another day, another sample"
    assert days[0] == [r.k for r in daily.sample_rows(keys.repartition(5), "k", 400, "2001-08-01").collect()]


def test_samples_merge(spark):
    """The sample of a table follows from the samples of its parts, and a smaller one from a larger one."""
    keys = spark.range(5000).toDF("k").withColumn("v", F.col("k") * 2)
    parts = [daily.bottom_k(keys.where(f"k % 3 = {i}"), "k", 50, "s") for i in range(3)]
    whole = daily.bottom_k(keys, "k", 50, "s")
    assert sorted(map(tuple, daily.merge_samples(parts, "k", 50).collect())) == sorted(map(tuple, whole.collect()))
    few = [r.k for r in daily.sample_rows(keys, "k", 20, "s").collect()]
    assert few == [r.k for r in daily.sample_rows(keys, "k", 50, "s").orderBy("rn").limit(20).collect()]
    assert "TakeOrderedAndProject" in whole._jdf.queryExecution().executedPlan().toString()
    nulls = spark.createDataFrame([(None,), (3,), (3,)], "k long")
    assert [r.k for r in daily.sample_rows(nulls, "k", 5, "s").collect()] == [3, 3]
    assert daily.sample_rows(nulls.limit(0), "k", 5, "s").count() == 0
