"""Hot keys of joins whose hot side AQE cannot split.

AQE's skew-join rule splits a skewed partition only when both children of
the sort-merge join are plain shuffle stages.  When one side is itself the
output of a co-partitioned join or aggregate (a dimension assembled in the
same query), a key holding a third of the rows still lands in one task.

``salted_left_join`` spreads such keys explicitly:

* a key is hot when more than ``rows_per_task`` left rows have it, and gets
  one salt for each so many rows: the spread follows the key's size;
* left rows of a hot key get a salt derived from a row column; NULL keys, which
  match nothing, are spread as well; all other rows get salt 0;
* right rows of a hot key are replicated once per salt; others keep salt 0;
* the join runs on ``(key, salt)``.  Every left row meets exactly the right
  rows of its key, so the result equals the plain left join.

Hot keys are counted in one map-side combined aggregate.  There are at most
``left rows / rows_per_task`` of them; how they reach both sides is left to the
optimizer, which broadcasts them if they measure small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000
#: Salts that NULL keys are spread over.
NULL_SALTS = 4096


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``key, _salts`` of every key with more than ``rows_per_task`` rows."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.ceil(F.count(F.lit(1)) / rows_per_task).alias("_salts"))
        .where(F.col("_salts") > 1)
    )


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    salt_from: Column,
    rows_per_task: int = ROWS_PER_TASK,
    how: str = "left",
) -> DataFrame:
    """``left [LEFT|INNER] JOIN right USING (key)`` with the hot keys spread over several tasks."""
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    hot = hot_keys(left, key, rows_per_task)
    salts = F.when(F.col(key).isNull(), F.lit(NULL_SALTS).cast("bigint")).otherwise(F.coalesce("_salts", F.lit(1).cast("bigint")))
    salted = left.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(salt_from), salts)).drop("_salts")
    last = F.coalesce("_salts", F.lit(1).cast("bigint")) - 1
    fanned = right.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("_salts")
    return salted.join(fanned, [key, "_salt"], how).drop("_salt")
