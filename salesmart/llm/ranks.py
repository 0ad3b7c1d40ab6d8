"""Positions and running sums inside large groups, without a global sort and without one task for a hot group.

Rows of a group lie in ordered buckets of a bounded size.  Windows run inside a
bucket; a bucket's offset is a running sum over the group's buckets, a table
smaller by the bucket size.  Nothing is sampled, so a retried or repeated
evaluation gives the same numbers.  The small tables are written once, so
Spark knows their size when it chooses between a broadcast and a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BUCKET_ROWS = 4096


def _join(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on null-safe ``keys``; the keys of ``df`` stay."""
    right = small.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return df.join(right, on).drop(*[f"_r_{k}" for k in keys])


def running_sum_in_buckets(df: DataFrame, group: list[str], bucket: str, order: list, value: Column, name: str) -> DataFrame:
    """``df`` plus ``name``: the sum of ``value`` over earlier rows of the group, in the order (bucket, ``order``)."""
    before = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    per = df.groupBy(*group, bucket).agg(F.sum(value.cast("long")).alias("_s"))
    over = Window.partitionBy(*group).orderBy(bucket).rowsBetween(*before)
    offsets = written(per.select(*group, bucket, F.coalesce(F.sum("_s").over(over), zero).alias("_off")), "offsets")
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(*before)
    out = df.withColumn("_in", F.coalesce(F.sum(value.cast("long")).over(inside), zero))
    return _join(out, offsets, [*group, bucket]).withColumn(name, F.col("_in") + F.col("_off")).drop("_in", "_off")


def running_sum(df: DataFrame, group: list[str], hashed: Column, ties: list[str], value: Column, name: str) -> DataFrame:
    """The same in a shuffled order: buckets of about ``BUCKET_ROWS`` rows by a 64-bit hash, then hash, then ``ties``.

    Rows equal in hash and ties are interchangeable.  Null groups are a group of their own.
    """
    counts = written(df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).cast("long").alias("_nb")), "bucket_counts")
    base = _join(df.withColumn("_h", hashed), counts, group)
    # 31 bits of the hash as a fraction of the group's bucket count
    base = base.withColumn("_b", F.shiftright(F.shiftrightunsigned(F.col("_h"), 33) * F.col("_nb"), 31)).drop("_nb")
    return running_sum_in_buckets(base, group, "_b", ["_h", *ties], value, name).drop("_h", "_b")
