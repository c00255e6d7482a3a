"""Helpers that several operators share: shared-folder tables, distributed ranks, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.sources.files import materialise, table

__all__ = ["components", "fraction_bucket", "materialise", "private", "ranked", "table"]


def private(columns: list[str], name: str) -> str:
    """A column name that none of columns has (in any case of letters)."""
    taken = {c.lower() for c in columns}
    name = f"__{name}"
    while name in taken:
        name = f"_{name}"
    return name


def fraction_bucket(digest, n: int):
    """Bucket 0..n-1 of a lowercase hex digest, in the digest's order."""
    return F.floor(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") * F.lit(n) / F.lit(2.0**32)).cast("long")


def ranked(df: DataFrame, group: list[str], bucket: str, order: list, out: str = "rank") -> DataFrame:
    """0-based rank of each row within its group, in the order of (bucket, *order).

    No task needs a whole group: rows are numbered inside (group, bucket), and the bucket's first number is the sum
    of the counts before it. The caller makes buckets fine enough; their values must rise with the order. Group columns
    must not be null. Rows that are equal in bucket and order get numbers of their own, in no order that is fixed.
    """
    cell = [*group, bucket]
    n, top, low, total, base, start, row = (private(df.columns, x) for x in ("n", "top", "low", "sum", "base", "start", "row"))
    counts = df.groupBy(*cell).agg(F.count(F.lit(1)).alias(n))
    coarse = F.floor(F.col(bucket) / 4096)
    # sums over at most 4096 buckets at a time, then over those sums
    tops = counts.groupBy(*group, coarse.alias(top)).agg(F.sum(n).alias(total))
    tops = tops.withColumn(base, F.coalesce(F.sum(total).over(_within(group).orderBy(top).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = F.sum(n).over(Window.partitionBy(*group, top).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn(top, coarse).withColumn(low, F.coalesce(before, F.lit(0)))
    starts = counts.join(tops.drop(total), [*group, top]).select(*cell, (F.col(low) + F.col(base)).alias(start))
    numbered = df.withColumn(row, F.row_number().over(Window.partitionBy(*cell).orderBy(*order)))
    return numbered.join(starts, cell).withColumn(out, (F.col(start) + F.col(row) - 1).cast("long")).drop(start, row)


def _within(group: list[str]):
    return Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node of the long-valued edges.

    Alternating large and small stars: each round links every node's larger, then smaller neighbours to the smallest
    one; rounds grow with the logarithm of the longest path. Every round is a table in the shared folder.
    """
    now = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        kept = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v"))
        now = materialise(kept.distinct())
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
