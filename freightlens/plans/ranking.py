"""RANK() over partitions that may be too large for one task.

``RANK() OVER (PARTITION BY p ORDER BY v)`` sorts each partition in a
single task.  Here, at every size, the rank is computed without that sort:

1. ``D = count(*) GROUP BY p, v`` - one row per distinct value; partial
   aggregation collapses a hot value map-side.
2. Approximate quantiles of the distinct values cut each partition of D
   into buckets of about equal size; equal values fall in the same bucket
   (bucket = number of cut points strictly below the value).
3. Rows in lower buckets of the same partition give each bucket an offset;
   inside a bucket a running sum over the sorted distinct values gives the
   count of strictly smaller rows.  ``rank = 1 + offset + smaller``.
4. Join the rank back to the rows on (p, v).

The result is exact; only the bucket sizes depend on the approximation.
NULL values rank first, as ``ORDER BY v`` ascending does.

``range_rank`` gives the same with a stored table: the rows are cut once into
ranges of (p, v), and every range ranks its own rows.  What a range adds to
them - the rows before it, and where the group and the value that it begins
with began - follows from one row per range, whatever the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.plans.bucketing import store_ranges

BUCKETS = 64

def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named keys where NULL matches NULL (``<=>``)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in keys]
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in keys])


def bucketed_rank(df: DataFrame, partition_cols: list[str], value: str, out: str = "rank",
                  buckets: int = BUCKETS) -> DataFrame:
    """Exact ``RANK() OVER (PARTITION BY partition_cols ORDER BY value)``
    where no task sorts more than about 1/``buckets`` of a partition's
    distinct values."""
    p = list(partition_cols)
    d = df.groupBy(*p, value).agg(F.count(F.lit(1)).alias("_n"))
    probs = [i / buckets for i in range(1, buckets)]
    cuts = d.groupBy(*p).agg(F.percentile_approx(value, probs, 10_000).alias("_cuts"))
    v = F.col(value)
    d = (_join_null_safe(d, cuts, p)
         .withColumn("_b", F.coalesce(F.size(F.filter("_cuts", lambda c: c < v)), F.lit(0)))
         .drop("_cuts"))
    lower = Window.partitionBy(*p).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (d.groupBy(*p, "_b").agg(F.sum("_n").alias("_bn"))
               .select(*p, "_b", F.coalesce(F.sum("_bn").over(lower), F.lit(0)).alias("_off")))
    inside = Window.partitionBy(*p, "_b").orderBy(v.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (_join_null_safe(d, offsets, [*p, "_b"])
              .select(*p, value, (F.lit(1) + F.col("_off") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
                      .cast("int").alias(out)))
    return _join_null_safe(df, ranked, [*p, value])


def _head_began(continues: str, last: str) -> Column:
    """Place among all rows where the run at a range's head began.

    ``last`` is the place in the range where its last run began; ``continues``
    says that its first run goes on from the range before.
    """
    own = F.when((F.col(last) > 0) | ~F.col(continues), F.col("_off") + F.col(last))  # null: the last run is the one that goes on
    before = F.last(own, ignorenulls=True).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return F.when(F.col(continues), before).otherwise(F.col("_off"))


def range_rank(df: DataFrame, partition_cols: list[str], value: str, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """``bucketed_rank`` over a stored range sort: ``df`` is evaluated for the
    range bounds and the write alone, its rows are shuffled once, and they are
    not joined back.

    Equal rows of a hot group or a hot value are spread over ranges (a hash of
    the row comes last in the sort order).  Runs a job; a column ``out`` of
    ``df`` is replaced; NULLs are a group and rank first; an empty table stays
    empty.
    """
    p = list(partition_cols)
    names = [c for c in df.columns if c != out]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = store_ranges(df.select(*names), "ranges", [*p, value, F.xxhash64(*names)], n)
    inside = Window.partitionBy("_part")
    at = rows.withColumns({"_v": F.rank().over(inside.orderBy(*p, value)) - 1, "_p": F.rank().over(inside.orderBy(*p)) - 1 if p else F.lit(0)})
    key = F.struct(*p, value)
    ranges = at.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_head"), F.max(key).alias("_tail"), F.max("_v").alias("_vl"), F.max("_p").alias("_pl"))
    # One row per range from here on: at most ``partitions`` rows.
    order = Window.orderBy("_part")
    ranges = ranges.withColumns({"_off": F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_prev": F.lag("_tail").over(order)})
    known = F.col("_prev").isNotNull()
    same = lambda cols: known & reduce(lambda a, b: a & b, [F.col(f"_head.{c}").eqNullSafe(F.col(f"_prev.{c}")) for c in cols], F.lit(True))
    ranges = ranges.withColumns({"_pc": same(p), "_vc": same([*p, value])})
    heads = ranges.select(F.col("_part"), "_off", _head_began("_vc", "_vl").alias("_vh"), _head_began("_pc", "_pl").alias("_ph"))
    j = at.join(F.broadcast(heads), "_part")
    begin = lambda own, head: F.when(F.col(own) == 0, F.col(head)).otherwise(F.col("_off") + F.col(own))
    return j.select(*names, (begin("_v", "_vh") - begin("_p", "_ph") + 1).cast("int").alias(out))
