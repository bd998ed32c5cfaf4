"""Groups with their grand total from one aggregation (ROLLUP).

A share of the total needs every group and the row over all groups.  ROLLUP
gives both in one pass over the input; the total, one row, is then dealt to
every hash bucket of the groups and spread inside each, so no task sees all
groups and the input is not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 64


def with_total(df: DataFrame, keys: list[str], aggs: list[Column], totals: dict[str, str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` grouped by ``keys``, with the value of each aggregate in ``totals``
    (new column: aggregate's name) over all rows.

    NULL keys are groups of their own; without rows there are none.
    """
    k = F.struct(*keys).alias("_k")
    g = df.select(k, "*").rollup("_k").agg(F.grouping("_k").alias("_all"), *aggs)
    own = F.array(F.pmod(F.xxhash64("_k"), F.lit(buckets)).cast("int"))
    spread = g.withColumn("_b", F.explode(F.when(F.col("_all") == 1, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(own)))
    w = Window.partitionBy("_b")
    out = spread.withColumns({new: F.max(F.when(F.col("_all") == 1, F.col(c))).over(w) for new, c in totals.items()}).where("_all = 0")
    return out.select("_k.*", *[c for c in out.columns if c not in ("_k", "_all", "_b")])
