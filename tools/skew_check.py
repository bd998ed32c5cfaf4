"""Skew experiment for the fact build: give one supplier a third of all
lineitems, or one customer a third of all orders (in a scratch copy), and
show that AQE splits the hot join partition.

Usage: python tools/skew_check.py <scratch_dir> [sf_dir] [supplier|customer]

Writes only into <scratch_dir>: the modified table and links to the other
tables.  Thresholds are lowered to the test size so the split is visible.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from freightlens.session import get_session  # noqa: E402
from freightlens.sources import testdata as td  # noqa: E402


def main() -> None:
    scratch = sys.argv[1].rstrip("/")
    sf_dir = (sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1").rstrip("/")
    hot = sys.argv[3] if len(sys.argv) > 3 else "supplier"
    changed = {"supplier": "lineitem", "customer": "orders"}[hot]
    os.makedirs(scratch, exist_ok=True)
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        link = f"{scratch}/{t}.parquet"
        if t != changed and not os.path.exists(link):
            os.symlink(f"{sf_dir}/{t}.parquet", link)
    spark = get_session("local[8]", shuffle_partitions=16, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"})
    if hot == "supplier":
        li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        (li.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_suppkey")))
         .write.mode("overwrite").parquet(f"{scratch}/lineitem.parquet"))
    else:
        o = spark.read.parquet(f"{sf_dir}/orders.parquet")
        # Written as 16 files: AQE splits a skewed partition along map tasks, and
        # a real orders table spans many files (the test file is read by one task).
        (o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")))
         .repartition(16).write.mode("overwrite").parquet(f"{scratch}/orders.parquet"))
    facts = td.shipment_facts(spark, scratch)
    facts.collect()
    plan = facts._jdf.queryExecution().executedPlan().toString()
    joins = sorted({line.strip().lstrip(":+- *0123456789()") for line in plan.splitlines() if "SortMergeJoin" in line})
    print("\n".join(joins))
    print("skew split applied:", any("skew=true" in j for j in joins))


if __name__ == "__main__":
    main()
