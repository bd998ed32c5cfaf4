"""Stored tables that keep their partitioning: what reads them needs no shuffle.

``store_bucketed`` writes a table bucketed on its keys under the application's
checkpoint folder and returns it read back.  A join or window on those keys
then runs without an exchange, as long as both sides have as many buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.plans.materialize import app_folder


def store_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, sort: list[str] | None = None) -> DataFrame:
    """Write ``df`` in ``buckets`` buckets of ``keys`` (sorted by ``sort``, the
    keys by default) and read it back.

    Rows are dealt to one task per bucket first, so there is a file per bucket,
    not one per task and bucket.  An empty table stays empty.
    """
    spark = df.sparkSession
    table = f"fl_{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*(sort or keys))
     .option("path", f"{app_folder(spark)}/{table}").format("parquet").saveAsTable(table))
    return spark.table(table)


def store_ranges(df: DataFrame, name: str, order: list, partitions: int, part: str = "_part") -> DataFrame:
    """Write ``df`` cut into ranges of ``order`` and read it back with the
    range's number in ``part``.

    The rows are shuffled once, by sampled range bounds; ranges are bucketed on
    their number, so work within a range needs no further exchange.
    """
    spark = df.sparkSession
    table = f"fl_{name}_{uuid.uuid4().hex}"
    cut = df.repartitionByRange(partitions, *order).withColumn(part, F.spark_partition_id())
    (cut.write.bucketBy(partitions, part).sortBy(part).option("path", f"{app_folder(spark)}/{table}").format("parquet").saveAsTable(table))
    return spark.table(table)
