"""The monthly history as a stored roll-up that is kept up to date.

The store holds per-day sums, which add up, in a partition per month.  New
shipments are summed by day alone; only the months they fall in are read and
rewritten (dynamic partition overwrite), however large the store is.  Every
row carries the batch that it came with, so a batch that is added again, say
after a lost driver, replaces itself instead of counting twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.operators.service import PARTS, history_of_parts, history_parts
from freightlens.plans.materialize import write_checkpoint_table

KEYS = ("provider_id", "route_id", "day", "batch")
SCHEMA = ("provider_id int, route_id int, day date, batch string, total_shipments bigint, on_time_count bigint, delayed_count bigint, "
          "damaged_count bigint, _lead_sum bigint, _lead_n bigint, _weight_c decimal(28,0), _cost_c decimal(28,0), month_year date")


def day_parts(shipments: DataFrame, batch: str, lead_days: Column | None = None) -> DataFrame:
    """Sums per provider, route and day of one batch."""
    parts = history_parts(shipments.withColumn("day", F.col("shipment_date")), lead_days, "day").withColumn("batch", F.lit(batch))
    kinds = dict(x.split(" ", 1) for x in SCHEMA.split(", "))
    return parts.select(*[F.col(c).cast(kinds[c]) for c in (*KEYS, *PARTS, "month_year")])


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def create(shipments: DataFrame, path: str, batch: str = "0", lead_days: Column | None = None) -> None:
    """Build the store anew from shipments; shipments without a date are a partition of their own."""
    day_parts(shipments, batch, lead_days).write.mode("overwrite").partitionBy("month_year").parquet(path)


def add(shipments: DataFrame, path: str, batch: str, lead_days: Column | None = None) -> None:
    """Add a batch of shipments: its months are rewritten, no other.

    Rows of the same batch in those months are replaced.  The merged months
    are written aside first, as their partitions cannot be read and replaced
    at once; a run that stops in between is simply repeated.  An empty batch
    changes nothing.
    """
    spark = shipments.sparkSession
    new = write_checkpoint_table(day_parts(shipments, batch, lead_days), "history-batch")
    months = new.select(F.col("month_year").alias("_m")).distinct()
    old = _read(spark, path).where(F.col("batch") != batch)
    kept = old.join(months, F.col("month_year").eqNullSafe(F.col("_m")), "left_semi")
    merged = write_checkpoint_table(kept.unionByName(new), "history-merged")
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_year").parquet(path))


def history(spark: SparkSession, path: str, providers: DataFrame | None = None) -> DataFrame:
    """The history of all batches, as ``roll_up_history`` gives it for all their shipments."""
    parts = _read(spark, path).groupBy("provider_id", "route_id", "month_year").agg(*[F.sum(c).alias(c) for c in PARTS])
    return history_of_parts(parts, providers)
