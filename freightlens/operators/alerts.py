"""Rolling service-level alert (C8) and the rolling on-time series."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.labels import (
    ACTION_AT_RISK,
    ACTION_BREACH,
    ACTION_OK,
    ALERT_AT_RISK,
    ALERT_BREACH,
    ALERT_MARGIN,
    ALERT_OK,
    lane_label,
)
from freightlens.functions.numeric import (
    PCT_SCALE,
    mean_half_up,
    mean_parts,
    pct_decimal,
    pct_half_up,
    pct_units,
)
from freightlens.plans.joins import join_dims

PAIR = ("provider_id", "route_id")


def _exact(c: str):
    """A value with two places as DECIMAL, so that a rate on the line is on it."""
    return F.round(c, 2).cast("decimal(12,2)")


def rolling_on_time(history: DataFrame, providers: DataFrame, routes: DataFrame, window: int = 3) -> DataFrame:
    """On-time % per month and its mean over the last ``window`` rows.

    A ROWS frame: with a missing month it reaches further back in time.
    The window is partitioned by provider and route, one small partition
    per pair (months of history).
    """
    w = Window.partitionBy(*PAIR).orderBy("month_year").rowsBetween(-(window - 1), 0)
    units = pct_units("on_time_count", "total_shipments", PCT_SCALE)
    h = (history.select(*PAIR, "month_year", units.alias("_u"),
                        pct_half_up("on_time_count", "total_shipments", 2).alias("on_time_pct"))
         .withColumn("_r_s", F.sum("_u").over(w)).withColumn("_r_n", F.count("_u").over(w)))
    j = join_dims(h, providers, routes)
    return j.select("provider_name", lane_label().alias("lane"), "month_year", "on_time_pct",
                    mean_half_up("r", PCT_SCALE, 2).alias("rolling_3m_otd"))


def sla_alerts(history: DataFrame, providers: DataFrame, routes: DataFrame, window: int = 3,
               margin: float = ALERT_MARGIN) -> DataFrame:
    """Latest rolling on-time % per provider x route against the SLA.

    The rolling mean at the latest month is the mean of the last
    ``window`` rows, so the plan keeps the top ``window`` rows per pair
    (one descending sort, planned as a group limit) and averages them,
    instead of a rolling window plus a second, opposite sort.
    """
    latest_first = Window.partitionBy(*PAIR).orderBy(
        F.col("month_year").desc(), *[F.col(c) for c in ("perf_id",) if c in history.columns],
        F.col("total_shipments").desc(), F.col("on_time_count").desc())  # of two rows for a month always the same one first
    last = (history.withColumn("_pct", pct_decimal("on_time_count", "total_shipments"))
            .withColumn("_rn", F.row_number().over(latest_first))
            .filter(F.col("_rn") <= window))
    r = (last.groupBy(*PAIR).agg(*mean_parts("_pct", PCT_SCALE, "r"))
         .select(*PAIR, mean_half_up("r", PCT_SCALE, 2).alias("rolling_3m_otd")))
    j = join_dims(r, providers, routes)
    below = _exact("rolling_3m_otd") < _exact("sla_threshold")
    near = _exact("rolling_3m_otd") < _exact("sla_threshold") + F.lit(Decimal(str(margin))).cast("decimal(10,2)")
    return (j.select("provider_name", lane_label().alias("lane"), "rolling_3m_otd", "sla_threshold",
                     F.when(below, F.lit(ALERT_BREACH)).when(near, F.lit(ALERT_AT_RISK))
                     .otherwise(F.lit(ALERT_OK)).alias("breach_status"),
                     F.when(below, F.lit(ACTION_BREACH)).when(near, F.lit(ACTION_AT_RISK))
                     .otherwise(F.lit(ACTION_OK)).alias("recommended_action"))
            .orderBy(F.col("rolling_3m_otd").asc_nulls_last()))
