"""Service-level operators: on-time rate (C2), delay Pareto (C5),
monthly trend (C6) and the monthly roll-up of shipments (C13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.labels import NO_DELAY, SLA_BREACHED, SLA_MET, lane_label, month_label
from freightlens.functions.numeric import div_half_up, from_units, pct, pct_half_up, sum_units
from freightlens.plans.joins import join_dims
from freightlens.plans.totals import with_total

DELIVERED, DELAYED, DAMAGED = "Delivered", "Delayed", "Damaged"


def on_time_rate(shipments: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """On-time % and SLA status per provider x lane.

    "On time" is ``status = 'Delivered'``.  Counts are aggregated by ids
    first (map-side partial aggregation), then labelled, then merged by
    label so that two routes with the same city pair become one row.
    """
    by_ids = shipments.groupBy("provider_id", "route_id").agg(
        F.count("shipment_id").alias("total_shipments"),
        F.count_if(F.col("status") == DELIVERED).alias("on_time"),
        F.count_if(F.col("status") == DELAYED).alias("delayed"))
    labelled = join_dims(by_ids, providers, routes).withColumn("lane", lane_label())
    out = labelled.groupBy("provider_name", "lane", "sla_threshold").agg(
        F.sum("total_shipments").alias("total_shipments"),
        F.sum("on_time").alias("on_time"),
        F.sum("delayed").alias("delayed"))
    on_time_pct = pct_half_up("on_time", "total_shipments", 2)
    return (out.withColumn("on_time_pct", on_time_pct)
            .withColumn("sla_status", F.when(F.col("on_time_pct") >= F.col("sla_threshold"), F.lit(SLA_MET))
                        .otherwise(F.lit(SLA_BREACHED)))
            .select("provider_name", "lane", "total_shipments", "on_time", "delayed", "on_time_pct",
                    "sla_threshold", "sla_status")
            .orderBy("lane", F.col("on_time_pct").desc_nulls_last()))


def delay_pareto(shipments: DataFrame, no_delay_label: str = NO_DELAY) -> DataFrame:
    """Frequency, share, cost and complaints per delay reason.

    Groups on the raw reason, so a NULL reason and a literal ``No Delay``
    stay two rows.  The shipments are read once: ROLLUP gives the reasons and
    their total together.  Reasons are free text, so their number may grow
    with the data; no task sees all of them.
    """
    g = with_total(shipments, ["delay_reason"], [
        F.count(F.lit(1)).alias("frequency"),
        sum_units("total_cost_eur").alias("_cost_c"),
        F.count_if(F.col("customer_complaint")).alias("complaints")], {"_total": "frequency"})
    return (g.select(F.coalesce(F.col("delay_reason"), F.lit(no_delay_label)).alias("delay_reason"),
                     "frequency",
                     pct_half_up("frequency", "_total", 2).alias("pct_of_total"),
                     from_units("_cost_c").alias("total_freight_affected_eur"),
                     "complaints")
            .orderBy(F.col("frequency").desc()))


# Sums of the monthly history that add up: days to months, batches to a whole.
PARTS = ("total_shipments", "on_time_count", "delayed_count", "damaged_count", "_lead_sum", "_lead_n", "_weight_c", "_cost_c")


def history_parts(shipments: DataFrame, lead_days: Column | None = None, *more: str) -> DataFrame:
    """``PARTS`` per provider, route and month (and ``more`` columns): counts and
    exact integer sums (days, cents)."""
    lead = lead_days if lead_days is not None else F.datediff("actual_delivery", "shipment_date")
    return shipments.groupBy("provider_id", "route_id", F.trunc("shipment_date", "month").alias("month_year"), *more).agg(
        F.count(F.lit(1)).alias("total_shipments"),
        F.count_if(F.col("status") == DELIVERED).alias("on_time_count"),
        F.count_if(F.col("status") == DELAYED).alias("delayed_count"),
        F.count_if(F.col("status") == DAMAGED).alias("damaged_count"),
        F.sum(lead).alias("_lead_sum"),
        F.count(lead).alias("_lead_n"),
        sum_units("weight_kg").alias("_weight_c"),
        sum_units("total_cost_eur").alias("_cost_c"))


def history_of_parts(parts: DataFrame, providers: DataFrame | None = None) -> DataFrame:
    """The history rows of ``history_parts``; both means are rounded exactly from the sums."""
    h = parts.select(
        "provider_id", "route_id", "month_year", "total_shipments", "on_time_count", "delayed_count",
        "damaged_count",
        div_half_up("_lead_sum", "_lead_n", 2, scale=0).cast("decimal(9,2)").alias("avg_lead_time_days"),
        div_half_up("_cost_c", "_weight_c", 4, scale=0).cast("decimal(12,4)").alias("avg_cost_per_kg"),
        from_units("_cost_c", 2, 18).alias("total_revenue_eur"))
    if providers is None:
        return h.withColumn("sla_breached", F.lit(False))
    thr = providers.select("provider_id", "sla_threshold")
    return (h.join(thr, "provider_id", "left")
            .withColumn("sla_breached",
                        F.coalesce(pct("on_time_count", "total_shipments") < F.col("sla_threshold"), F.lit(False)))
            .drop("sla_threshold"))


def roll_up_history(shipments: DataFrame, providers: DataFrame | None = None,
                    lead_days: Column | None = None) -> DataFrame:
    """Monthly KPI roll-up of shipments into the performance-history shape.

    A shipment counts in the month of its ``shipment_date``.  Cost per kg
    is SUM(cost) / SUM(weight) of the month (weighted), rounded to 4
    places; lead time is the mean of ``lead_days`` (default: days from
    shipment to actual delivery), rounded to 2.  ``sla_breached`` flags a
    month whose on-time % is below the provider's threshold.  The history's
    columns hold a group of up to 10^16 EUR; a larger one is an error.
    ``history_store`` keeps the same roll-up up to date.
    """
    return history_of_parts(history_parts(shipments, lead_days), providers)


def monthly_trend(history: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """History rows with month label and on-time % to 2 places."""
    j = join_dims(history, providers, routes)
    return (j.orderBy("month_year", "provider_name", lane_label())
            .select(month_label().alias("month"), "provider_name", lane_label().alias("lane"),
                    "total_shipments", "on_time_count", "delayed_count",
                    pct_half_up("on_time_count", "total_shipments", 2).alias("on_time_pct"),
                    "avg_lead_time_days", "avg_cost_per_kg", "total_revenue_eur", "sla_breached"))
