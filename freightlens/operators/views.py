"""The three reporting views (C9-C11) and their registration as temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.labels import lane_label, month_label
from freightlens.functions.numeric import (
    PCT_SCALE,
    div_half_up,
    mean_half_up,
    mean_parts,
    pct_decimal,
    round_half_up,
)
from freightlens.plans.joins import join_dims


def v_scorecard(history: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """View 1: means and totals per provider x lane label.

    ``sla_breach_months`` sums the stored flag; it is not recomputed here.
    """
    j = join_dims(history, providers, routes).withColumn("lane", lane_label())
    return j.groupBy("provider_name", "lane").agg(
        *mean_parts("avg_cost_per_kg", 4, "cost"),
        *mean_parts(pct_decimal("on_time_count", "total_shipments"), PCT_SCALE, "otd"),
        *mean_parts("avg_lead_time_days", 2, "lead"),
        F.sum("total_shipments").alias("total_shipments_ytd"),
        F.sum("total_revenue_eur").alias("total_spend_eur"),
        F.sum(F.col("sla_breached").cast("int")).alias("sla_breach_months")).select(
        "provider_name", "lane", mean_half_up("cost", 4).alias("avg_cost_per_kg"),
        mean_half_up("otd", PCT_SCALE, 2).alias("avg_on_time_pct"),
        mean_half_up("lead", 2).alias("avg_lead_time_days"), "total_shipments_ytd", "total_spend_eur",
        "sla_breach_months")


def v_trend(history: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """View 2: one row per history row, on-time % at the original's 5 places."""
    j = join_dims(history, providers, routes)
    return j.select(month_label().alias("month"), "month_year", "provider_name", lane_label().alias("lane"),
                    pct_decimal("on_time_count", "total_shipments").alias("on_time_pct"),
                    "avg_cost_per_kg", "avg_lead_time_days", "total_revenue_eur")


def v_detail(shipments: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """View 3: shipment detail with delay days and cost per kg (C11).

    Map-only: both dimensions are broadcast, no shuffle of the shipments.
    """
    j = join_dims(shipments, providers, routes)
    return j.select("shipment_id", "shipment_date", "provider_name", lane_label().alias("lane"), "weight_kg",
                    "commodity_type", "promised_delivery", "actual_delivery",
                    F.datediff("actual_delivery", "promised_delivery").alias("delay_days"),
                    "total_cost_eur",
                    div_half_up("total_cost_eur", "weight_kg", 4).alias("actual_cost_per_kg"),
                    "status", "delay_reason", "customer_complaint")


def register_views(history: DataFrame, shipments: DataFrame, providers: DataFrame, routes: DataFrame) -> None:
    """``CREATE OR REPLACE TEMP VIEW`` for the three views, for SQL users."""
    v_scorecard(history, providers, routes).createOrReplaceTempView("vw_provider_scorecard")
    v_trend(history, providers, routes).createOrReplaceTempView("vw_monthly_trend")
    v_detail(shipments, providers, routes).createOrReplaceTempView("vw_shipment_detail")


ALERT_COLUMNS = ("provider_name STRING, lane STRING, rolling_3m_otd DOUBLE, sla_threshold DOUBLE, "
                 "breach_status STRING, recommended_action STRING")


def register_sql_surface(history: DataFrame, shipments: DataFrame, providers: DataFrame,
                         routes: DataFrame) -> None:
    """The reference's SQL surface: the three views plus the alert as a
    table function, ``SELECT * FROM check_sla_breach_alerts()`` (S5, S6, G1).

    The function body selects from a temp view of the ``sla_alerts``
    DataFrame, so SQL and DataFrame users get the same plan.
    """
    from freightlens.operators.alerts import sla_alerts

    spark = history.sparkSession
    register_views(history, shipments, providers, routes)
    alerts = sla_alerts(history, providers, routes)
    alerts.select(*[F.col(c).cast(t) for c, t in (x.split() for x in ALERT_COLUMNS.split(", "))]) \
        .createOrReplaceTempView("freightlens_sla_alerts")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION check_sla_breach_alerts() RETURNS TABLE ({ALERT_COLUMNS}) "
              "RETURN SELECT * FROM freightlens_sla_alerts")
