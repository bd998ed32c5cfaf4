"""Report measures over the views: KPI cards (C14), month-over-month
change and calendar rolling mean (C16), switch savings (C17, C18) and the
red/amber/green flag (C19)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.labels import (
    DEFAULT_ANNUAL_VOLUME_KG,
    RAG_AT_RISK,
    RAG_BREACH,
    RAG_DEFAULT_AT_RISK,
    RAG_DEFAULT_GOOD,
    RAG_GOOD,
)
from freightlens.functions.numeric import PCT_SCALE, mean_exact, round_half_up


def kpis(v_scorecard: DataFrame, by: list[str] | None = None, lanes: list[str] | None = None) -> DataFrame:
    """Total spend, mean on-time %, mean cost per kg, shipments and SLA
    breaches over the view-1 rows (C14); optionally per ``by`` columns and
    for the chosen lanes only."""
    if lanes:
        v_scorecard = v_scorecard.filter(F.col("lane").isin(list(lanes)))
    aggs = [F.sum("total_spend_eur").alias("total_spend_eur"),
            mean_exact("avg_on_time_pct", 2).alias("avg_otd_pct"),
            mean_exact("avg_cost_per_kg", 4).alias("avg_cost_per_kg"),
            F.sum("total_shipments_ytd").alias("total_shipments"),
            F.sum("sla_breach_months").alias("sla_breaches")]
    return v_scorecard.groupBy(*(by or [])).agg(*aggs)


def rag(value, good: float = RAG_DEFAULT_GOOD, at_risk: float = RAG_DEFAULT_AT_RISK) -> Column:
    """Red/amber/green label: ``>= good``, ``>= at_risk``, else breach."""
    v = F.col(value) if isinstance(value, str) else value
    return (F.when(v >= F.lit(float(good)), F.lit(RAG_GOOD))
            .when(v >= F.lit(float(at_risk)), F.lit(RAG_AT_RISK)).otherwise(F.lit(RAG_BREACH)))


def rag_status(v_scorecard: DataFrame, good: float = RAG_DEFAULT_GOOD,
               at_risk: float = RAG_DEFAULT_AT_RISK) -> DataFrame:
    """Mean on-time % per provider over its lanes and its RAG flag."""
    g = v_scorecard.groupBy("provider_name").agg(mean_exact("avg_on_time_pct", 2).alias("avg_otd_pct"))
    return g.withColumn("sla_status", rag("avg_otd_pct", good, at_risk))


def _monthly(trend: DataFrame, by: list[str]) -> DataFrame:
    return trend.groupBy(*by, "month_year").agg(
        mean_exact("on_time_pct", PCT_SCALE).alias("avg_on_time_pct"),
        mean_exact("avg_cost_per_kg", 4).alias("avg_cost_per_kg"))


def mom_change(trend: DataFrame, by: list[str] | None = None, blank_as_zero: bool = False) -> DataFrame:
    """Month-over-month change of mean on-time % (2 places) and of mean
    cost per kg (4 places) per ``by`` group (C16).

    The previous month is the calendar month before (DAX ``DATEADD``), found
    by joining the monthly rows to themselves shifted one month, so a gap
    gives NULL rather than the row before.  ``blank_as_zero`` reproduces
    DAX, where a missing previous value counts as 0.
    """
    by = list(by or ["provider_name"])
    m = _monthly(trend, by)
    prev = m.select(*by, F.add_months("month_year", 1).alias("month_year"),
                    F.col("avg_on_time_pct").alias("_prev_otd"), F.col("avg_cost_per_kg").alias("_prev_cost"))
    j = m.join(prev, [*by, "month_year"], "left")
    po, pc = F.col("_prev_otd"), F.col("_prev_cost")
    if blank_as_zero:
        po, pc = F.coalesce(po, F.lit(0.0)), F.coalesce(pc, F.lit(0.0))
    return j.select(*by, "month_year",
                    round_half_up("avg_on_time_pct", 2).alias("avg_on_time_pct"),
                    round_half_up(F.col("avg_on_time_pct") - po, 2).alias("mom_otd_change"),
                    round_half_up("avg_cost_per_kg", 4).alias("avg_cost_per_kg"),
                    round_half_up(F.col("avg_cost_per_kg") - pc, 4).alias("mom_cost_change"))


def rolling_calendar(trend: DataFrame, months: int = 3, by: list[str] | None = None) -> DataFrame:
    """Mean on-time % over the trailing ``months`` calendar months.

    DAX averages rows, not monthly means, so each month carries its sum
    and count and the RANGE frame (on a month number, so gaps are
    respected) divides the summed sums by the summed counts.
    """
    by = list(by or ["provider_name"])
    exact = F.col("on_time_pct").cast(f"decimal(30,{PCT_SCALE})")
    m = trend.groupBy(*by, "month_year").agg(F.sum(exact).alias("_s"), F.count(exact).alias("_n"))
    idx = F.year("month_year") * 12 + F.month("month_year")
    w = Window.partitionBy(*by).orderBy(idx).rangeBetween(-(months - 1), 0)
    mean = F.sum("_s").over(w).cast("double") / F.nullif(F.sum("_n").over(w).cast("double"), F.lit(0.0))
    return m.select(*by, "month_year", round_half_up(mean, 2).alias("rolling_3m_otd"))


def lane_savings(v_scorecard: DataFrame, volumes: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Saving from moving each lane to its cheapest provider (C17):
    ``(current rate - best rate) * volume``.

    ``volumes`` has (lane, volume_kg).  ``current`` has (lane,
    provider_name); without it the current provider is the priciest on the
    lane.  Ties go to the first provider name.  One aggregation per lane,
    struct minima carry the provider with the rate.
    """
    rate = F.col("avg_cost_per_kg")
    aggs = [F.min(F.struct(rate.alias("r"), F.col("provider_name").alias("p"))).alias("_best")]
    if current is None:
        aggs.append(F.min(F.struct((-rate).alias("r"), F.col("provider_name").alias("p"))).alias("_cur"))
        g = v_scorecard.groupBy("lane").agg(*aggs).select(
            "lane", F.col("_cur.p").alias("current_provider"), (-F.col("_cur.r")).alias("current_rate"),
            F.col("_best.p").alias("best_provider"), F.col("_best.r").alias("best_rate"))
    else:
        cur = (v_scorecard.join(current.select("lane", "provider_name"), ["lane", "provider_name"])
               .select("lane", F.col("provider_name").alias("current_provider"), rate.alias("current_rate")))
        g = (v_scorecard.groupBy("lane").agg(*aggs)
             .select("lane", F.col("_best.p").alias("best_provider"), F.col("_best.r").alias("best_rate"))
             .join(cur, "lane"))
    return (g.join(volumes, "lane")
            .select("lane", "current_provider", "current_rate", "best_provider", "best_rate", "volume_kg",
                    round_half_up((F.col("current_rate") - F.col("best_rate")) * F.col("volume_kg"), 2)
                    .alias("annual_saving_eur")))


def lane_savings_total(savings: DataFrame) -> DataFrame:
    """The headline of C17: the saving summed over all lanes, and the lane count.

    Sums the per-lane savings as exact cents, so the total does not depend
    on summation order."""
    cents = F.round(F.col("annual_saving_eur") * F.lit(100.0)).cast("long")
    return savings.agg(F.count(F.lit(1)).alias("lanes"),
                       (F.sum(cents).cast("double") / F.lit(100.0) + F.lit(0.0)).alias("total_annual_saving_eur"))


def potential_saving(v_scorecard: DataFrame, volume_kg: float = DEFAULT_ANNUAL_VOLUME_KG) -> DataFrame:
    """``(max - min) cost per kg over all rows * volume``, 0 places."""
    return v_scorecard.agg(F.max("avg_cost_per_kg").alias("max_cost_per_kg"),
                           F.min("avg_cost_per_kg").alias("min_cost_per_kg")).select(
        "max_cost_per_kg", "min_cost_per_kg",
        round_half_up((F.col("max_cost_per_kg") - F.col("min_cost_per_kg")) * F.lit(float(volume_kg)), 0)
        .alias("potential_annual_saving"))
