"""Rate-card operators: landed rate (C1), quote spread (C3), volume scenarios (C4)."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.labels import DEFAULT_BAND_BOUNDARY, DEFAULT_BANDS, DEFAULT_SCENARIOS, lane_label
from freightlens.functions.numeric import mean_half_up, mean_parts, round_half_up
from freightlens.plans.joins import join_dims
from freightlens.plans.ranking import bucketed_rank

RATE = "base_rate_eur_per_kg"


def _with_fuel(rate):
    return rate * (1 + F.col("fuel_surcharge_pct") / 100)


def _with_discount(rate):
    return rate * (1 - F.col("volume_discount_pct") / 100)


def landed_rate(quotes: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """Rate after fuel surcharge, and after the volume discount too, 4 places."""
    q = join_dims(quotes, providers, routes).withColumn("lane", lane_label())
    eff = _with_fuel(F.col(RATE))
    return (q.select("provider_name", "lane", "weight_band_kg", RATE, "fuel_surcharge_pct",
                     round_half_up(eff, 4).alias("effective_rate_incl_fuel"),
                     round_half_up(_with_discount(eff), 4).alias("best_negotiated_rate"),
                     "quote_source")
            .orderBy("lane", "weight_band_kg", "effective_rate_incl_fuel"))


def quote_spread(quotes: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """Cheapest, priciest and mean base rate per lane x band, with the
    spread and the providers listed from cheapest to priciest (C3).

    The list has an entry per quote of the lane and band, so its length is
    that of the output format; ``ranked_quotes`` gives the same list as rows.
    It is put together on two levels: the quotes are cut into ranges by lane,
    band, rate and provider, each range lists its own part of a lane, and the
    parts (at most one per range) are joined in the order of the ranges.  No
    task sorts a whole lane.  A quote without a rate comes first.
    """
    q = (join_dims(quotes, providers, routes).withColumn("lane", lane_label())
         .withColumn("_item", F.concat(F.col("provider_name"), F.lit(": €"),
                                       F.col(RATE).cast("decimal(12,4)").cast("string"))))
    q = q.repartitionByRange("lane", "weight_band_kg", RATE, "provider_name").withColumn("_part", F.spark_partition_id())
    parts = q.groupBy("lane", "weight_band_kg", "_part").agg(
        F.min(RATE).alias("_lo"), F.max(RATE).alias("_hi"), *mean_parts(RATE, 4, "rate"),
        F.expr(f"listagg(_item, ' | ') WITHIN GROUP (ORDER BY {RATE}, provider_name)").alias("_items"))
    lo, hi = F.min("_lo"), F.max("_hi")
    return (parts.groupBy("lane", "weight_band_kg").agg(
        round_half_up(lo, 4).alias("cheapest_rate"),
        round_half_up(hi, 4).alias("priciest_rate"),
        F.sum("_rate_s").alias("_rate_s"), F.sum("_rate_n").alias("_rate_n"),
        round_half_up(hi - lo, 4).alias("rate_spread"),
        round_half_up((hi - lo) / F.nullif(lo, F.lit(0)) * 100, 2).alias("spread_pct"),
        F.expr("listagg(_items, ' | ') WITHIN GROUP (ORDER BY _part)").alias("provider_rates"))
        .select("lane", "weight_band_kg", "cheapest_rate", "priciest_rate", mean_half_up("rate", 4).alias("avg_rate"),
                "rate_spread", "spread_pct", "provider_rates")
        .orderBy("lane", "weight_band_kg"))


def ranked_quotes(quotes: DataFrame, providers: DataFrame, routes: DataFrame, rank: Callable[..., DataFrame] = bucketed_rank) -> DataFrame:
    """The entries of C3's list as rows: lane, band, provider and rate with its
    rank, cheapest first.  No task holds a whole lane.  ``rank``: ``bucketed_rank``
    is lazy, ``range_rank`` stores the rows and evaluates the inputs for that alone."""
    q = join_dims(quotes, providers, routes).select(lane_label().alias("lane"), "weight_band_kg", "provider_name", RATE)
    return rank(q, ["lane", "weight_band_kg"], RATE, out="rate_rank")


def volume_scenarios(quotes: DataFrame, providers: DataFrame, routes: DataFrame,
                     scenarios=DEFAULT_SCENARIOS, boundary: float = DEFAULT_BAND_BOUNDARY,
                     band_at_or_below: str = DEFAULT_BANDS[0],
                     band_above: str = DEFAULT_BANDS[1], rank: Callable[..., DataFrame] = bucketed_rank) -> DataFrame:
    """Total cost of each quote for each shipment size, ranked per route (C4).

    The reference joins on ``scenario_kg >= min_shipment_kg`` and then keeps
    the band picked by an OR rule.  Here each scenario is first mapped to
    its band, which turns the theta join into an equi-join on the band
    (hash join) followed by the ``>=`` filter.  The scenario list is an
    argument, so its size is known and it is broadcast.  ``rank`` as in
    ``ranked_quotes``.
    """
    # Sizes are DECIMAL literals: with DECIMAL rates the cost stays exact, as
    # in the original arithmetic; with DOUBLE rates it is DOUBLE.
    rows = F.array(*[F.struct(F.lit(Decimal(str(kg))).cast("decimal(9,3)").alias("scenario_kg"),
                              F.lit(str(label)).alias("scenario_label"))
                     for kg, label in scenarios])
    sc = quotes.sparkSession.range(1).select(F.inline(rows))
    sc = sc.withColumn("weight_band_kg", F.when(F.col("scenario_kg") <= F.lit(float(boundary)),
                                                F.lit(band_at_or_below)).otherwise(F.lit(band_above)))
    j = (join_dims(quotes, providers, routes)
         .join(F.broadcast(sc), "weight_band_kg")
         .filter(F.col("scenario_kg") >= F.col("min_shipment_kg")))
    cost = _with_discount(_with_fuel(F.col("scenario_kg") * F.col(RATE)))
    # The rank orders by the unrounded cost; no route is sorted in one task.
    ranked = rank(j.withColumn("_cost", cost), ["scenario_label", "route_id"], "_cost", out="cost_rank")
    return (ranked.select("scenario_label", "provider_name", lane_label().alias("lane"), "weight_band_kg", RATE,
                          "fuel_surcharge_pct", "volume_discount_pct",
                          round_half_up("_cost", 2).alias("total_cost_eur"), "cost_rank")
            .orderBy("scenario_label", "lane", "total_cost_eur"))
