"""Weighted min-max scorecard (C7), DAX measure scores (C15) and weight
sensitivity (C20).

Normalising needs the minimum and maximum over all groups: a one-row
aggregate over the grouped rows (one row per provider), attached as a scalar
subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.labels import DEFAULT_WEIGHTS
from freightlens.functions.numeric import (
    PCT_SCALE,
    dax_divide,
    mean_exact,
    mean_half_up,
    mean_parts,
    pct_decimal,
    round_half_up,
)

SCORES = ("cost_score", "reliability_score", "lead_time_score")


def _fraction(x: Column, lo: Column, hi: Column, on_zero_range: str) -> Column:
    if on_zero_range == "zero":
        return dax_divide(x - lo, hi - lo, 0.0)
    if on_zero_range != "null":
        raise ValueError("on_zero_range must be 'null' or 'zero'")
    return (x - lo) / F.nullif(hi - lo, F.lit(0.0))


def min_max_score(x: Column, lo: Column, hi: Column, higher_is_better: bool,
                  on_zero_range: str = "null") -> Column:
    """Score 0-100 of ``x`` within ``[lo, hi]``, rounded to 2 places.

    Lower-is-better metrics are inverted: ``(1 - frac) * 100``.  A zero
    range gives NULL (SQL ``NULLIF``) or treats the fraction as 0 (DAX
    ``DIVIDE(.., .., 0)``).
    """
    frac = _fraction(x, lo, hi, on_zero_range)
    return round_half_up(frac * 100 if higher_is_better else (1 - frac) * 100, 2)


def weighted(weights=DEFAULT_WEIGHTS, cols=SCORES) -> Column:
    wc, wr, wl = (F.lit(float(w)) for w in weights)
    c, r, lt = (F.col(x) for x in cols)
    return c * wc + r * wr + lt * wl


def provider_metrics(history: DataFrame, providers: DataFrame) -> DataFrame:
    """Unweighted means of the monthly metrics per provider, rounded 4/2/2."""
    g = history.groupBy("provider_id").agg(
        *mean_parts("avg_cost_per_kg", 4, "cost"),
        *mean_parts(pct_decimal("on_time_count", "total_shipments"), PCT_SCALE, "otd"),
        *mean_parts("avg_lead_time_days", 2, "lead"))
    return (g.join(providers.select("provider_id", "provider_name"), "provider_id")
            .select("provider_id", "provider_name",
                    mean_half_up("cost", 4).alias("avg_cost_per_kg"),
                    mean_half_up("otd", PCT_SCALE, 2).alias("avg_on_time_pct"),
                    mean_half_up("lead", 2).alias("avg_lead_days")))


def add_scores(metrics: DataFrame, cost: str, otd: str, lead: str, on_zero_range: str = "null",
               bounds: dict | None = None) -> DataFrame:
    """Attach cost, reliability and lead-time scores.

    ``bounds`` maps each metric to (lo, hi) column names already on the
    rows; without it the bounds are the min and max over all rows.
    """
    specs = (("cost_score", cost, False), ("reliability_score", otd, True), ("lead_time_score", lead, False))
    ends = [(bounds[col] if bounds else (col, col)) for _, col, _ in specs]
    out = metrics.withColumn("_ends", _one_row(metrics, {n: e for (n, _, _), e in zip(specs, ends)}))
    for name, col, better in specs:
        out = out.withColumn(name, min_max_score(F.col(col), F.col(f"_ends.{name}_lo"), F.col(f"_ends.{name}_hi"), better, on_zero_range))
    return out.drop("_ends")


def _one_row(df: DataFrame, ends: dict[str, tuple[str, str]]) -> Column:
    """``struct(<name>_lo, <name>_hi, ...)``: the minimum of the first and the
    maximum of the second column of each name, as a one-row subquery."""
    fields = [f for n, (lo, hi) in ends.items() for f in (F.min(lo).alias(f"{n}_lo"), F.max(hi).alias(f"{n}_hi"))]
    return df.agg(F.struct(*fields)).scalar()


# Weights are applied as integers of 10^-6 (0.40 -> 400000).
WEIGHT_SCALE = 6


def _units(col, scale: int) -> Column:
    """A value with ``scale`` decimals (DOUBLE or DECIMAL) as an exact integer of 10^-scale."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(float(10 ** scale))).cast("long")


def add_exact_scores(metrics: DataFrame, specs, on_zero_range: str = "null") -> DataFrame:
    """Min-max scores computed exactly, as decimal SQL does.

    ``specs`` is (score name, metric column, metric decimals, higher is
    better).  Metrics are rounded means, i.e. integers in their units, so
    ``ROUND((hi - x) / (hi - lo) * 100, 2)`` is the integer division
    ``(20000 (hi - x) + (hi - lo)) div 2 (hi - lo)`` in units of 0.01.
    The bounds are a one-row aggregate.  Each score also keeps its integer form in ``_<name>_u`` for exact weighting.
    """
    if on_zero_range not in ("null", "zero"):
        raise ValueError("on_zero_range must be 'null' or 'zero'")
    out = metrics.withColumns({f"_{name}_x": _units(col, scale) for name, col, scale, _ in specs})
    ends = _one_row(out, {f"_{name}": (f"_{name}_x", f"_{name}_x") for name, *_ in specs})
    out = out.withColumn("_ends", ends).select("*", "_ends.*").drop("_ends")
    for name, _, _, better in specs:
        x, lo, hi = f"_{name}_x", f"_{name}_lo", f"_{name}_hi"
        num = f"({x} - {lo})" if better else f"({hi} - {x})"
        rng = f"({hi} - {lo})"
        q = F.expr(f"(20000 * CAST({num} AS DECIMAL(38,0)) + {rng}) div nullif(2 * CAST({rng} AS DECIMAL(38,0)), 0)")
        if on_zero_range == "zero":  # DAX DIVIDE(.., 0, 0): fraction 0
            q = F.when(F.col(hi) == F.col(lo), F.lit(0 if better else 10000)).otherwise(q)
        out = (out.withColumn(f"_{name}_u", q)
               .withColumn(name, F.col(f"_{name}_u").cast("double") / F.lit(100.0))
               .drop(x, lo, hi))
    return out


def exact_weighted_units(weight_cols: dict[str, str]) -> Column:
    """Sum of score units (0.01) times weight units (10^-WEIGHT_SCALE): the
    exact weighted total in units of 10^-(2 + WEIGHT_SCALE)."""
    terms = [f"CAST(_{score}_u AS DECIMAL(38,0)) * {w}" for score, w in weight_cols.items()]
    return F.expr(" + ".join(terms))


def scorecard(history: DataFrame, providers: DataFrame, weights=DEFAULT_WEIGHTS,
              on_zero_range: str = "null") -> DataFrame:
    """Provider ranking by weighted min-max scores.

    Scores are rounded before weighting; the rank orders by the unrounded
    weighted sum of the rounded scores, NULLs last.  All of it is exact
    integer arithmetic on the rounded means, as in the decimal SQL.
    """
    specs = (("cost_score", "avg_cost_per_kg", 4, False), ("reliability_score", "avg_on_time_pct", 2, True),
             ("lead_time_score", "avg_lead_days", 2, False))
    m = add_exact_scores(provider_metrics(history, providers), specs, on_zero_range)
    wu = {s: int(round(float(w) * 10 ** WEIGHT_SCALE)) for s, w in zip(SCORES, weights)}
    f = 10 ** WEIGHT_SCALE
    m = m.withColumn("_t", exact_weighted_units(wu))
    rounded = F.expr(f"sign(_t) * ((2 * abs(_t) + {f}) div {2 * f})").cast("double") / F.lit(100.0) + F.lit(0.0)
    return (m.select("provider_name", "avg_cost_per_kg", "avg_on_time_pct", "avg_lead_days", *SCORES,
                     rounded.alias("weighted_total_score"),
                     F.rank().over(Window.orderBy(F.col("_t").desc_nulls_last())).alias("final_rank"))
            .orderBy(F.col("weighted_total_score").desc_nulls_last()))


def measure_scores(v_scorecard: DataFrame, weights=DEFAULT_WEIGHTS, on_zero_range: str = "zero",
                   lanes: list[str] | None = None, with_means: bool = False) -> DataFrame:
    """DAX-style scores per provider over the view-1 rows.

    The provider value is the mean of its provider x lane rows (restricted
    to ``lanes`` when a slicer is given); the bounds are the min and max
    over *all* rows, ignoring the slicer (DAX ``ALL``).  Both come from one
    aggregation: per provider the mean plus its own min and max, then a
    one-row aggregate takes the min of the mins and the max of the maxes.
    """
    keep = F.col("lane").isin(list(lanes)) if lanes else F.lit(True)
    aggs = []
    for col, scale in (("avg_cost_per_kg", 4), ("avg_on_time_pct", 2), ("avg_lead_time_days", 2)):
        aggs += [mean_exact(F.when(keep, F.col(col)), scale).alias(col),
                 F.min(col).alias(f"_lo_{col}"), F.max(col).alias(f"_hi_{col}")]
    g = v_scorecard.groupBy("provider_name").agg(*aggs)
    bounds = {c: (f"_lo_{c}", f"_hi_{c}") for c in ("avg_cost_per_kg", "avg_on_time_pct", "avg_lead_time_days")}
    s = add_scores(g, "avg_cost_per_kg", "avg_on_time_pct", "avg_lead_time_days", on_zero_range, bounds)
    if lanes:  # the bounds above come from every row; providers without a chosen lane are not shown
        s = s.filter(F.col("avg_cost_per_kg").isNotNull() | F.col("avg_on_time_pct").isNotNull())
    means = ("avg_cost_per_kg", "avg_on_time_pct", "avg_lead_time_days") if with_means else ()
    return s.select("provider_name", *means, *SCORES, weighted(weights).alias("weighted_score"))


DEFAULT_GRID = (
    (0.40, 0.35, 0.25), (0.50, 0.30, 0.20), (0.30, 0.40, 0.30), (0.60, 0.20, 0.20),
    (0.20, 0.50, 0.30), (0.34, 0.33, 0.33), (0.45, 0.45, 0.10), (0.25, 0.25, 0.50),
    (0.50, 0.50, 0.00), (1.00, 0.00, 0.00),
)


def sensitivity(scores: DataFrame, grid=DEFAULT_GRID) -> DataFrame:
    """Weighted score and rank of every provider under each weight set (C20).

    The grid is an argument of known length; it is attached to each
    provider row by exploding a literal array, so the output has
    providers x len(grid) rows and no join is needed.  Totals are exact
    integers (2-place scores times weights in 10^-6), as in ``scorecard``.
    """
    sets = F.array(*[F.struct(F.lit(i + 1).alias("weight_set"), F.lit(float(a)).alias("w_cost"),
                              F.lit(float(b)).alias("w_reliability"), F.lit(float(c)).alias("w_lead_time"))
                     for i, (a, b, c) in enumerate(grid)])
    x = scores.select("provider_name", *SCORES, F.explode(sets).alias("_w")).select(
        "provider_name", *SCORES, "_w.*")
    for sc in SCORES:
        x = x.withColumn(f"_{sc}_u", _units(sc, 2))
    for wc in ("w_cost", "w_reliability", "w_lead_time"):
        x = x.withColumn(f"_{wc}_u", _units(wc, WEIGHT_SCALE))
    f = 10 ** WEIGHT_SCALE
    x = x.withColumn("_t", F.expr(" + ".join(
        f"CAST(_{sc}_u AS DECIMAL(38,0)) * _{wc}_u"
        for sc, wc in zip(SCORES, ("w_cost", "w_reliability", "w_lead_time")))))
    rounded = F.expr(f"sign(_t) * ((2 * abs(_t) + {f}) div {2 * f})").cast("double") / F.lit(100.0) + F.lit(0.0)
    w = Window.partitionBy("weight_set").orderBy(F.col("_t").desc_nulls_last())
    return x.select("weight_set", "w_cost", "w_reliability", "w_lead_time", "provider_name",
                    rounded.alias("weighted_score"),
                    F.rank().over(w).alias("score_rank"))
