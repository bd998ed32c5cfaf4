"""Report data sets (C21-C24), conformed dimensions (S11) and the
integrity report (S10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.labels import (
    DEFAULT_WEIGHTS,
    RAG_DEFAULT_AT_RISK,
    RAG_DEFAULT_GOOD,
    SCORE_CATEGORIES,
    lane_label,
    month_label,
)
from freightlens.functions.numeric import (
    PCT_SCALE,
    from_units,
    mean_exact,
    mean_half_up,
    mean_parts,
    pct_decimal,
    round_half_up,
    sum_units,
)
from freightlens.operators.measures import rag
from freightlens.operators.scoring import SCORES, measure_scores
from freightlens.plans.joins import join_dims


def report_summary(v_scorecard: DataFrame, weights=DEFAULT_WEIGHTS, lanes: list[str] | None = None,
                   good: float = RAG_DEFAULT_GOOD, at_risk: float = RAG_DEFAULT_AT_RISK) -> DataFrame:
    """Provider summary table: cost, on-time %, lead time, score, rank, flag."""
    return measure_scores(v_scorecard, weights, "zero", lanes, with_means=True).select("provider_name",
                    round_half_up("avg_cost_per_kg", 4).alias("avg_cost_per_kg"),
                    round_half_up("avg_on_time_pct", 2).alias("avg_on_time_pct"),
                    round_half_up("avg_lead_time_days", 2).alias("avg_lead_time_days"),
                    round_half_up("weighted_score", 2).alias("weighted_score"),
                    F.rank().over(Window.orderBy(F.col("weighted_score").desc_nulls_last())).alias("score_rank"),
                    rag("avg_on_time_pct", good, at_risk).alias("sla_status"))


def report_radar(scores: DataFrame) -> DataFrame:
    """One row per provider and score category, for a radar chart."""
    renamed = scores.select("provider_name", *[F.col(s).alias(c) for s, c in zip(SCORES, SCORE_CATEGORIES)])
    return renamed.unpivot("provider_name", list(SCORE_CATEGORIES), "category", "score")


def slice_by(df: DataFrame, lanes: list[str] | None = None, providers: list[str] | None = None) -> DataFrame:
    """Report slicers (P11): keep the chosen lanes and/or providers."""
    if lanes:
        df = df.filter(F.col("lane").isin(list(lanes)))
    if providers:
        df = df.filter(F.col("provider_name").isin(list(providers)))
    return df


def report_trend(history: DataFrame, providers: DataFrame, routes: DataFrame,
                 lanes: list[str] | None = None, provider_names: list[str] | None = None) -> DataFrame:
    """On-time %, cost per kg and shipment volume per month x provider, with
    the provider's SLA line (C23).  Volume is ``total_shipments`` of the
    history; optional lane and provider slicers filter the rows first."""
    h = history
    if provider_names:
        ids = providers.filter(F.col("provider_name").isin(list(provider_names))).select("provider_id")
        h = h.join(ids, "provider_id", "left_semi")
    if lanes:
        h = join_dims(h, routes=routes).filter(lane_label().isin(list(lanes)))
    g = h.groupBy("provider_id", "month_year").agg(
        *mean_parts(pct_decimal("on_time_count", "total_shipments"), PCT_SCALE, "otd"),
        mean_exact("avg_cost_per_kg", 4).alias("_cost"),
        F.sum("total_shipments").alias("shipments"))
    j = join_dims(g, providers.select("provider_id", "provider_name", "sla_threshold"))
    return j.select(month_label().alias("month"), "month_year", "provider_name",
                    mean_half_up("otd", PCT_SCALE, 2).alias("avg_on_time_pct"),
                    round_half_up("_cost", 4).alias("avg_cost_per_kg"),
                    "shipments", "sla_threshold")


def drill_through(v_detail: DataFrame, providers: DataFrame | list[str] | None = None) -> DataFrame:
    """Restrict the shipment detail to the chosen providers.

    ``providers`` may be a list of names or a DataFrame with a
    ``provider_name`` column (a left-semi join; broadcast when small).
    """
    if providers is None:
        return v_detail
    if isinstance(providers, DataFrame):
        return v_detail.join(providers.select("provider_name"), "provider_name", "left_semi")
    return v_detail.filter(F.col("provider_name").isin(list(providers)))


def shipment_log(v_detail: DataFrame, providers=None) -> DataFrame:
    """Drill-through shipment log."""
    return drill_through(v_detail, providers).select(
        "shipment_date", "provider_name", "lane", "weight_kg", "status", "delay_days", "total_cost_eur",
        "customer_complaint")


def status_breakdown(v_detail: DataFrame, providers=None) -> DataFrame:
    """Shipments per provider and status, for the donut chart."""
    return drill_through(v_detail, providers).groupBy("provider_name", "status").agg(
        F.count(F.lit(1)).alias("shipments"))


def complaints(v_detail: DataFrame, providers=None) -> DataFrame:
    """Customer complaint count per provider."""
    return drill_through(v_detail, providers).groupBy("provider_name").agg(
        F.count_if(F.col("customer_complaint")).alias("complaints"))


def _counts_by_ids(shipments: DataFrame, *more: str) -> DataFrame:
    """Counts and exact sums per provider and route id (and ``more`` columns):
    labels are attached to these few rows, not to the shipments."""
    delay = F.datediff("actual_delivery", "promised_delivery")
    return shipments.groupBy("provider_id", "route_id", *more).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count_if(F.col("status") == "Delayed").alias("delayed"),
        F.count_if(F.col("customer_complaint")).alias("complaints"),
        F.sum(delay).alias("_days"), F.count(delay).alias("_known"), sum_units("total_cost_eur").alias("_spend_c"))


def status_by_provider(shipments: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """``status_breakdown`` of all shipments, counted by ids before labelling."""
    j = join_dims(_counts_by_ids(shipments, "status"), providers.select("provider_id", "provider_name"), routes.select("route_id"))
    return j.groupBy("provider_name", "status").agg(F.sum("shipments").alias("shipments"))


def complaints_by_provider(shipments: DataFrame, providers: DataFrame, routes: DataFrame) -> DataFrame:
    """``complaints`` over all shipments, counted by ids before labelling."""
    j = join_dims(_counts_by_ids(shipments), providers.select("provider_id", "provider_name"), routes.select("route_id"))
    return j.groupBy("provider_name").agg(F.sum("complaints").alias("complaints"))


def missed_months(history: DataFrame, providers: DataFrame, provider_names: list[str], share: float) -> DataFrame:
    """``ship_month``: the months in which the chosen providers together
    delivered less than ``share`` percent on time."""
    ids = providers.where(F.col("provider_name").isin(list(provider_names))).select("provider_id")
    g = history.join(ids, "provider_id", "left_semi").groupBy(F.col("month_year").alias("ship_month")).agg(
        F.sum("on_time_count").alias("_on"), F.sum("total_shipments").alias("_all"))
    return g.where(100 * F.col("_on") < F.lit(float(share)) * F.col("_all")).select("ship_month")


def lane_overview(v_scorecard: DataFrame, shipments: DataFrame, v_trend: DataFrame, providers: DataFrame,
                  routes: DataFrame) -> DataFrame:
    """One row per provider x lane combining the three facts.

    The facts meet only through the conformed keys (provider name, lane).
    Each is first aggregated to that grain (the shipments by ids before they
    are labelled), so joining them cannot fan out, and the full outer joins
    keep a pair that appears in one fact only.
    """
    card = v_scorecard.select("provider_name", "lane", "avg_cost_per_kg", "avg_on_time_pct")
    det = join_dims(_counts_by_ids(shipments), providers, routes).groupBy("provider_name", lane_label().alias("lane")).agg(
        *[F.sum(c).alias(c) for c in ("shipments", "delayed", "complaints")],
        round_half_up(F.sum("_days").cast("double") / F.nullif(F.sum("_known").cast("double"), F.lit(0.0)), 2).alias("avg_delay_days"),
        F.sum("_spend_c").alias("_spend_c"))
    tr = v_trend.groupBy("provider_name", "lane").agg(
        F.count(F.lit(1)).alias("months"), F.min("month_year").alias("first_month"),
        F.max("month_year").alias("last_month"))
    det = det.withColumn("spend_eur", from_units("_spend_c")).drop("_spend_c")
    keys = ["provider_name", "lane"]
    return card.join(det, keys, "full").join(tr, keys, "full")


def dim_values(col: str, *facts: DataFrame) -> DataFrame:
    """Conformed dimension from the facts (S11): distinct values of ``col``
    across all given DataFrames, each pre-aggregated before the union."""
    parts = [f.select(col).distinct() for f in facts]
    return reduce(DataFrame.union, parts).distinct()


# Keys and required columns of the core tables (fixed values of the schema).
PRIMARY_KEYS = {"providers": ("provider_id",), "routes": ("route_id",), "quotes": ("quote_id",), "shipments": ("shipment_id",),
                "performance_history": ("perf_id",)}
REQUIRED = {"providers": ("provider_name",), "routes": ("origin_city", "origin_country", "dest_city", "dest_country"),
            "shipments": ("shipment_date",)}
REFERENCES = {"provider_id": "providers", "route_id": "routes"}


def _key_rows(df: DataFrame, key: list[str], partitions: int | None) -> DataFrame:
    """One row, ``dups``: rows beyond the first of each key without a NULL."""
    known = df.select(*key).dropna()
    if partitions:
        known = known.repartition(partitions, *key)
    return known.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.sum("n").alias("dups"))


def integrity_report(tables: dict[str, DataFrame], keys: dict[str, tuple[str, ...]] | None = None,
                     partitions: dict[str, int] | int | None = None) -> DataFrame:
    """Violations of the constraints of the core tables as rows (S10):
    ``table_name, check_name, column_name, violations``.

    ``null``: primary keys and required columns; ``duplicate``: rows beyond the
    first of a primary key (``keys`` replaces the schema's); ``orphan``: foreign
    keys without a row in ``providers`` or ``routes``.  A NULL foreign key is
    allowed.  Constraints on columns that a table does not have are not checked.

    A table is read once: grouping sets give the rows per key and, per pair of
    foreign keys, the rows and NULLs.  The pairs of all tables together meet
    the two parent tables once.  ``partitions`` names tables (a number: all)
    whose single keys are to be dealt to so many tasks; their keys are counted
    in a pass of their own, which reads the key alone.
    """
    keys = {**PRIMARY_KEYS, **(keys or {})}
    partitions = dict.fromkeys(tables, partitions) if isinstance(partitions, int) else partitions or {}
    parents = {c: t for c, t in REFERENCES.items() if t in tables}
    checks, parts = [], []
    for name, df in tables.items():
        key = [c for c in keys[name] if c in df.columns]
        whole = bool(key) and len(key) == len(keys[name])
        needed = list(dict.fromkeys(c for c in (*key, *REQUIRED.get(name, ())) if c in df.columns))
        foreign = [c for c, t in parents.items() if c in df.columns and t != name]
        checks += [(name, "null", c) for c in needed] + [(name, "duplicate", ",".join(key))] * whole + [(name, "orphan", c) for c in foreign]
        own = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], *[F.col(c).alias(f"_f{c}") for c in foreign],
                        *[F.col(c).isNull().alias(f"_n{c}") for c in needed])
        k, f = [F.col(f"_k{i}") for i in range(len(key))], [F.col(f"_f{c}") for c in foreign]
        apart = whole and name in partitions
        sets = [f] + ([k] if whole and not apart else [])
        groups = own.groupingSets(sets, *f, *(k if len(sets) > 1 else [])).agg(
            F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n"), *[F.count_if(f"_n{c}").alias(f"_n{c}") for c in needed]) if f or len(sets) > 1 else own.agg(
            F.lit(0).alias("_g"), F.count(F.lit(1)).alias("n"), *[F.count_if(f"_n{c}").alias(f"_n{c}") for c in needed])
        # the pairs' set lacks the key columns (the lowest bits), the keys' set has them
        pairs = F.col("_g") == (2 ** len(k) - 1 if len(sets) > 1 else 0)
        present = reduce(lambda a, b: a & b, [c.isNotNull() for c in k], F.lit(True))
        dups = F.sum(F.when(~pairs & present, F.col("n") - 1)) if len(sets) > 1 else F.lit(None).cast("long")
        small = groups.groupBy(*[c.alias(f"of_{x}") for c, x in zip(f, foreign, strict=True)]).agg(
            F.sum(F.when(pairs, F.col("n"))).alias("n"), dups.alias("dups"), *[F.sum(F.when(pairs, F.col(f"_n{c}"))).alias(f"null_{c}") for c in needed])
        parts.append(small.withColumn("t", F.lit(name)))
        if apart:
            parts.append(_key_rows(df, key, partitions[name]).withColumn("t", F.lit(name)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for c, t in parents.items():
        if f"of_{c}" in rows.columns:
            rows = rows.join(tables[t].select(F.col(c).alias(f"of_{c}"), F.lit(True).alias(f"known_{c}")).distinct(), f"of_{c}", "left")

    def violations(name: str, check: str, c: str) -> Column:
        if check == "orphan":
            n = F.when(F.col(f"of_{c}").isNotNull() & F.col(f"known_{c}").isNull(), F.col("n"))
        else:
            n = F.col("dups" if check == "duplicate" else f"null_{c}")
        return F.coalesce(F.sum(F.when(F.col("t") == name, n)), F.lit(0))

    found = rows.agg(*[violations(*x).cast("bigint").alias(f"v{i}") for i, x in enumerate(checks)])
    listed = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(k).alias("check_name"), F.lit(c).alias("column_name"), F.col(f"v{i}").alias("violations"))
                       for i, (t, k, c) in enumerate(checks)])
    return found.select(F.inline(listed))
