"""Registered queries over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the whole tables.  DECIMAL results are returned as DOUBLE so that the
result types match the DuckDB oracle in ``freightlens.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from freightlens import operators as op
from freightlens.functions.labels import lane_label
from freightlens.functions.numeric import from_units, sum_units
from freightlens.plans.joins import join_dims
from freightlens.operators import history_store
from freightlens.plans.materialize import app_folder, write_checkpoint_table
from freightlens.plans.ranking import range_rank
from freightlens.plans.sizing import BUILD_CONF, BUILD_PARTITION_BYTES, input_bytes, partitions_for, scaled_shuffle
from freightlens.sources import testdata as td

# Parameters of the registered queries (chosen for the test data, where the
# on-time rate is about two thirds).
RAG_GOOD, RAG_AT_RISK = 67.0, 65.0
# Shipment sizes of the test data run from 1 to 50 units; the derived rate
# card has bands 0-15, 15-35 and 35+, so 15 and 40 exercise both branches.
SCENARIOS = dict(scenarios=((15, "15kg scenario"), (40, "40kg scenario")), boundary=35,
                 band_at_or_below="15-35", band_above="35+")


# Slicer choices of the sliced report queries.
LANES = ("ASIA → EUROPE", "EUROPE → ASIA", "EUROPE → AMERICA", "AFRICA → AFRICA")
PROVIDERS = ("NATION_2", "NATION_3", "NATION_8")
MONTHS = tuple(dt.date(1996, m, 1) for m in (1, 2, 3))
# On-time share that the chosen providers miss in some months of the test data.
MISSED_SHARE = 65.0
# First day of the shipments that the stored history gets later.
NEW_FROM = "1998-01-01"
# The derived tables have no surrogate keys.
KEYS = {"quotes": ("provider_id", "route_id", "weight_band_kg"), "performance_history": ("provider_id", "route_id", "month_year")}


class Inputs:
    """Core tables for one test-data folder.

    With ``materialize`` the shipment facts (the result of the
    fact-to-fact joins), the monthly history, the rate card and the two
    dimensions are written once as parquet into ``spark.checkpoint.dir`` and
    every query scans them: the joins run once per application instead of
    once per query, and the lineage of each query starts at a parquet scan.
    The source tables are treated as immutable while the application runs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, build, store: bool = False, keep: bool = False, partition_by: list[str] | None = None):
        if name not in self._cache:
            df = build()
            if store and self.materialize:
                df = write_checkpoint_table(df, name, partition_by)
                if keep:  # small tables: keep in memory, re-read from the parquet if lost
                    df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._cache[name] = df
        return self._cache[name]

    @property
    def providers(self):
        return self._get("providers", lambda: td.providers(self.spark, self.sf_dir), store=True, keep=True)

    @property
    def routes(self):
        return self._get("routes", lambda: td.routes_from_facts(self.facts, self.spark, self.sf_dir), store=True, keep=True)

    @property
    def facts(self):
        def build():
            return td.shipment_facts(self.spark, self.sf_dir)

        if "facts" in self._cache or not self.materialize:
            return self._get("facts", build, store=True)
        # The build shuffles whole fact tables: size the partitions from the input.
        paths = [f"{self.sf_dir.rstrip('/')}/{t}.parquet" for t in td.FACT_SOURCES]
        with scaled_shuffle(self.spark, paths, BUILD_PARTITION_BYTES, BUILD_CONF):
            return self._get("facts", build, store=True, partition_by=[td.MONTH])

    @property
    def stored_sources(self):
        """Lines and orders bucketed by order."""
        if "stored_sources" not in self._cache:
            paths = [f"{self.sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders")]
            with scaled_shuffle(self.spark, paths) as buckets:
                self._cache["stored_sources"] = td.bucketed_sources(self.spark, self.sf_dir, buckets)
        return self._cache["stored_sources"]

    def shipments_in(self, months):
        """The shipments of some months, read from those months' partitions."""
        return td.shipments_from_facts(td.facts_in_months(self.facts, months))

    @property
    def shipments(self):
        return self._get("shipments", lambda: td.shipments_from_facts(self.facts))

    @property
    def typed_shipments(self):
        """The shipments with ``commodity_type``, for the query that returns it."""
        return td.shipments_from_facts(td.with_part_type(self.facts, self.spark, self.sf_dir))

    @property
    def line_partitions(self) -> int:
        """Partitions for a shuffle of one key per shipment."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")),
                   partitions_for(input_bytes(self.spark, [f"{self.sf_dir.rstrip('/')}/lineitem.parquet"])))

    @property
    def quotes(self):
        return self._get("quotes", lambda: td.quotes_from_facts(self.facts), store=True, keep=True)

    @property
    def history(self):
        return self._get("history", lambda: op.roll_up_history(self.shipments, self.providers,
                                                               lead_days=td.lead_time_days()), store=True,
                         keep=True)

    @property
    def v_scorecard(self):
        return self._get("v_scorecard", lambda: op.v_scorecard(self.history, self.providers, self.routes))

    @property
    def v_trend(self):
        return self._get("v_trend", lambda: op.v_trend(self.history, self.providers, self.routes))

    @property
    def v_detail(self):
        return self._get("v_detail", lambda: op.v_detail(self.shipments, self.providers, self.routes))


_INPUTS: dict[tuple[str, str], Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The application's ``Inputs`` for ``sf_dir`` (built on first use)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _INPUTS:
        _INPUTS[key] = Inputs(spark, sf_dir)
    return _INPUTS[key]


def finish(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (the oracle's type for them)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _q(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(build(inputs(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _lane_volumes(i: Inputs) -> DataFrame:
    """Shipped weight per lane: aggregated by ids first, then labelled."""
    by_ids = i.shipments.groupBy("provider_id", "route_id").agg(sum_units("weight_kg").alias("_w"))
    j = join_dims(by_ids, i.providers, i.routes).withColumn("lane", lane_label())
    return j.groupBy("lane").agg(from_units(F.sum("_w")).cast("double").alias("volume_kg"))


def _worst_shipments(i: Inputs) -> DataFrame:
    """Shipments of the providers ranked last by the weighted scorecard (the
    drill-through target), chosen by id before any dimension is joined."""
    s = op.scorecard(i.history, i.providers)
    worst = s.join(s.agg(F.max("final_rank").alias("final_rank")), "final_rank", "left_semi").select("provider_name")
    ids = i.providers.join(worst, "provider_name", "left_semi").select("provider_id")
    return i.shipments.join(ids, "provider_id", "left_semi")


def _known_shipments(i: Inputs) -> DataFrame:
    """Shipments of ``PROVIDERS`` with a known route, as in the detail view."""
    ids = i.providers.where(F.col("provider_name").isin(*PROVIDERS)).select("provider_id")
    return i.shipments.join(ids, "provider_id", "left_semi").join(i.routes.select("route_id"), "route_id", "left_semi")


def _kept_up_to_date(i: Inputs) -> DataFrame:
    """The monthly history of a store built from the shipments before ``NEW_FROM``, to which the later ones are added."""
    path = f"{app_folder(i.spark)}/history-store-{uuid.uuid4().hex}"
    new = F.coalesce(F.col("shipment_date") >= F.lit(NEW_FROM).cast("date"), F.lit(False))
    history_store.create(i.shipments.where(~new), path, lead_days=td.lead_time_days())
    history_store.add(i.shipments.where(new), path, "new", lead_days=td.lead_time_days())
    return history_store.history(i.spark, path, i.providers)


def _order_punctuality(i: Inputs) -> DataFrame:
    """Per order priority: orders with lines, those delivered whole on time, and
    their lines; lines are grouped by order and joined with the orders in place."""
    lines, orders = i.stored_sources
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") != "R").alias("on_time"))
    j = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("n") == F.col("on_time")).alias("whole_orders_on_time"),
                                            F.sum("n").alias("lines"), F.sum("on_time").alias("lines_on_time"))


def _integrity(i: Inputs) -> DataFrame:
    tables = {"providers": i.providers, "routes": i.routes, "quotes": i.quotes, "shipments": i.shipments, "performance_history": i.history}
    return op.integrity_report(tables, KEYS, {"shipments": i.line_partitions})


def _query_table() -> dict[str, Callable[[Inputs], DataFrame]]:
    return {
        "landed_rate": lambda i: op.landed_rate(i.quotes, i.providers, i.routes),
        "on_time": lambda i: op.on_time_rate(i.shipments, i.providers, i.routes),
        "quote_spread": lambda i: op.quote_spread(i.quotes, i.providers, i.routes),
        "volume_scenarios": lambda i: op.volume_scenarios(i.quotes, i.providers, i.routes, **SCENARIOS, rank=range_rank),
        "delay_pareto": lambda i: op.delay_pareto(i.shipments),
        "monthly_rollup": lambda i: op.roll_up_history(i.shipments, i.providers, lead_days=td.lead_time_days()),
        "monthly_trend": lambda i: op.monthly_trend(i.history, i.providers, i.routes),
        "scorecard": lambda i: op.scorecard(i.history, i.providers),
        "sla_alerts": lambda i: op.sla_alerts(i.history, i.providers, i.routes),
        "rolling_on_time": lambda i: op.rolling_on_time(i.history, i.providers, i.routes),
        "v_scorecard": lambda i: i.v_scorecard,
        "v_trend": lambda i: i.v_trend,
        "v_detail": lambda i: op.v_detail(i.typed_shipments, i.providers, i.routes),
        "kpi_cards": lambda i: op.kpis(i.v_scorecard),
        "measure_scores": lambda i: op.measure_scores(i.v_scorecard),
        "mom_change": lambda i: op.mom_change(i.v_trend),
        "rolling_calendar": lambda i: op.rolling_calendar(i.v_trend),
        "lane_savings": lambda i: op.lane_savings(i.v_scorecard, _lane_volumes(i)),
        "lane_savings_total": lambda i: op.lane_savings_total(op.lane_savings(i.v_scorecard, _lane_volumes(i))),
        "potential_saving": lambda i: op.potential_saving(i.v_scorecard),
        "rag_status": lambda i: op.rag_status(i.v_scorecard, RAG_GOOD, RAG_AT_RISK),
        "sensitivity": lambda i: op.sensitivity(op.scorecard(i.history, i.providers)),
        "report_summary": lambda i: op.report_summary(i.v_scorecard, good=RAG_GOOD, at_risk=RAG_AT_RISK),
        "report_radar": lambda i: op.report_radar(op.measure_scores(i.v_scorecard)),
        "report_trend": lambda i: op.report_trend(i.history, i.providers, i.routes),
        "shipment_log": lambda i: op.shipment_log(op.v_detail(_worst_shipments(i), i.providers, i.routes)),
        "status_breakdown": lambda i: op.status_by_provider(i.shipments, i.providers, i.routes),
        "complaints": lambda i: op.complaints_by_provider(i.shipments, i.providers, i.routes),
        "lane_overview": lambda i: op.lane_overview(i.v_scorecard, i.shipments, i.v_trend, i.providers, i.routes),
        "dim_provider": lambda i: op.dim_values("provider_name", i.v_scorecard, i.v_trend,
                                                i.v_detail),
        "dim_lane": lambda i: op.dim_values("lane", i.v_scorecard, i.v_trend, i.v_detail),
        "integrity": _integrity,
        "ranked_quotes": lambda i: op.ranked_quotes(i.quotes, i.providers, i.routes, rank=range_rank),
        "kpi_cards_sliced": lambda i: op.kpis(i.v_scorecard, lanes=LANES),
        "report_summary_sliced": lambda i: op.report_summary(i.v_scorecard, lanes=LANES, good=RAG_GOOD, at_risk=RAG_AT_RISK),
        "report_radar_sliced": lambda i: op.report_radar(op.measure_scores(i.v_scorecard, lanes=LANES)),
        "report_trend_sliced": lambda i: op.report_trend(i.history, i.providers, i.routes, LANES, PROVIDERS),
        "status_in_months": lambda i: op.status_by_provider(i.shipments_in(MONTHS), i.providers, i.routes),
        "complaints_in_missed_months": lambda i: op.complaints_by_provider(i.shipments_in(op.missed_months(i.history, i.providers, PROVIDERS, MISSED_SHARE)),
                                                                           i.providers, i.routes),
        "rollup_kept_up_to_date": _kept_up_to_date,
        "order_punctuality": _order_punctuality,
        "delay_pareto_drilled": lambda i: op.delay_pareto(_known_shipments(i)),
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(build) for name, build in _query_table().items()}
