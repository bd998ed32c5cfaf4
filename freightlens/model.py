"""The whole workload over the five core tables, in one object.

    model = ProcurementModel.load(spark, "/data/procurement")   # five parquet tables
    model.landed_rate().show()
    model.sla_alerts().show()
    model.export_views("/exports")                               # three CSV extracts

Every method returns a lazy DataFrame (exports excepted); the operators are
those of ``freightlens.operators`` with the reference's defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freightlens import operators as op
from freightlens.functions.labels import (
    ALERT_MARGIN,
    DEFAULT_ANNUAL_VOLUME_KG,
    DEFAULT_WEIGHTS,
    RAG_DEFAULT_AT_RISK,
    RAG_DEFAULT_GOOD,
)
from freightlens.sources.tables import read_table, write_view_csv

TABLES = ("providers", "routes", "quotes", "shipments", "performance_history")


class ProcurementModel:
    def __init__(self, providers: DataFrame, routes: DataFrame, quotes: DataFrame, shipments: DataFrame,
                 history: DataFrame):
        self.providers, self.routes, self.quotes = providers, routes, quotes
        self.shipments, self.history = shipments, history

    @classmethod
    def load(cls, spark: SparkSession, base: str, fmt: str = "parquet") -> ProcurementModel:
        """Typed scans of ``base/<table>`` for the five core tables."""
        t = {n: read_table(spark, f"{base.rstrip('/')}/{n}", n, fmt) for n in TABLES}
        return cls(t["providers"], t["routes"], t["quotes"], t["shipments"], t["performance_history"])

    # --- analytical queries (Q1-Q7) -------------------------------------
    def landed_rate(self) -> DataFrame:
        return op.landed_rate(self.quotes, self.providers, self.routes)

    def on_time(self) -> DataFrame:
        return op.on_time_rate(self.shipments, self.providers, self.routes)

    def quote_spread(self) -> DataFrame:
        return op.quote_spread(self.quotes, self.providers, self.routes)

    def volume_scenarios(self, **kw) -> DataFrame:
        return op.volume_scenarios(self.quotes, self.providers, self.routes, **kw)

    def delay_pareto(self) -> DataFrame:
        return op.delay_pareto(self.shipments)

    def monthly_trend(self) -> DataFrame:
        return op.monthly_trend(self.history, self.providers, self.routes)

    def scorecard(self, weights=DEFAULT_WEIGHTS, on_zero_range: str = "null") -> DataFrame:
        return op.scorecard(self.history, self.providers, weights, on_zero_range)

    # --- alert function and views ---------------------------------------
    def sla_alerts(self, window: int = 3, margin: float = ALERT_MARGIN) -> DataFrame:
        return op.sla_alerts(self.history, self.providers, self.routes, window, margin)

    def v_scorecard(self) -> DataFrame:
        return op.v_scorecard(self.history, self.providers, self.routes)

    def v_trend(self) -> DataFrame:
        return op.v_trend(self.history, self.providers, self.routes)

    def v_detail(self) -> DataFrame:
        return op.v_detail(self.shipments, self.providers, self.routes)

    def register_sql(self) -> None:
        """Temp views for the five core tables (under their own names), the
        three ``vw_*`` views and ``SELECT * FROM check_sla_breach_alerts()``,
        so SQL written against the original schema runs as Spark SQL."""
        for name, df in (("providers", self.providers), ("routes", self.routes), ("quotes", self.quotes),
                         ("shipments", self.shipments), ("performance_history", self.history)):
            df.createOrReplaceTempView(name)
        op.register_sql_surface(self.history, self.shipments, self.providers, self.routes)

    def export_views(self, out_dir: str) -> None:
        """The three CSV extracts, with header, ``NULL`` and CRLF."""
        base = out_dir.rstrip("/")
        write_view_csv(self.v_scorecard(), f"{base}/provider_scorecard", "v_scorecard")
        write_view_csv(self.v_trend(), f"{base}/monthly_trend", "v_trend")
        write_view_csv(self.v_detail(), f"{base}/shipment_detail", "v_detail")

    # --- report measures --------------------------------------------------
    def kpis(self, by=None, lanes=None) -> DataFrame:
        return op.kpis(self.v_scorecard(), by, lanes)

    def measure_scores(self, lanes=None) -> DataFrame:
        return op.measure_scores(self.v_scorecard(), lanes=lanes)

    def mom_change(self, by=None, blank_as_zero: bool = False) -> DataFrame:
        return op.mom_change(self.v_trend(), by, blank_as_zero)

    def rolling_calendar(self, months: int = 3, by=None) -> DataFrame:
        return op.rolling_calendar(self.v_trend(), months, by)

    def lane_savings(self, volumes: DataFrame, current: DataFrame | None = None) -> DataFrame:
        return op.lane_savings(self.v_scorecard(), volumes, current)

    def potential_saving(self, volume_kg: float = DEFAULT_ANNUAL_VOLUME_KG) -> DataFrame:
        return op.potential_saving(self.v_scorecard(), volume_kg)

    def rag_status(self, good: float = RAG_DEFAULT_GOOD, at_risk: float = RAG_DEFAULT_AT_RISK) -> DataFrame:
        return op.rag_status(self.v_scorecard(), good, at_risk)

    def sensitivity(self, grid=None) -> DataFrame:
        return op.sensitivity(self.scorecard(), grid) if grid else op.sensitivity(self.scorecard())

    # --- report pages -------------------------------------------------------
    def report_summary(self, lanes=None) -> DataFrame:
        return op.report_summary(self.v_scorecard(), lanes=lanes)

    def report_radar(self, lanes=None) -> DataFrame:
        return op.report_radar(self.measure_scores(lanes))

    def report_trend(self, lanes=None, provider_names=None) -> DataFrame:
        return op.report_trend(self.history, self.providers, self.routes, lanes, provider_names)

    def drill_through(self, providers=None) -> dict[str, DataFrame]:
        """Page-4 data for the chosen providers: log, status, delay Pareto, complaints."""
        vd = self.v_detail()
        return {"log": op.shipment_log(vd, providers), "status": op.status_breakdown(vd, providers),
                "delays": op.delay_pareto(op.drill_through(vd, providers)),
                "complaints": op.complaints(vd, providers)}

    def lane_overview(self) -> DataFrame:
        return op.lane_overview(self.v_scorecard(), self.shipments, self.v_trend(), self.providers, self.routes)

    def integrity(self) -> DataFrame:
        return op.integrity_report({"providers": self.providers, "routes": self.routes, "quotes": self.quotes,
                                    "shipments": self.shipments, "performance_history": self.history})

    def roll_up_history(self) -> DataFrame:
        """The monthly history re-derived from the shipments."""
        return op.roll_up_history(self.shipments, self.providers)
