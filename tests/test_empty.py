"""Every operator accepts empty inputs and returns an empty (or all-zero) result."""

from conftest import make

from freightlens import operators as op
from freightlens.model import ProcurementModel


def test_operators_on_empty_tables(spark, providers, routes):
    empty = {t: make(spark, t, []) for t in ("quotes", "shipments", "performance_history")}
    m = ProcurementModel(providers, routes, empty["quotes"], empty["shipments"], empty["performance_history"])
    for name in ("landed_rate", "on_time", "quote_spread", "volume_scenarios", "delay_pareto", "monthly_trend",
                 "scorecard", "sla_alerts", "v_scorecard", "v_trend", "v_detail", "measure_scores", "mom_change",
                 "rolling_calendar", "rag_status", "sensitivity", "report_summary", "report_radar", "report_trend",
                 "lane_overview", "roll_up_history"):
        assert getattr(m, name)().count() == 0, name
    k = m.kpis().first()
    assert k.total_shipments is None and k.avg_otd_pct is None
    assert m.potential_saving().first().potential_annual_saving is None
    got = {(r.check_name, r.column_name): r.violations for r in m.integrity().collect()}
    assert set(got.values()) == {0}
    assert op.dim_values("lane", m.v_scorecard(), m.v_detail()).count() == 0
