import datetime as dt
import os
import tempfile
from decimal import Decimal

from conftest import D, d, make

from freightlens.model import ProcurementModel
from freightlens.sources.tables import read_view_csv, write_table


def _tables(spark, providers, routes):
    quotes = make(spark, "quotes", [
        {"quote_id": i, "provider_id": p, "route_id": 1, "weight_band_kg": "500-2000",
         "base_rate_eur_per_kg": D(r), "fuel_surcharge_pct": D("10.00"), "volume_discount_pct": D("5.00"),
         "min_shipment_kg": D("500"), "quote_source": "desk"}
        for i, (p, r) in enumerate([(1, "0.3000"), (2, "0.2800"), (3, "0.3100")])])
    ship = make(spark, "shipments", [
        {"shipment_id": i, "provider_id": 1 + i % 3, "route_id": 1 + i % 2, "shipment_date": d("2024-01-05"),
         "weight_kg": D("100"), "total_cost_eur": D("30.00"), "status": "Delayed" if i % 4 == 0 else "Delivered",
         "delay_reason": "Weather" if i % 4 == 0 else None, "customer_complaint": i % 5 == 0,
         "promised_delivery": d("2024-01-07"), "actual_delivery": d("2024-01-08")} for i in range(24)])
    hist = make(spark, "performance_history", [
        {"perf_id": i, "provider_id": p, "route_id": r, "month_year": dt.date(2024, m, 1), "total_shipments": 10,
         "on_time_count": 7 + (p + m) % 4, "avg_cost_per_kg": D("0.3") + D(p) / 100,
         "avg_lead_time_days": D("2.00") + D(r) / 10, "total_revenue_eur": D("100.00"), "sla_breached": False}
        for i, (p, r, m) in enumerate((p, r, m) for p in (1, 2, 3) for r in (1, 2) for m in (1, 2, 3, 4))])
    return {"providers": providers, "routes": routes, "quotes": quotes, "shipments": ship,
            "performance_history": hist}


def test_model_loads_typed_tables_and_runs_every_method(spark, providers, routes):
    base = tempfile.mkdtemp(prefix="fl-model-")
    for name, df in _tables(spark, providers, routes).items():
        write_table(df, os.path.join(base, name))
    m = ProcurementModel.load(spark, base)
    counts = {name: getattr(m, name)().count() for name in (
        "landed_rate", "on_time", "quote_spread", "volume_scenarios", "delay_pareto", "monthly_trend", "scorecard",
        "sla_alerts", "v_scorecard", "v_trend", "v_detail", "kpis", "measure_scores", "mom_change",
        "rolling_calendar", "potential_saving", "rag_status", "sensitivity", "report_summary", "report_radar",
        "report_trend", "lane_overview", "integrity", "roll_up_history")}
    assert counts["landed_rate"] == 3 and counts["scorecard"] == 3 and counts["sla_alerts"] == 6
    assert counts["v_detail"] == 24 and counts["sensitivity"] == 30 and counts["kpis"] == 1
    assert [r.provider_name for r in m.volume_scenarios().filter("scenario_label = '500kg scenario'")
            .orderBy("cost_rank").collect()] == ["Beta Logistics", "Alpha Freight", "Gamma Cargo"]
    pages = m.drill_through(["Alpha Freight"])
    assert pages["log"].count() == 8 and pages["delays"].count() >= 1
    vol = spark.createDataFrame([("Utrecht → Lyon", 1000.0)], "lane string, volume_kg double")
    assert m.lane_savings(vol).count() == 1
    m.register_sql()
    assert spark.sql("SELECT count(*) FROM check_sla_breach_alerts()").first()[0] == 6
    out = tempfile.mkdtemp(prefix="fl-export-")
    m.export_views(out)
    assert sorted(os.listdir(out)) == ["monthly_trend", "provider_scorecard", "shipment_detail"]


def test_sql_written_against_the_core_schema_runs(spark, providers, routes):
    t = _tables(spark, providers, routes)
    m = ProcurementModel(t["providers"], t["routes"], t["quotes"], t["shipments"], t["performance_history"])
    m.register_sql()
    worst = spark.sql("""
        SELECT route_id, year(shipment_date) AS y, max(datediff(actual_delivery, promised_delivery)) AS longest_delay, sum(weight_kg) AS kg
        FROM shipments WHERE status <> 'Delivered' GROUP BY ALL HAVING sum(weight_kg) > 0""").collect()
    late = [r for r in t["shipments"].collect() if r.status != "Delivered"]
    assert {(r.route_id, r.longest_delay, r.kg) for r in worst} == {
        (k, max((r.actual_delivery - r.promised_delivery).days for r in late if r.route_id == k), sum(r.weight_kg for r in late if r.route_id == k))
        for k in {r.route_id for r in late}}


def test_exported_views_read_back(spark, providers, routes):
    t = _tables(spark, providers, routes)
    m = ProcurementModel(t["providers"], t["routes"], t["quotes"], t["shipments"], t["performance_history"])
    out = tempfile.mkdtemp(prefix="fl-export-")
    m.export_views(out)
    for view, folder in (("v_scorecard", "provider_scorecard"), ("v_trend", "monthly_trend"), ("v_detail", "shipment_detail")):
        back = read_view_csv(spark, f"{out}/{folder}", view)
        want = getattr(m, view)()
        plain = lambda df: sorted(tuple(float(x) if isinstance(x, (Decimal, float)) else x for x in map(r.__getitem__, back.columns)) for r in df.collect())
        assert repr(plain(back)) == repr(plain(want))
    text = "".join(open(os.path.join(f"{out}/provider_scorecard", f)).read() for f in os.listdir(f"{out}/provider_scorecard") if f.endswith(".csv"))
    assert "0.3100" in text and ",2.10," in text


def test_model_loads_the_core_tables_from_csv(spark, providers, routes):
    base = tempfile.mkdtemp(prefix="fl-model-csv-")
    for name, df in _tables(spark, providers, routes).items():
        (df.write.option("header", True).option("nullValue", "NULL").mode("overwrite")
         .csv(os.path.join(base, name)))
    m = ProcurementModel.load(spark, base, fmt="csv")
    assert m.shipments.count() == 24 and dict(m.quotes.dtypes)["base_rate_eur_per_kg"] == "decimal(8,4)"
    assert m.scorecard().count() == 3 and m.sla_alerts().count() == 6
    assert sorted(r.provider_name for r in m.on_time().collect()) == sorted(
        r.provider_name for r in ProcurementModel(**{
            "providers": providers, "routes": routes, **{k: v for k, v in _tables(spark, providers, routes).items()
                                                         if k in ("quotes", "shipments")},
            "history": _tables(spark, providers, routes)["performance_history"]}).on_time().collect())
