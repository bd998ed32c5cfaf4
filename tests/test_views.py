import datetime as dt

from conftest import D, d, make

from freightlens.operators import register_views, roll_up_history, v_detail, v_scorecard, v_trend


def _ship(spark):
    return make(spark, "shipments", [
        {"shipment_id": 1, "provider_id": 1, "route_id": 1, "shipment_date": d("2024-03-01"), "weight_kg": D("0"),
         "total_cost_eur": D("10.00"), "promised_delivery": d("2024-03-03"), "actual_delivery": d("2024-03-05"),
         "status": "Delayed", "delay_reason": "Customs"},
        {"shipment_id": 2, "provider_id": 2, "route_id": 1, "shipment_date": d("2024-03-02"),
         "weight_kg": D("550.00"), "total_cost_eur": D("193.05"), "promised_delivery": d("2024-03-04"),
         "actual_delivery": d("2024-03-03"), "status": "Delivered"},
    ])


def test_v_detail_delay_days_and_cost_per_kg(spark, providers, routes):
    got = {r.shipment_id: r for r in v_detail(_ship(spark), providers, routes).collect()}
    assert got[1].delay_days == 2 and got[1].actual_cost_per_kg is None
    assert got[2].delay_days == -1 and got[2].actual_cost_per_kg == 0.351
    assert got[2].lane == "Utrecht → Lyon"


def test_v_scorecard_sums_the_stored_breach_flag(spark, providers, routes):
    h = make(spark, "performance_history", [
        {"perf_id": i, "provider_id": 1, "route_id": 1, "month_year": dt.date(2024, m, 1), "total_shipments": 10,
         "on_time_count": o, "avg_cost_per_kg": D(c), "avg_lead_time_days": D("2.00"),
         "total_revenue_eur": D("100.50"), "sla_breached": b}
        for i, (m, o, c, b) in enumerate([(1, 5, "0.3000", False), (2, 10, "0.3001", True), (3, 7, "0.3003", None)])])
    r = v_scorecard(h, providers, routes).first()
    assert (r.total_shipments_ytd, r.total_spend_eur, r.sla_breach_months) == (30, D("301.50"), 1)
    assert (r.avg_cost_per_kg, r.avg_on_time_pct) == (0.3001, 73.33)
    t = v_trend(h, providers, routes).orderBy("month_year").collect()
    assert t[0].month == "2024-01" and t[2].on_time_pct == D("70.00000")


def test_v_trend_keeps_the_percentage_at_five_places(spark, providers, routes):
    h = make(spark, "performance_history", [
        {"perf_id": 1, "provider_id": 1, "route_id": 1, "month_year": dt.date(2024, 1, 1), "total_shipments": 9,
         "on_time_count": 7},
        {"perf_id": 2, "provider_id": 1, "route_id": 1, "month_year": dt.date(2024, 2, 1), "total_shipments": 0,
         "on_time_count": 0}])
    got = [r.on_time_pct for r in v_trend(h, providers, routes).orderBy("month_year").collect()]
    assert got == [D("77.77778"), None]


def test_register_views(spark, providers, routes):
    s = _ship(spark)
    register_views(roll_up_history(s, providers), s, providers, routes)
    assert spark.sql("SELECT count(*) FROM vw_shipment_detail").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM vw_monthly_trend").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM vw_provider_scorecard").first()[0] == 2


def test_v_scorecard_rounds_a_tied_mean_like_decimal_avg(spark, providers, routes):
    h = make(spark, "performance_history", [
        {"perf_id": i, "provider_id": 1, "route_id": 1, "month_year": dt.date(2024, 1 + i, 1), "total_shipments": 10,
         "on_time_count": 9, "avg_cost_per_kg": D(c), "avg_lead_time_days": D(lt), "total_revenue_eur": D("1.00"),
         "sla_breached": False}
        for i, (c, lt) in enumerate([("0.2537", "2.01"), ("0.2538", "2.02")])])
    r = v_scorecard(h, providers, routes).first()
    assert (r.avg_cost_per_kg, r.avg_lead_time_days) == (0.2538, 2.02)   # 0.25375 and 2.015, half up
