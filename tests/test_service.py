import datetime as dt

from conftest import D, d, make, rows

from freightlens.operators import delay_pareto, monthly_trend, on_time_rate, roll_up_history


def _shipments(spark):
    s = [  # id, provider, route, date, weight, cost, status, reason, complaint
        (1, 1, 1, "2024-01-03", "100", "40.00", "Delivered", None, False),
        (2, 1, 1, "2024-01-10", "200", "70.00", "Delivered", None, True),
        (3, 1, 1, "2024-02-02", "100", "45.00", "Delivered", None, False),
        (4, 1, 1, "2024-02-05", "300", "99.00", "Delayed", "Weather", True),
        (5, 1, 1, "2024-02-07", "50", "20.00", "Lost", None, False),
        (6, 2, 1, "2024-01-04", "100", "30.00", "Delivered", None, False),
        (7, 2, 1, "2024-01-05", "100", "30.00", "Delivered", None, False),
        (8, 2, 1, "2024-01-06", "100", "30.00", "Delivered", None, False),
        (9, 2, 1, "2024-01-07", "100", "30.00", "Delivered", None, False),
        (10, 1, 2, "2024-01-08", "100", "50.00", "Delayed", "No Delay", False),
        (11, 1, 2, "2024-01-09", "0", "10.00", "Damaged", None, None),
        (12, 9, 1, "2024-01-09", "100", "10.00", "Delivered", None, False),
        (13, 2, None, "2024-01-09", "100", "10.00", "Delivered", None, False),
    ]
    return make(spark, "shipments", [
        {"shipment_id": i, "provider_id": p, "route_id": r, "shipment_date": d(sd), "weight_kg": D(w),
         "total_cost_eur": D(c), "status": st, "delay_reason": why, "customer_complaint": cc,
         "promised_delivery": d(sd), "actual_delivery": d(sd) + dt.timedelta(days=i % 3)}
        for i, p, r, sd, w, c, st, why, cc in s])


def test_on_time_rate_counts_lost_and_damaged_in_total_only(spark, providers, routes):
    out = on_time_rate(_shipments(spark), providers, routes)
    got = sorted(rows(out, "provider_name", "lane", "total_shipments", "on_time", "delayed", "on_time_pct",
                      "sla_status"))
    assert got == [
        ("Alpha Freight", "Groningen → Bremen", 2, 0, 1, 0.0, "🚨 SLA Breached"),
        ("Alpha Freight", "Utrecht → Lyon", 5, 3, 1, 60.0, "🚨 SLA Breached"),
        ("Beta Logistics", "Utrecht → Lyon", 4, 4, 0, 100.0, "✅ SLA Met"),
    ]


def test_on_time_rate_merges_equal_lane_labels(spark, providers):
    twin = make(spark, "routes", [
        {"route_id": 1, "origin_city": "A", "origin_country": "X", "dest_city": "B", "dest_country": "Y"},
        {"route_id": 2, "origin_city": "A", "origin_country": "X", "dest_city": "B", "dest_country": "Y"}])
    out = on_time_rate(_shipments(spark), providers, twin)
    alpha = [r for r in out.collect() if r.provider_name == "Alpha Freight"]
    assert [(r.lane, r.total_shipments, r.on_time) for r in alpha] == [("A → B", 7, 3)]


def test_delay_pareto_keeps_null_and_literal_label_apart(spark):
    out = delay_pareto(_shipments(spark))
    got = sorted(rows(out, "delay_reason", "frequency", "pct_of_total", "complaints"))
    assert got == [("No Delay", 1, 7.69, 0), ("No Delay", 11, 84.62, 1), ("Weather", 1, 7.69, 1)]
    assert sum(r[2] for r in got) == 100.0
    total = {r.frequency: r.total_freight_affected_eur for r in out.collect()}
    assert total[11] == D("325.00")


def test_roll_up_history(spark, providers):
    h = roll_up_history(_shipments(spark), providers)
    got = {(r.provider_id, r.route_id, r.month_year): r for r in h.collect()}
    jan = got[(1, 1, dt.date(2024, 1, 1))]
    assert (jan.total_shipments, jan.on_time_count, jan.delayed_count) == (2, 2, 0)
    assert jan.avg_cost_per_kg == D("0.3667")   # (40 + 70) / (100 + 200), weighted
    assert jan.total_revenue_eur == D("110.00")
    feb = got[(1, 1, dt.date(2024, 2, 1))]
    assert (feb.total_shipments, feb.on_time_count, feb.delayed_count, feb.damaged_count) == (3, 1, 1, 0)
    assert feb.sla_breached is True and got[(2, 1, dt.date(2024, 1, 1))].sla_breached is False
    # lead days: (3 % 3, 4 % 3, 5 % 3) = 0, 1, 2 -> 1.00
    assert feb.avg_lead_time_days == D("1.00")
    dmg = got[(1, 2, dt.date(2024, 1, 1))]
    assert dmg.damaged_count == 1 and dmg.avg_cost_per_kg == D("0.6000")
    assert (9, 1, dt.date(2024, 1, 1)) in got and got[(9, 1, dt.date(2024, 1, 1))].sla_breached is False


def test_monthly_trend(spark, providers, routes):
    h = roll_up_history(_shipments(spark), providers)
    out = monthly_trend(h, providers, routes)
    got = rows(out, "month", "provider_name", "lane", "on_time_pct")
    assert got[0][0] == "2024-01"
    assert ("2024-02", "Alpha Freight", "Utrecht → Lyon", 33.33) in got
    assert [g[0] for g in got] == sorted(g[0] for g in got)
