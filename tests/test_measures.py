from conftest import rows

from freightlens.operators import kpis, lane_savings, potential_saving, rag_status


def _vsc(spark):
    return spark.createDataFrame(
        [("A", "L1", 0.40, 90.0, 3.0, 10, 1000.5, 1), ("A", "L2", 0.30, 80.0, 2.0, 20, 2000.25, 0),
         ("B", "L1", 0.20, 100.0, 1.0, 30, 500.0, 2), ("C", "L1", 0.20, 96.0, 1.0, 5, 1.0, 0)],
        "provider_name string, lane string, avg_cost_per_kg double, avg_on_time_pct double, "
        "avg_lead_time_days double, total_shipments_ytd bigint, total_spend_eur double, sla_breach_months bigint")


def test_kpis_total_and_by_provider(spark):
    r = kpis(_vsc(spark)).first()
    assert (r.total_spend_eur, r.total_shipments, r.sla_breaches) == (3501.75, 65, 3)
    assert r.avg_otd_pct == 91.5 and r.avg_cost_per_kg == 0.275
    by = {x.provider_name: x.total_shipments for x in kpis(_vsc(spark), by=["provider_name"]).collect()}
    assert by == {"A": 30, "B": 30, "C": 5}


def test_lane_savings_default_current_is_priciest(spark):
    vol = spark.createDataFrame([("L1", 1000.0), ("L2", 500.0)], "lane string, volume_kg double")
    got = sorted(rows(lane_savings(_vsc(spark), vol), "lane", "current_provider", "best_provider",
                      "annual_saving_eur"))
    # equal best rates on L1: the first name wins
    assert got == [("L1", "A", "B", 200.0), ("L2", "A", "A", 0.0)]


def test_lane_savings_with_given_current_provider(spark):
    vol = spark.createDataFrame([("L1", 1000.0)], "lane string, volume_kg double")
    cur = spark.createDataFrame([("L1", "C")], "lane string, provider_name string")
    got = rows(lane_savings(_vsc(spark), vol, cur), "lane", "current_provider", "current_rate", "best_rate",
               "annual_saving_eur")
    assert got == [("L1", "C", 0.2, 0.2, 0.0)]


def test_potential_saving(spark):
    r = potential_saving(_vsc(spark)).first()
    assert r.potential_annual_saving == 480000.0


def test_rag_status_bounds(spark):
    got = dict(rows(rag_status(_vsc(spark)), "provider_name", "sla_status"))
    assert got == {"A": "🔴 Breach", "B": "🟢 Good", "C": "🟢 Good"}
    got = dict(rows(rag_status(_vsc(spark), good=99, at_risk=85), "provider_name", "sla_status"))
    assert got == {"A": "🟡 At Risk", "B": "🟢 Good", "C": "🟡 At Risk"}


def test_lane_savings_total(spark):
    from freightlens.operators import lane_savings_total

    vol = spark.createDataFrame([("L1", 1000.0), ("L2", 500.0)], "lane string, volume_kg double")
    r = lane_savings_total(lane_savings(_vsc(spark), vol)).first()
    assert (r.lanes, r.total_annual_saving_eur) == (2, 200.0)
