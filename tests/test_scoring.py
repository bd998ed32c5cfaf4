import datetime as dt

from conftest import D, make, rows

from freightlens.operators import measure_scores, scorecard, sensitivity


def _history(spark, spec):
    out = []
    for i, (p, cost, on_time, total, lead) in enumerate(spec):
        out.append({"perf_id": i + 1, "provider_id": p, "route_id": 1, "month_year": dt.date(2024, 1 + i % 12, 1),
                    "total_shipments": total, "on_time_count": on_time, "avg_cost_per_kg": D(cost),
                    "avg_lead_time_days": D(lead), "total_revenue_eur": D("100.00"), "sla_breached": False})
    return make(spark, "performance_history", out)


SPEC = [(1, "0.4000", 9, 10, "3.00"), (1, "0.3800", 8, 10, "2.00"),
        (2, "0.3000", 10, 10, "2.00"), (2, "0.3200", 24, 25, "2.00"),
        (3, "0.3500", 19, 20, "2.50")]


def test_scorecard_values_and_rank(spark, providers):
    out = scorecard(_history(spark, SPEC), providers)
    got = rows(out, "provider_name", "avg_cost_per_kg", "avg_on_time_pct", "avg_lead_days", "cost_score",
               "reliability_score", "lead_time_score", "weighted_total_score", "final_rank")
    assert got == [
        ("Beta Logistics", 0.31, 98.0, 2.0, 100.0, 100.0, 100.0, 100.0, 1),
        ("Gamma Cargo", 0.35, 95.0, 2.5, 50.0, 76.92, 0.0, 46.92, 2),
        ("Alpha Freight", 0.39, 85.0, 2.5, 0.0, 0.0, 0.0, 0.0, 3),
    ]
    for r in out.collect():
        for s in (r.cost_score, r.reliability_score, r.lead_time_score):
            assert 0 <= s <= 100


def test_scorecard_zero_range_null_or_zero(spark, providers):
    one = _history(spark, [(1, "0.4000", 9, 10, "3.00")])
    r = scorecard(one, providers).first()
    assert (r.cost_score, r.reliability_score, r.lead_time_score, r.weighted_total_score, r.final_rank) == \
        (None, None, None, None, 1)
    r = scorecard(one, providers, on_zero_range="zero").first()
    assert (r.cost_score, r.reliability_score, r.lead_time_score) == (100.0, 0.0, 100.0)


def test_scorecard_ties_share_rank_and_null_ranks_last(spark, providers):
    tied = _history(spark, [(1, "0.4000", 9, 10, "3.00"), (2, "0.4000", 9, 10, "3.00"),
                            (3, "0.3000", 10, 10, "2.00")])
    got = sorted(rows(scorecard(tied, providers), "provider_name", "final_rank"))
    assert got == [("Alpha Freight", 2), ("Beta Logistics", 2), ("Gamma Cargo", 1)]
    # a provider whose months all have zero shipments: NULL score, ranked last
    blank = _history(spark, [(1, "0.4000", 9, 10, "3.00"), (2, "0.3000", 10, 10, "2.00"),
                             (3, "0.3500", 0, 0, "2.50")])
    got = rows(scorecard(blank, providers), "provider_name", "reliability_score", "weighted_total_score",
               "final_rank")
    assert got == [("Beta Logistics", 100.0, 100.0, 1), ("Alpha Freight", 0.0, 0.0, 2),
                   ("Gamma Cargo", None, None, 3)]


def _vsc(spark):
    return spark.createDataFrame(
        [("A", "L1", 0.40, 90.0, 3.0), ("A", "L2", 0.30, 80.0, 2.0), ("B", "L1", 0.20, 100.0, 1.0)],
        "provider_name string, lane string, avg_cost_per_kg double, avg_on_time_pct double, "
        "avg_lead_time_days double")


def test_measure_scores_detail_baseline(spark):
    got = sorted(rows(measure_scores(_vsc(spark)), "provider_name", "cost_score", "reliability_score",
                      "lead_time_score", "weighted_score"))
    assert got == [("A", 25.0, 25.0, 25.0, 25.0), ("B", 100.0, 100.0, 100.0, 100.0)]


def test_measure_scores_slicer_keeps_all_rows_as_bounds(spark):
    got = sorted(rows(measure_scores(_vsc(spark), lanes=["L1"]), "provider_name", "cost_score",
                      "reliability_score", "lead_time_score"))
    assert got == [("A", 0.0, 50.0, 0.0), ("B", 100.0, 100.0, 100.0)]


def test_sensitivity_ranks_every_weight_set(spark, providers):
    out = sensitivity(scorecard(_history(spark, SPEC), providers))
    assert out.count() == 30
    firsts = out.filter("score_rank = 1").select("weight_set").distinct().count()
    assert firsts == 10
    base = {r.provider_name: r.weighted_score for r in out.filter("weight_set = 1").collect()}
    assert base == {"Beta Logistics": 100.0, "Gamma Cargo": 46.92, "Alpha Freight": 0.0}
