"""Property tests: random small shipment sets against a brute-force
computation in plain Python, plus invariants from the survey's test plan."""

import datetime as dt
import math
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make

from freightlens.operators import delay_pareto, on_time_rate, roll_up_history, sla_alerts

PROVIDERS = {1: ("Alpha Freight", 92.0), 2: ("Beta Logistics", 90.0), 3: ("Gamma Cargo", 91.0)}
ROUTES = {1: "Utrecht → Lyon", 2: "Groningen → Bremen"}

ship = st.fixed_dictionaries({
    "provider_id": st.sampled_from([1, 2, 3, 9, None]),
    "route_id": st.sampled_from([1, 2, None]),
    "month": st.integers(1, 6),
    "status": st.sampled_from(["Delivered", "Delivered", "Delayed", "Lost", "Damaged"]),
    "delay_reason": st.sampled_from([None, None, "No Delay", "Weather", "Customs"]),
    "customer_complaint": st.sampled_from([True, False, None]),
    "cents": st.integers(0, 100000),
})


def r(x, n):
    if x is None:
        return None
    s = 10 ** n
    return math.copysign(1, x) * math.floor(abs(x) * s + 0.5) / s + 0.0 if x != 0 else 0.0


def _df(spark, items):
    return make(spark, "shipments", [
        {"shipment_id": i, "provider_id": it["provider_id"], "route_id": it["route_id"],
         "shipment_date": dt.date(2024, it["month"], 1 + i % 28), "weight_kg": Decimal("1.00"),
         "total_cost_eur": Decimal(it["cents"]) / 100, "status": it["status"], "delay_reason": it["delay_reason"],
         "customer_complaint": it["customer_complaint"]} for i, it in enumerate(items)])


def _dims(spark):
    p = make(spark, "providers", [{"provider_id": k, "provider_name": n, "sla_threshold": Decimal(str(s))}
                                  for k, (n, s) in PROVIDERS.items()])
    r_ = make(spark, "routes", [{"route_id": k, "origin_city": v.split(" → ")[0], "origin_country": "NL",
                                 "dest_city": v.split(" → ")[1], "dest_country": "EU"} for k, v in ROUTES.items()])
    return p, r_


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(ship, min_size=1, max_size=40))
def test_on_time_rate_matches_brute_force(spark, items):
    p, rt = _dims(spark)
    got = {(x.provider_name, x.lane): (x.total_shipments, x.on_time, x.delayed, x.on_time_pct)
           for x in on_time_rate(_df(spark, items), p, rt).collect()}
    want = defaultdict(lambda: [0, 0, 0])
    for it in items:
        if it["provider_id"] in PROVIDERS and it["route_id"] in ROUTES:
            k = (PROVIDERS[it["provider_id"]][0], ROUTES[it["route_id"]])
            want[k][0] += 1
            want[k][1] += it["status"] == "Delivered"
            want[k][2] += it["status"] == "Delayed"
    assert got == {k: (t, o, dl, r(o * 100.0 / t, 2)) for k, (t, o, dl) in want.items()}
    for t, o, dl, _ in got.values():
        assert o + dl <= t


@SETTINGS
@given(st.lists(ship, min_size=1, max_size=40))
def test_delay_pareto_matches_brute_force_and_shares_sum_to_100(spark, items):
    out = delay_pareto(_df(spark, items)).collect()
    want = defaultdict(lambda: [0, Decimal(0), 0])
    for it in items:
        w = want[it["delay_reason"]]
        w[0] += 1
        w[1] += Decimal(it["cents"]) / 100
        w[2] += it["customer_complaint"] is True
    n = len(items)
    assert sorted((x.delay_reason, x.frequency, x.pct_of_total, x.total_freight_affected_eur, x.complaints)
                  for x in out) == sorted(
        (k if k is not None else "No Delay", c, r(c * 100.0 / n, 2), s, m) for k, (c, s, m) in want.items())
    assert abs(sum(x.pct_of_total for x in out) - 100.0) <= 0.005 * len(out) + 1e-9
    assert [x.frequency for x in out] == sorted((x.frequency for x in out), reverse=True)


@SETTINGS
@given(st.lists(ship, min_size=1, max_size=40), st.randoms(use_true_random=False))
def test_alerts_do_not_depend_on_row_order(spark, items, rnd):
    p, rt = _dims(spark)
    shuffled = list(items)
    rnd.shuffle(shuffled)
    a = sla_alerts(roll_up_history(_df(spark, items), p), p, rt).collect()
    b = sla_alerts(roll_up_history(_df(spark, shuffled).repartition(3), p), p, rt).collect()
    key = lambda x: (x.provider_name, x.lane)
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    assert {key(x) for x in a} <= {(PROVIDERS[i][0], ROUTES[j]) for i in PROVIDERS for j in ROUTES}


hist_row = st.fixed_dictionaries({
    "provider_id": st.sampled_from([1, 2, 3]),
    "route_id": st.sampled_from([1, 2]),
    "month": st.integers(1, 12),
    "total": st.integers(0, 30),
    "on_time_frac": st.floats(0, 1),
    "cost_cents": st.integers(20, 60),
    "lead": st.integers(100, 400),
})


def _hist(spark, items):
    seen, rows_ = set(), []
    for it in items:
        k = (it["provider_id"], it["route_id"], it["month"])
        if k in seen:
            continue
        seen.add(k)
        rows_.append({"perf_id": len(rows_), "provider_id": k[0], "route_id": k[1],
                      "month_year": dt.date(2024, k[2], 1), "total_shipments": it["total"],
                      "on_time_count": int(it["total"] * it["on_time_frac"]),
                      "avg_cost_per_kg": Decimal(it["cost_cents"]) / 100, "avg_lead_time_days": Decimal(it["lead"]) / 100,
                      "total_revenue_eur": Decimal("1.00"), "sla_breached": False})
    return make(spark, "performance_history", rows_)


@SETTINGS
@given(st.lists(hist_row, min_size=2, max_size=30))
def test_scorecard_invariants(spark, items):
    from freightlens.operators import scorecard, sensitivity

    p, _ = _dims(spark)
    sc = scorecard(_hist(spark, items), p)
    out = sc.collect()
    for x in out:
        for s in (x.cost_score, x.reliability_score, x.lead_time_score, x.weighted_total_score):
            assert s is None or 0.0 <= s <= 100.0
    ranks = sorted(x.final_rank for x in out)
    assert ranks[0] == 1
    scored = sorted((x for x in out if x.weighted_total_score is not None), key=lambda x: x.final_rank)
    assert [x.weighted_total_score for x in scored] == sorted((x.weighted_total_score for x in scored),
                                                              reverse=True)
    sens = sensitivity(sc).collect()
    assert len(sens) == 10 * len(out)
    assert {x.weight_set for x in sens if x.score_rank == 1} == set(range(1, 11))


@SETTINGS
@given(st.lists(hist_row, min_size=1, max_size=30))
def test_alert_is_the_latest_rolling_value(spark, items):
    from freightlens.operators import rolling_on_time

    p, rt = _dims(spark)
    h = _hist(spark, items)
    latest = {}
    for x in rolling_on_time(h, p, rt).collect():
        k = (x.provider_name, x.lane)
        if k not in latest or x.month_year > latest[k][0]:
            latest[k] = (x.month_year, x.rolling_3m_otd)
    alerts = {(x.provider_name, x.lane): x.rolling_3m_otd for x in sla_alerts(h, p, rt).collect()}
    assert alerts == {k: v[1] for k, v in latest.items()}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 5000)), min_size=1, max_size=25))
def test_exact_percentages_and_means_equal_decimal_arithmetic(spark, pairs):
    from decimal import ROUND_HALF_UP

    from freightlens.functions import mean_half_up, mean_parts, pct_decimal, pct_half_up

    rows_ = [(min(a, b), b) for a, b in pairs]
    df = spark.createDataFrame(rows_, "a bigint, b bigint")
    got = df.select(pct_decimal("a", "b").alias("p5"), pct_half_up("a", "b", 2).alias("p2")).collect()
    want5 = [None if b == 0 else (Decimal(a) * 100 / Decimal(b)).quantize(Decimal("0.00001"), ROUND_HALF_UP)
             for a, b in rows_]
    want2 = [None if b == 0 else float((Decimal(a) * 100 / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP))
             for a, b in rows_]
    assert [r.p5 for r in got] == want5
    assert [r.p2 for r in got] == want2
    m = (df.agg(*mean_parts(pct_decimal("a", "b"), 5, "p"))
         .select(mean_half_up("p", 5, 2).alias("m")).first().m)
    vals = [v for v in want5 if v is not None]
    expect = None if not vals else float((sum(vals) / len(vals)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert m == expect
