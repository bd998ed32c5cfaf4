from conftest import D, make, rows

from freightlens.operators import landed_rate, quote_spread, ranked_quotes, volume_scenarios


def _quotes(spark):
    q = [  # provider, route, band, base, fuel %, discount %, min kg
        (1, 1, "500-2000", "0.3200", "12.50", "5.00", "500"),
        (2, 1, "500-2000", "0.3000", "10.00", "8.00", "500"),
        (3, 1, "500-2000", "0.3000", "11.00", "6.00", "500"),
        (1, 1, "2000+", "0.2800", "12.50", "10.00", "2000"),
        (2, 1, "2000+", "0.2500", "10.00", "10.00", "3000"),
        (1, 1, "0-500", "0.4000", "12.00", "0.00", "0"),
        (2, 2, "500-2000", "0.3500", "10.00", "5.00", "500"),
        (3, 2, "500-2000", "0.3500", "10.00", "5.00", "500"),
    ]
    return make(spark, "quotes", [
        {"quote_id": i + 1, "provider_id": p, "route_id": r, "weight_band_kg": b, "base_rate_eur_per_kg": D(base),
         "fuel_surcharge_pct": D(f), "volume_discount_pct": D(v), "min_shipment_kg": D(m), "quote_source": "desk"}
        for i, (p, r, b, base, f, v, m) in enumerate(q)])


def test_landed_rate(spark, providers, routes):
    out = landed_rate(_quotes(spark), providers, routes)
    got = {(r.provider_name, r.lane, r.weight_band_kg): (r.effective_rate_incl_fuel, r.best_negotiated_rate)
           for r in out.collect()}
    assert len(got) == 8
    assert got[("Alpha Freight", "Utrecht → Lyon", "500-2000")] == (0.36, 0.342)
    assert got[("Beta Logistics", "Utrecht → Lyon", "500-2000")] == (0.33, 0.3036)
    assert got[("Gamma Cargo", "Utrecht → Lyon", "500-2000")] == (0.333, 0.313)
    # text order of bands within the lane
    bands = [r.weight_band_kg for r in out.collect() if r.lane == "Utrecht → Lyon"]
    assert bands == sorted(bands)


def test_quote_spread_orders_ties_by_name(spark, providers, routes):
    out = quote_spread(_quotes(spark), providers, routes).filter("weight_band_kg = '500-2000'")
    r = {x.lane: x for x in out.collect()}["Utrecht → Lyon"]
    assert (r.cheapest_rate, r.priciest_rate, r.avg_rate, r.rate_spread, r.spread_pct) == \
        (0.3, 0.32, 0.3067, 0.02, 6.67)
    assert r.provider_rates == "Beta Logistics: €0.3000 | Gamma Cargo: €0.3000 | Alpha Freight: €0.3200"


def test_volume_scenarios_band_rule_both_branches_and_ties(spark, providers, routes):
    sc = ((500, "500kg"), (2000, "2000kg"), (2500, "2500kg"))
    out = volume_scenarios(_quotes(spark), providers, routes, scenarios=sc, boundary=2000,
                           band_at_or_below="500-2000", band_above="2000+")
    got = sorted(rows(out, "scenario_label", "lane", "provider_name", "total_cost_eur", "cost_rank"))
    assert len(got) == 11
    assert ("500kg", "Utrecht → Lyon", "Beta Logistics", 151.8, 1) in got
    assert ("500kg", "Utrecht → Lyon", "Gamma Cargo", 156.51, 2) in got
    assert ("500kg", "Utrecht → Lyon", "Alpha Freight", 171.0, 3) in got
    assert ("2000kg", "Utrecht → Lyon", "Alpha Freight", 684.0, 3) in got
    # 2500 kg takes the '2000+' band; the 3000 kg minimum excludes Beta
    assert [g for g in got if g[0] == "2500kg"] == [("2500kg", "Utrecht → Lyon", "Alpha Freight", 708.75, 1)]
    # equal quotes share the rank; half a cent rounds up
    assert ("500kg", "Groningen → Bremen", "Beta Logistics", 182.88, 1) in got
    assert ("500kg", "Groningen → Bremen", "Gamma Cargo", 182.88, 1) in got


def test_volume_scenario_below_every_minimum_gives_no_rows(spark, providers, routes):
    out = volume_scenarios(_quotes(spark), providers, routes, scenarios=((100, "100kg"),), boundary=2000,
                           band_at_or_below="500-2000", band_above="2000+")
    assert out.count() == 0


def test_ranked_quotes_are_the_list_as_rows(spark, providers, routes):
    ranks = {}
    for r in ranked_quotes(_quotes(spark), providers, routes).collect():
        ranks.setdefault((r.lane, r.weight_band_kg), []).append((r.rate_rank, r.base_rate_eur_per_kg, r.provider_name))
    for r in quote_spread(_quotes(spark), providers, routes).collect():
        own = sorted(ranks[r.lane, r.weight_band_kg])
        assert [x.split(": €")[0] for x in r.provider_rates.split(" | ")] == [p for _, _, p in sorted(own, key=lambda x: (x[1], x[2]))]
        assert own[0][0] == 1 and own[0][1] == min(x[1] for x in own)


def test_volume_scenarios_reference_defaults(spark, providers, routes):
    out = volume_scenarios(_quotes(spark), providers, routes)
    labels = sorted({r.scenario_label for r in out.collect()})
    assert labels == ["2000kg scenario", "500kg scenario"] and out.count() == 10


def test_volume_scenarios_exact_on_decimal_rates(spark, providers, routes):
    # 2000 * 0.3125 * 1.13 * 0.94 = 663.875 exactly: decimal rounding gives 663.88,
    # the same product in DOUBLE rounds to 663.87
    q = make(spark, "quotes", [{"quote_id": 1, "provider_id": 1, "route_id": 1, "weight_band_kg": "500-2000",
                                "base_rate_eur_per_kg": D("0.3125"), "fuel_surcharge_pct": D("13.00"),
                                "volume_discount_pct": D("6.00"), "min_shipment_kg": D("500")}])
    r = volume_scenarios(q, providers, routes).filter("scenario_label = '2000kg scenario'").first()
    assert r.total_cost_eur == 663.88
