import datetime as dt

from pyspark.sql import functions as F

from conftest import D, d, make, rows

from freightlens.operators import (
    complaints,
    dim_values,
    drill_through,
    integrity_report,
    report_radar,
    report_summary,
    report_trend,
    shipment_log,
    status_breakdown,
    v_detail,
)


def _ship(spark):
    spec = [(1, 1, 1, "Delivered", True), (2, 1, 1, "Delayed", False), (2, 2, 1, "Delivered", False),
            (3, 9, 1, "Delivered", False), (4, 2, None, "Delivered", None), (5, 2, 2, "Delayed", True)]
    return make(spark, "shipments", [
        {"shipment_id": i, "provider_id": p, "route_id": r, "shipment_date": d("2024-01-01"), "weight_kg": D("1"),
         "total_cost_eur": D("1.00"), "status": st, "customer_complaint": c,
         "promised_delivery": d("2024-01-02"), "actual_delivery": d("2024-01-02")}
        for i, p, r, st, c in spec])


def test_integrity_report(spark, providers, routes):
    quotes = make(spark, "quotes", [{"quote_id": None, "provider_id": 7, "route_id": None}, {"quote_id": 1, "provider_id": 1, "route_id": 8}])
    tables = {"providers": providers.unionByName(providers.limit(1)), "routes": routes.withColumn("dest_country", F.lit(None).cast("string")),
              "quotes": quotes, "shipments": _ship(spark), "performance_history": make(spark, "performance_history", [])}
    got = {(r.table_name, r.check_name, r.column_name): r.violations for r in integrity_report(tables, partitions=3).collect()}
    broken = {k: n for k, n in got.items() if n}
    assert broken == {("providers", "duplicate", "provider_id"): 1, ("routes", "null", "dest_country"): 2, ("quotes", "null", "quote_id"): 1,
                      ("quotes", "orphan", "provider_id"): 1, ("quotes", "orphan", "route_id"): 1,
                      ("shipments", "orphan", "provider_id"): 1, ("shipments", "duplicate", "shipment_id"): 1}
    assert ("shipments", "null", "route_id") not in got and len(got) == 5 + 5 + 2 + 4 + 6


def test_drill_through_status_and_complaints(spark, providers, routes):
    vd = v_detail(_ship(spark), providers, routes)
    assert sorted(rows(status_breakdown(vd), "provider_name", "status", "shipments")) == [
        ("Alpha Freight", "Delayed", 1), ("Alpha Freight", "Delivered", 1),
        ("Beta Logistics", "Delayed", 1), ("Beta Logistics", "Delivered", 1)]
    assert sorted(rows(complaints(vd), "provider_name", "complaints")) == [("Alpha Freight", 1), ("Beta Logistics", 1)]
    assert drill_through(vd, ["Beta Logistics"]).count() == 2
    who = spark.createDataFrame([("Alpha Freight",)], "provider_name string")
    log = shipment_log(vd, who)
    assert log.count() == 2 and log.columns == ["shipment_date", "provider_name", "lane", "weight_kg", "status",
                                                "delay_days", "total_cost_eur", "customer_complaint"]
    assert status_breakdown(vd, ["Alpha Freight"]).count() == 2


def test_dims_are_derived_from_all_facts(spark):
    a = spark.createDataFrame([("X → Y",), ("X → Z",)], "lane string")
    b = spark.createDataFrame([("X → Y",), ("AMS → Q",)], "lane string")
    assert sorted(r.lane for r in dim_values("lane", a, b).collect()) == ["AMS → Q", "X → Y", "X → Z"]


def _vsc(spark):
    return spark.createDataFrame(
        [("A", "L1", 0.40, 90.0, 3.0), ("A", "L2", 0.30, 80.0, 2.0), ("B", "L1", 0.20, 100.0, 1.0)],
        "provider_name string, lane string, avg_cost_per_kg double, avg_on_time_pct double, "
        "avg_lead_time_days double")


def test_report_summary_and_radar(spark):
    got = rows(report_summary(_vsc(spark)).orderBy("score_rank"), "provider_name", "avg_cost_per_kg",
               "avg_on_time_pct", "weighted_score", "score_rank", "sla_status")
    assert got == [("B", 0.2, 100.0, 100.0, 1, "🟢 Good"), ("A", 0.35, 85.0, 25.0, 2, "🔴 Breach")]
    from freightlens.operators import measure_scores
    radar = report_radar(measure_scores(_vsc(spark)))
    assert radar.count() == 6
    assert sorted({r.category for r in radar.collect()}) == ["Cost Score", "Lead Time Score", "Reliability Score"]


def test_report_trend(spark, providers, routes):
    h = make(spark, "performance_history", [
        {"perf_id": 1, "provider_id": 1, "route_id": 1, "month_year": dt.date(2024, 1, 1), "total_shipments": 10,
         "on_time_count": 9, "avg_cost_per_kg": D("0.3000")},
        {"perf_id": 2, "provider_id": 1, "route_id": 2, "month_year": dt.date(2024, 1, 1), "total_shipments": 30,
         "on_time_count": 15, "avg_cost_per_kg": D("0.5000")}])
    got = rows(report_trend(h, providers, routes), "month", "provider_name", "avg_on_time_pct", "avg_cost_per_kg",
               "shipments", "sla_threshold")
    assert got == [("2024-01", "Alpha Freight", 70.0, 0.4, 40, D("92.00"))]
    sliced = rows(report_trend(h, providers, routes, lanes=["Groningen → Bremen"]), "avg_on_time_pct", "shipments")
    assert sliced == [(50.0, 30)]
    assert report_trend(h, providers, routes, provider_names=["Beta Logistics"]).count() == 0
    assert report_trend(h, providers, routes, provider_names=["Alpha Freight"]).count() == 1


def test_slice_by(spark):
    from freightlens.operators import slice_by

    df = spark.createDataFrame([("A", "L1"), ("A", "L2"), ("B", "L1")], "provider_name string, lane string")
    assert slice_by(df, lanes=["L1"]).count() == 2
    assert slice_by(df, lanes=["L1"], providers=["B"]).count() == 1
    assert slice_by(df).count() == 3


def test_lane_overview_keeps_pairs_from_any_fact(spark):
    from freightlens.operators import lane_overview

    card = spark.createDataFrame([("A", "L1", 0.3, 90.0)], "provider_name string, lane string, "
                                 "avg_cost_per_kg double, avg_on_time_pct double")
    card = card.withColumn("lane", F.lit("X → Y"))
    p = spark.createDataFrame([(1, "A"), (2, "B")], "provider_id int, provider_name string")
    r = spark.createDataFrame([(1, "X", "Y"), (2, "X", "Z")], "route_id int, origin_city string, dest_city string")
    due = dt.date(2024, 1, 1)
    ships = spark.createDataFrame([(1, 1, "Delayed", True, due, dt.date(2024, 1, 3), 10.0), (1, 1, "Delivered", False, due, dt.date(2024, 1, 2), 5.0),
                                   (2, 2, "Delivered", None, due, None, 1.0)],
                                  "provider_id int, route_id int, status string, customer_complaint boolean, promised_delivery date, "
                                  "actual_delivery date, total_cost_eur double")
    tr = spark.createDataFrame([("A", "X → Y", dt.date(2024, 1, 1)), ("A", "X → Y", dt.date(2024, 2, 1))],
                               "provider_name string, lane string, month_year date")
    got = {r.provider_name: r for r in lane_overview(card, ships, tr, p, r).collect()}
    a, b = got["A"], got["B"]
    assert (a.shipments, a.delayed, a.complaints, a.avg_delay_days, a.spend_eur, a.months) == (2, 1, 1, 1.5, 15.0, 2)
    assert (b.avg_cost_per_kg, b.shipments, b.avg_delay_days, b.months) == (None, 1, None, None)
