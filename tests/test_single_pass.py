"""Operators that read their inputs once: results and plans."""

import os
import re
import tempfile

import pytest
from conftest import D, d, make
from pyspark.sql import functions as F

from freightlens.operators import delay_pareto, integrity_report, quote_spread
from freightlens.plans.totals import with_total


def stored(spark, df, name):
    path = os.path.join(tempfile.mkdtemp(prefix="fl-once-"), name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def scans(df, name):
    """Scans of the stored table ``name`` in the plan that ran."""
    df.collect()
    return len(re.findall(rf"FileScan parquet[^\n]*?/{name}[\],]", final_plan(df)))


def final_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_total_comes_with_the_groups(spark):
    rows = [(k, i) for i in range(400) for k in ("a", "b", None)] + [("lone", 5)]
    df = spark.createDataFrame(rows, "k string, v int")
    for buckets in (1, 3, 64):
        got = {r.k: (r.n, r.s, r.total, r.most) for r in with_total(df, ["k"], [F.count("*").alias("n"), F.sum("v").alias("s")], {"total": "n", "most": "s"}, buckets).collect()}
        assert got == {k: (400, 79800, 1201, 239405) for k in ("a", "b", None)} | {"lone": (1, 5, 1201, 239405)}
    two = with_total(df, ["k", "v"], [F.count("*").alias("n")], {"total": "n"}).collect()
    assert len(two) == 1201 and {r.total for r in two} == {1201}
    assert with_total(df.limit(0), ["k"], [F.count("*").alias("n")], {"total": "n"}).collect() == []


def test_pareto_reads_the_shipments_once(spark):
    rows = [{"shipment_id": i, "shipment_date": d("2024-01-01"), "delay_reason": [None, "No Delay", "Customs"][i % 3], "total_cost_eur": D("1.50"),
             "customer_complaint": i % 2 == 0} for i in range(30)]
    s = stored(spark, make(spark, "shipments", rows), "shipments")
    df = delay_pareto(s)
    assert [(r.frequency, r.pct_of_total) for r in df.collect()] == [(10, 33.33)] * 3
    assert scans(df, "shipments") == 1


def test_integrity_reads_each_table_once(spark, providers, routes):
    quotes = [{"quote_id": 1, "provider_id": 1, "route_id": 1, "weight_band_kg": "a"}, {"quote_id": 1, "provider_id": 9, "route_id": None, "weight_band_kg": "a"},
              {"quote_id": None, "provider_id": 1, "route_id": 7, "weight_band_kg": None}, {"quote_id": None, "provider_id": None, "route_id": 7, "weight_band_kg": "a"},
              {"quote_id": 3, "provider_id": 1, "route_id": 1, "weight_band_kg": "a"}]
    ships = [{"shipment_id": 1 + i // 3, "provider_id": 1, "route_id": 8, "shipment_date": d("2024-01-01") if i else None} for i in range(6)]
    tables = {"providers": providers, "routes": routes, "quotes": make(spark, "quotes", quotes), "shipments": make(spark, "shipments", ships)}
    tables = {n: stored(spark, df, n) for n, df in tables.items()}
    want = {("quotes", "null", "quote_id"): 2, ("quotes", "duplicate", "quote_id"): 1, ("quotes", "orphan", "provider_id"): 1, ("quotes", "orphan", "route_id"): 2,
            ("shipments", "null", "shipment_date"): 1, ("shipments", "duplicate", "shipment_id"): 4, ("shipments", "orphan", "route_id"): 6}
    for partitions in (None, {"shipments": 5}, 3):
        df = integrity_report(tables, partitions=partitions)
        got = {(r.table_name, r.check_name, r.column_name): r.violations for r in df.collect()}
        assert {k: v for k, v in got.items() if v} == want
    df = integrity_report(tables, partitions={"shipments": 5})
    assert scans(df, "quotes") == 1 and scans(df, "shipments") == 2
    # the parents: their own checks, and one join with the pairs of all tables
    assert scans(df, "providers") == 2 and scans(df, "routes") == 2
    key = integrity_report(tables, {"quotes": ("provider_id", "route_id", "weight_band_kg")})
    got = {(r.table_name, r.check_name, r.column_name): r.violations for r in key.collect()}
    assert got["quotes", "duplicate", "provider_id,route_id,weight_band_kg"] == 1
    assert [got["quotes", "null", c] for c in ("provider_id", "route_id", "weight_band_kg")] == [1, 1, 1]


@pytest.mark.parametrize("partitions", [1, 7])
def test_rate_list_is_the_same_however_a_lane_is_cut(spark, providers, routes, partitions):
    """A lane with most quotes is cut into several ranges; the text is that of one sort."""
    rows = [{"quote_id": i, "provider_id": 1 + i % 3, "route_id": 1 if i % 10 else 2, "weight_band_kg": "a", "base_rate_eur_per_kg": D(f"{(i * 37) % 50}.{i % 2}000")} for i in range(300)]
    rows.append({"quote_id": 999, "provider_id": 1, "route_id": 1, "weight_band_kg": "b"})
    names = {1: "Alpha Freight", 2: "Beta Logistics", 3: "Gamma Cargo"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = quote_spread(make(spark, "quotes", rows), providers, routes)
        got = {(r.lane, r.weight_band_kg): r for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for lane, route in (("Utrecht → Lyon", 1), ("Groningen → Bremen", 2)):
        own = sorted((r["base_rate_eur_per_kg"], names[r["provider_id"]]) for r in rows if r["route_id"] == route and r["weight_band_kg"] == "a")
        r = got[lane, "a"]
        assert r.provider_rates == " | ".join(f"{n}: €{v}" for v, n in own)
        assert (r.cheapest_rate, r.priciest_rate) == (float(own[0][0]), float(own[-1][0]))
    assert got["Utrecht → Lyon", "b"].provider_rates is None
