"""Plan-shape checks: broadcasts where bounded, no shuffle for map-only
views, partial aggregation before the shuffle, pushdown into the scan."""

import os
import tempfile

from conftest import D, d, make

from freightlens.operators import on_time_rate, v_detail


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _parquet_shipments(spark):
    df = make(spark, "shipments", [
        {"shipment_id": i, "provider_id": 1 + i % 3, "route_id": 1 + i % 2, "shipment_date": d("2024-01-01"),
         "weight_kg": D("1"), "total_cost_eur": D("1.00"), "status": "Delivered"} for i in range(50)])
    path = os.path.join(tempfile.mkdtemp(prefix="fl-plan-"), "s")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_building_an_operator_runs_no_job(spark, providers, routes):
    """Every operator is lazy: nothing runs before an action."""
    from freightlens.operators import quote_spread, volume_scenarios

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-check", "building only")
    s = make(spark, "shipments", [])
    q = make(spark, "quotes", [])
    on_time_rate(s, providers, routes), v_detail(s, providers, routes), quote_spread(q, providers, routes), volume_scenarios(q, providers, routes)
    assert not tracker.getJobIdsForGroup("lazy-check")


def test_v_detail_is_map_only(spark, providers, routes):
    s = _parquet_shipments(spark)
    base = tempfile.mkdtemp(prefix="fl-dims-")
    for name, df in (("p", providers), ("r", routes)):
        df.write.parquet(os.path.join(base, name))  # stored dimensions: the planner knows their size
    p = _plan(v_detail(s, spark.read.parquet(f"{base}/p"), spark.read.parquet(f"{base}/r")))
    assert "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p


def test_on_time_aggregates_before_the_shuffle_and_prunes_columns(spark, providers, routes):
    s = _parquet_shipments(spark)
    df = on_time_rate(s, providers, routes)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in p
    scan = [ln for ln in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "ReadSchema" in ln
            or "FileScan" in ln]
    assert scan and all("weight_kg" not in ln for ln in scan)


def test_filter_reaches_the_parquet_scan(spark):
    s = _parquet_shipments(spark).filter("status = 'Delayed'")
    txt = s._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,Delayed)]" in txt
