"""Month partitions, dynamic pruning, the kept roll-up and bucketed sources."""

import datetime as dt
import os
import tempfile

import pytest
from conftest import D, d, make

from freightlens import catalog
from freightlens.operators import history_store, missed_months, roll_up_history
from freightlens.plans.bucketing import store_bucketed
from freightlens.plans.materialize import write_checkpoint_table
from freightlens.plans.sizing import BUILD_CONF
from freightlens.sources import testdata as td

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_facts_lie_in_months(spark):
    i = catalog.inputs(spark, SF)
    files = i.facts.inputFiles()
    assert files and all(f"/{td.MONTH}=" in f for f in files)
    # a month's rows are not scattered over the tasks that wrote it
    assert len(files) <= 2 * i.facts.select(td.MONTH).distinct().count()


@needs_data
def test_month_slicer_reads_its_partitions(spark):
    i = catalog.inputs(spark, SF)
    text = plan(i.shipments_in(catalog.MONTHS))
    assert "PartitionFilters: [ship_month" in text.replace("isnotnull(ship_month", "ship_month") and "ship_month" in text.split("PartitionFilters:")[1].split("]")[0]
    scan = i.shipments_in(catalog.MONTHS)
    whole = {f for f in i.facts.inputFiles() if any(f"{td.MONTH}={m}" in f for m in catalog.MONTHS)}
    scan.collect()
    metrics = scan._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.apply("numFiles").value() == len(whole) < len(i.facts.inputFiles())


@needs_data
def test_drill_through_prunes_at_run_time(spark):
    i = catalog.inputs(spark, SF)
    months = missed_months(i.history, i.providers, list(catalog.PROVIDERS), catalog.MISSED_SHARE)
    chosen = months.count()
    assert 0 < chosen < i.history.select("month_year").distinct().count()
    assert "dynamicpruning" in plan(i.shipments_in(months)).lower()


def _shipments(spark, days, first=0):
    return make(spark, "shipments", [{"shipment_id": first + i, "provider_id": 1 + i % 2 if i % 7 else None, "route_id": 1 + i % 3, "shipment_date": d(x) if x else None,
                                      "actual_delivery": d("2024-06-30"), "weight_kg": D(f"{1 + i}.25"), "total_cost_eur": D(f"{3 * i}.50"),
                                      "status": ["Delivered", "Delayed", "Damaged"][i % 3]} for i, x in enumerate(days)])


def _same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_kept_history_equals_a_rebuild_and_rewrites_changed_months_only(spark, providers):
    path = os.path.join(tempfile.mkdtemp(prefix="fl-hist-"), "store")
    old = _shipments(spark, ["2024-01-05", "2024-01-31", "2024-02-10", "2024-02-10", "2024-03-01", None] * 4)
    new = _shipments(spark, ["2024-03-31", "2024-03-01", "2024-04-01"] * 3, 100)
    history_store.create(old, path)
    assert _same(history_store.history(spark, path, providers), roll_up_history(old, providers))
    before = {f: os.path.getmtime(os.path.join(r, f)) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    history_store.add(new, path, "b1")
    both = old.unionByName(new)
    assert _same(history_store.history(spark, path, providers), roll_up_history(both, providers))
    after = {f: os.path.basename(r) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    written = {m for f, m in after.items() if f not in before}
    assert written == {"month_year=2024-03-01", "month_year=2024-04-01"}
    history_store.add(new, path, "b1")  # the same batch again counts once
    late = _shipments(spark, ["2024-01-05", None], 200)  # a late line and one without a date
    history_store.add(late, path, "b2")
    assert _same(history_store.history(spark, path, providers), roll_up_history(both.unionByName(late), providers))
    history_store.add(late.limit(0), path, "b3")
    assert _same(history_store.history(spark, path), roll_up_history(both.unionByName(late)))


@needs_data
def test_stored_sources_join_without_an_exchange(spark):
    """The fact build over bucketed lines and orders: same rows, no shuffle of either."""
    stored = td.bucketed_sources(spark, SF, 4)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        j = stored[0].join(stored[1], stored[0].l_orderkey == stored[1].o_orderkey, "left")
        text = plan(j)
        assert "SortMergeJoin" in text and "Exchange" not in text
        facts = plan(td.shipment_facts(spark, SF, stored))
        assert "l_orderkey" not in "".join(x for x in facts.splitlines() if "Exchange" in x) and "o_orderkey" not in "".join(x for x in facts.splitlines() if "Exchange" in x)
        plain = plan(td.shipment_facts(spark, SF))
        assert "hashpartitioning(l_orderkey" in plain
    finally:
        spark.conf.set(key, before)
    assert _same(td.shipment_facts(spark, SF), td.shipment_facts(spark, SF, stored))


def test_bucketed_table_of_no_rows(spark):
    df = store_bucketed(spark.range(0).withColumnRenamed("id", "k"), "empty", ["k"], 3)
    assert df.collect() == [] and df.groupBy("k").count().collect() == []


def _sources(spark):
    """Small source tables with null, unknown and repeated keys."""
    day = lambda n: dt.datetime(2024, 1, 1, 17, 30) + dt.timedelta(days=n)
    rows = {
        "nation": [(n, f"N{n}", n % 2) for n in range(4)] + [(3, "N3 again", 1), (None, "none", 0)],
        "customer": [(c, f"C{c}", c % 5, 0.0, "m") for c in range(20)] + [(None, "none", 1, 0.0, "m")],
        "supplier": [(s, f"S{s}", s % 5 if s % 7 else None, 0.0) for s in range(30)] + [(4, "S4 again", 1, 0.0)],
        "orders": [(o, o % 25 if o % 9 else None, "O", 1.0, day(o % 40), f"{o % 3}-P") for o in range(100)] + [(7, 3, "O", 1.0, None, None)],
        "lineitem": [(i % 110 if i % 31 else None, i, i % 33 if i % 13 else None, i % 4, 1.0 + i % 50, 10.0 * i, 0.05, 0.02, "R" if i % 3 else "N", "O", day(i % 90) if i % 17 else None)
                     for i in range(600)],
    }
    path = tempfile.mkdtemp(prefix="fl-src-")
    for name, r in rows.items():
        spark.createDataFrame(r, td.SOURCES[name]).write.parquet(f"{path}/{name}.parquet")
    return path, rows


def test_fact_build_shuffles_the_lines_once(spark, monkeypatch):
    """The lines go to their orders; the suppliers, found small at run time, come to them."""
    path, rows = _sources(spark)
    plans = []

    def write(df, *a):
        df.collect()
        plans.append(plan(df).split("== Initial Plan ==")[0])
        return write_checkpoint_table(df, *a)

    monkeypatch.setattr(catalog, "write_checkpoint_table", write)
    names = ["spark.sql.autoBroadcastJoinThreshold", *BUILD_CONF, "spark.sql.shuffle.partitions"]
    spark.conf.set(names[0], "-1")
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        facts = catalog.Inputs(spark, path).facts
        assert {k: spark.conf.get(k, None) for k in names} == before
    finally:
        spark.conf.unset(names[0])
    assert "hashpartitioning(l_orderkey" in plans[0] and "hashpartitioning(l_suppkey" not in plans[0]
    on = lambda table, key, k=0: [r for r in rows[table] if r[k] == key and key is not None] or [(None,) * 6]
    want = [(li[1], s[2], n[2] * td.ROUTE_BASE + e[2] if n[2] is not None and e[2] is not None else None, li[10] and li[10].date(), o[4] and o[4].date(), o[5],
             li[10] and li[10].date().replace(day=1))
            for li in rows["lineitem"] for o in on("orders", li[0]) for c in on("customer", o[1]) for e in on("nation", c[2])
            for s in on("supplier", li[2]) for n in on("nation", s[2])]
    got = facts.select("l_partkey", "provider_id", "route_id", "ship_date", "order_date", "o_orderpriority", td.MONTH).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_partitioned_table_is_written_without_a_shuffle(spark):
    df = spark.range(0, 200, 1, 4).selectExpr("id", "nullif(id % 3, 0) as m")
    spark.sparkContext.setJobGroup("partitioned", "partitioned")
    try:
        out = write_checkpoint_table(df, "partitioned", ["m"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("partitioned") for s in tracker.getJobInfo(j).stageIds]
    assert len(stages) == 1
    assert _same(df, out)
