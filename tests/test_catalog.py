import os

import pytest

from freightlens import catalog
from freightlens.sources import testdata as td

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_inputs_are_built_once_per_application(spark):
    a = catalog.inputs(spark, SF)
    assert catalog.inputs(spark, SF + "/") is a
    assert a.facts is a.facts and a.history is a.history


def test_materialised_tables_live_in_the_checkpoint_folder(spark):
    i = catalog.inputs(spark, SF)
    base = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    files = i.facts.inputFiles()
    assert files and all(base in f for f in files)
    # the small tables are parquet in the same folder, kept in memory on top
    for df in (i.history, i.quotes, i.providers, i.routes):
        assert df.storageLevel.useMemory and df.storageLevel.useDisk
        assert base in df._jdf.queryExecution().executedPlan().toString()


def test_facts_store_only_the_raw_joined_columns(spark):
    cols = catalog.inputs(spark, SF).facts.columns
    assert "total_cost_eur" not in cols and "freight_cost_eur" not in cols
    assert set(td.RATE_COLUMNS) <= set(cols)
    # every shipments column is derived on read
    assert td.shipments_from_facts(catalog.inputs(spark, SF).facts).columns[:3] == \
        ["shipment_id", "provider_id", "route_id"]


def test_lazy_inputs_write_nothing(spark):
    i = catalog.Inputs(spark, SF, materialize=False)
    assert all("freightlens" not in f for f in i.history.inputFiles())


def test_cluster_needs_a_shared_checkpoint_folder():
    from freightlens.session import ensure_checkpoint_dir

    assert "shared" in ensure_checkpoint_dir.__doc__
