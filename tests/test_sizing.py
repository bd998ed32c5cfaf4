from freightlens.plans.sizing import partitions_for, scaled_shuffle

SF = "/root/testdata/sf0.001"


def test_partitions_for_scales_without_a_cap():
    assert partitions_for(0) == 1
    assert partitions_for(10 * 1024 ** 2) == 1
    assert partitions_for(100 * 1024 ** 4) == 614_400          # 100 TB * 3 / 512 MB
    assert partitions_for(1024 ** 4) == 6144                   # 1 TB * 3 / 512 MB


def test_scaled_shuffle_never_lowers_and_restores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with scaled_shuffle(spark, [f"{SF}/region.parquet"]) as n:
        assert n == int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
