import random

from freightlens.plans.ranking import bucketed_rank, range_rank


def _plain(rows):
    out = {}
    for k in {r[0] for r in rows}:
        vals = [r[1] for r in rows if r[0] == k]
        for v in set(vals):
            smaller = sum(1 for x in vals if (x is None and False) or (v is not None and (x is None or x < v)))
            out[(k, v)] = 1 + smaller
    return out


def test_bucketed_rank_is_exact_with_a_hot_partition_ties_and_nulls(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 300))) for _ in range(3000)]          # one key, a third+ of rows
    rows += [("hot", 5.0)] * 500                                                # a hot value
    rows += [(k, float(rnd.randint(0, 20))) for k in ("a", "b", None) for _ in range(200)]
    rows += [("a", None), ("a", None), (None, None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {(r.k, r.v): r.rank for r in bucketed_rank(df, ["k"], "v", buckets=16).collect()}
    assert got == _plain(rows)
    assert bucketed_rank(df, ["k"], "v", buckets=16).count() == len(rows)


def test_range_rank_equals_the_definition(spark):
    rnd = random.Random(3)
    rows = [("hot", float(rnd.randint(0, 300))) for _ in range(2000)] + [("hot", 5.0)] * 900
    rows += [(k, float(rnd.randint(0, 20))) for k in ("a", "b", None) for _ in range(150)]
    rows += [("a", None), ("a", None), (None, None)]
    rows = [(*r, i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, v double, i int").repartition(7)
    for n in (1, 5, 40):
        out = range_rank(df.withColumn("rank", df.i), ["k"], "v", partitions=n).collect()
        assert {(r.k, r.v): r["rank"] for r in out} == _plain([r[:2] for r in rows])
        assert sorted(r.i for r in out) == list(range(len(rows)))
    assert {r["rank"] for r in range_rank(df.where("k = 'b'"), [], "v", partitions=3).collect()} <= set(range(1, 151))
    assert range_rank(df.limit(0), ["k"], "v").collect() == []


def test_range_rank_shuffles_rows_once_and_splits_a_hot_group(spark, tmp_path):
    """Ranges are stored with their partitioning: no exchange of rows when they
    are ranked, and neither the hot group nor its hot value is in one range."""
    df = spark.range(8000).selectExpr("'hot' AS k", "cast(if(id % 2 = 0, 7, id % 90) as double) AS v", "id")
    out = range_rank(df, ["k"], "v", partitions=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    rows_side = plan.split("BroadcastExchange")[0]
    assert "Bucketed: true" in rows_side and "Exchange hashpartitioning" not in rows_side and "rangepartitioning" not in rows_side
    stored = spark.read.parquet(*out.inputFiles())
    sizes = [r[0] for r in stored.groupBy("_part").count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 8000 / 8
    assert stored.where("v = 7").select("_part").distinct().count() > 2
