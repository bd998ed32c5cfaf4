from decimal import Decimal

from pyspark.sql import functions as F

from freightlens.functions import dax_divide, lane_label, mean_exact, month_label, pct, round_half_up, safe_div


def test_round_half_up_doubles_and_decimals(spark):
    df = spark.createDataFrame(
        [(0.125, Decimal("0.125"), -0.125, Decimal("-2.5"), Decimal("0.34751"))],
        "a double, b decimal(10,3), c double, e decimal(5,1), f decimal(10,5)")
    r = df.select(round_half_up("a", 2).alias("a"), round_half_up("b", 2).alias("b"),
                  round_half_up("c", 2).alias("c"), round_half_up("e", 0).alias("e"),
                  round_half_up("f", 4).alias("f"), round_half_up(F.lit(-0.001), 2).alias("z")).first()
    assert (r.a, r.b, r.c, r.e, r.f) == (0.13, 0.13, -0.13, -3.0, 0.3475)
    assert str(r.z) == "0.0"  # no negative zero


def test_round_half_up_exact_on_decimal_ties(spark):
    vals = ["0.29255", "1.00005", "2.67245", "-0.00015"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "x decimal(12,5)")
    got = [r[0] for r in df.select(round_half_up("x", 4)).collect()]
    assert got == [0.2926, 1.0001, 2.6725, -0.0002]


def test_pct_and_guards(spark):
    df = spark.createDataFrame([(3, 4), (1, 0), (None, 5)], "a int, b int")
    out = [tuple(r) for r in df.select(pct("a", "b"), safe_div("a", "b"), dax_divide("a", "b", 0.0)).collect()]
    assert out == [(75.0, 0.75, 0.75), (None, None, 0.0), (None, None, None)]


def test_mean_exact_ignores_nulls_and_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.3,)], "x double")
    rev = spark.createDataFrame([(0.3,), (None,), (0.2,), (0.1,)], "x double").repartition(3)
    # exact decimal sum 0.6, then one division: the same double in any order
    assert df.agg(mean_exact("x", 4)).first()[0] == 0.6 / 3 == rev.agg(mean_exact("x", 4)).first()[0]
    assert spark.createDataFrame([(None,)], "x double").agg(mean_exact("x", 2)).first()[0] is None


def test_lane_and_month_labels(spark):
    df = spark.createDataFrame([("Utrecht", "Lyon", "2024-03-01"), (None, "Lyon", "2023-12-01")],
                               "o string, t string, m string").withColumn("m", F.to_date("m"))
    out = [tuple(r) for r in df.select(lane_label("o", "t"), month_label("m")).collect()]
    assert out == [("Utrecht → Lyon", "2024-03"), (None, "2023-12")]


def test_mean_half_up_rounds_exact_ties_away_from_zero(spark):
    from freightlens.functions import mean_half_up, mean_parts

    df = spark.createDataFrame([("a", Decimal("0.2537")), ("a", Decimal("0.2538")),
                                ("b", Decimal("-0.2537")), ("b", Decimal("-0.2538")),
                                ("c", None), ("d", Decimal("1.5000"))], "k string, x decimal(8,4)")
    got = dict((r.k, r.m) for r in df.groupBy("k").agg(*mean_parts("x", 4, "x"))
               .select("k", mean_half_up("x", 4).alias("m")).collect())
    # 0.5075 / 2 = 0.25375 exactly: decimal ROUND gives 0.2538; a double mean would give 0.2537
    assert got == {"a": 0.2538, "b": -0.2538, "c": None, "d": 1.5}
    assert spark.range(1).select(round_half_up(F.lit(0.5075 / 2), 4)).first()[0] == 0.2537


def test_pct_half_up_is_exact_on_count_ties(spark):
    from freightlens.functions import pct_half_up

    df = spark.createDataFrame([(23, 4000), (1, 8), (2, 3), (5, 0), (None, 7)], "a bigint, b bigint")
    got = [r[0] for r in df.select(pct_half_up("a", "b", 2)).collect()]
    assert got == [0.58, 12.5, 66.67, None, None]
    # 23 of 4000 is 0.575 % exactly; the DOUBLE quotient rounds down
    assert spark.range(1).select(round_half_up(pct(F.lit(23), F.lit(4000)), 2)).first()[0] == 0.57


def test_div_half_up_is_exact_on_decimal_ties(spark):
    from freightlens.functions import div_half_up

    df = spark.createDataFrame([(Decimal("12.35"), Decimal("40.00")), (Decimal("193.05"), Decimal("550.00")),
                                (Decimal("-12.35"), Decimal("40.00")), (Decimal("10.00"), Decimal("0.00"))],
                               "c decimal(10,2), w decimal(10,2)")
    got = [r[0] for r in df.select(div_half_up("c", "w", 4)).collect()]
    assert got == [0.3088, 0.351, -0.3088, None]   # 12.35 / 40 = 0.30875 exactly


def test_large_groups_do_not_overflow(spark):
    """600 shipments of 9.9e9 in one group: exact sums and quotients."""
    from freightlens.functions.numeric import div_half_up, from_units, sum_units

    df = spark.createDataFrame([(Decimal("9900000000.01"), Decimal("3.00"))] * 600, "cost decimal(12,2), kg decimal(10,2)")
    r = df.agg(sum_units("cost").alias("c"), sum_units("kg").alias("k")).select(
        from_units("c").alias("total"), div_half_up("c", "k", 4, scale=0).alias("per_kg")).first()
    assert r.total == Decimal("5940000000006.00") and r.per_kg == 3300000000.0033


def test_dax_divide_treats_a_blank_divisor_as_zero(spark):
    from freightlens.functions.numeric import dax_divide

    df = spark.createDataFrame([(1.0, None), (1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r.x for r in df.select(dax_divide("a", "b", 7.0).alias("x")).collect()] == [7.0, 7.0, 0.25]
