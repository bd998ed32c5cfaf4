"""Map the driver's TPC-H-like tables onto the five core tables.

Mapping (kept fixed so results stay comparable between rounds):

* provider  = supplier nation (25 rows): ``provider_id = n_nationkey``,
  ``provider_name = n_name``, ``sla_threshold = 60 + 3 * (n_nationkey % 5)``.
* route     = a pair of regions that occurs in the shipments, the supplier's
  (``origin_city``) and the customer's (``dest_city``):
  ``route_id = 1000 * origin region key + destination region key``.
* shipment  = one lineitem: provider from its supplier, route from its
  supplier and its order's customer.  A line with an unknown order, customer
  or supplier stays, with a NULL provider or route.  ``status`` is Delayed for return flag R, else
  Delivered; ``delay_reason`` is the order priority of delayed lines;
  ``customer_complaint`` is line status O; ``weight_kg = l_quantity``,
  ``total_cost_eur = l_extendedprice``, ``promised_delivery = o_orderdate``,
  ``shipment_date = actual_delivery = l_shipdate``.  ``shipment_id =
  l_orderkey * 100 + l_linenumber`` is not unique in the test data; the
  integrity report shows it.
* quotes    = a rate card per provider x route x weight band, derived from
  the shipments of that band: lowest price per unit, highest tax as fuel
  surcharge, highest discount as volume discount.  Bands by quantity:
  ``0-15``, ``15-35``, ``35+`` with minima 0, 15, 35.
* commodity_type = the part type of the line.
* performance_history = the monthly roll-up of the shipments (C13).

Every table is a lazy DataFrame over the parquet files, so Catalyst prunes
columns down to what each query reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions.numeric import round_half_up, safe_div
from freightlens.plans.bucketing import store_bucketed

# Tables read by the shipment-fact build.
FACT_SOURCES = ("lineitem", "orders", "customer", "supplier", "nation")

# Weight bands of the derived rate card: upper bounds of the first two bands.
BAND_BOUNDS = (15, 35)


# Types of the source tables: a scan does not take them from the files, and a
# file with another type is an error.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return n.select(F.col("n_nationkey").cast("int").alias("provider_id"),
                    F.col("n_name").alias("provider_name"),
                    (F.lit(60) + F.lit(3) * (F.col("n_nationkey") % 5)).cast("double").alias("sla_threshold"))


# route_id = ROUTE_BASE * origin region key + destination region key
ROUTE_BASE = 1000


def routes_from_facts(facts: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routes that occur in the shipments, with both ends."""
    r = _read(spark, sf_dir, "region", "r_regionkey", "r_name")
    ids = facts.where(F.col("route_id").isNotNull()).select("route_id").distinct()
    end = lambda key, name: r.select(F.col("r_regionkey").cast("int").alias(key), F.col("r_name").alias(name))
    return (ids.withColumn("_o", F.floor(F.col("route_id") / ROUTE_BASE).cast("int")).withColumn("_d", F.col("route_id") % ROUTE_BASE)
            .join(end("_o", "origin_city"), "_o").join(end("_d", "dest_city"), "_d").select("route_id", "origin_city", "dest_city"))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes_from_facts(shipment_facts(spark, sf_dir), spark, sf_dir)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                 "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                 "l_linestatus", "l_shipdate")


def _regions(spark: SparkSession, sf_dir: str, key: str, name: str) -> DataFrame:
    nr = _read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    return nr.select(F.col("n_nationkey").alias(key), F.col("n_regionkey").cast("int").alias(name))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with the region they go to."""
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "left").join(_regions(spark, sf_dir, "c_nationkey", "_dest"), "c_nationkey", "left")
            .select("o_orderkey", "o_orderdate", "o_orderpriority", "_dest"))


def bucketed_sources(spark: SparkSession, sf_dir: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Lines and orders stored in equally many buckets of the order key: every
    later join of the two, and every grouping by order, runs without a shuffle."""
    return (store_bucketed(_lines(spark, sf_dir), "lines", ["l_orderkey"], buckets),
            store_bucketed(_orders(spark, sf_dir), "orders", ["o_orderkey"], buckets))


def enriched_lines(spark: SparkSession, sf_dir: str, stored: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Every lineitem with provider, route and order attributes attached.

    Left joins throughout: no line is lost to a missing or unknown key.
    ``orders ⋈ customer``, ``lineitem ⋈ orders`` and ``lineitem ⋈ supplier``
    are joins between tables that grow with the data: the planner shuffles
    both sides on the key, or broadcasts a side that its size estimate (or
    AQE, at run time) finds small.  The suppliers, the smaller of the two, come
    after the orders and without their region: their stage has ended, with its
    true size, before the lines would be shuffled once more for them.  Times
    become dates before the shuffle.  With ``stored`` (``bucketed_sources``)
    the lines meet their orders without an exchange on either side.
    """
    li, orders = stored or (_lines(spark, sf_dir), _orders(spark, sf_dir))
    li = li.withColumn("l_shipdate", F.to_date("l_shipdate"))
    orders = orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
    s = _read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
            .join(s, li.l_suppkey == s.s_suppkey, "left")
            .join(_regions(spark, sf_dir, "s_nationkey", "_origin"), "s_nationkey", "left")
            .withColumn("provider_id", F.col("s_nationkey").cast("int"))
            .withColumn("route_id", F.col("_origin") * ROUTE_BASE + F.col("_dest")))


RATE_COLUMNS = ("l_quantity", "l_extendedprice", "l_tax", "l_discount")


# The facts are stored by the month of their ship date.
MONTH = "ship_month"


def shipment_facts(spark: SparkSession, sf_dir: str, stored: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per lineitem with the join results attached: the narrow set
    of raw columns from which every shipments column and the rate card are
    derived.  This is what gets materialised; derived columns are computed
    on read, so columns no query uses are neither stored nor read.
    ``ship_month``, the first day of the month, is the partition column;
    ``stored`` as in ``enriched_lines``."""
    e = enriched_lines(spark, sf_dir, stored)
    return e.select(
        "l_orderkey", "l_linenumber", "provider_id", "route_id",
        F.col("l_shipdate").alias("ship_date"), F.col("o_orderdate").alias("order_date"),
        *RATE_COLUMNS, "l_returnflag", "l_linestatus", "o_orderpriority", "l_partkey", F.trunc("l_shipdate", "month").alias(MONTH))


def facts_in_months(facts: DataFrame, months: list | DataFrame) -> DataFrame:
    """The facts of the chosen months (first days, or a DataFrame with a column
    ``ship_month``).  Stored facts are pruned to those partitions: by the plan
    for a list, at run time for a DataFrame (dynamic partition pruning)."""
    if isinstance(months, DataFrame):
        return facts.join(months.select(MONTH), MONTH, "left_semi")
    return facts.where(F.col(MONTH).isin(list(months)))


def with_part_type(facts: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts with ``p_type``, for the one query that returns it."""
    p = _read(spark, sf_dir, "part", F.col("p_partkey").alias("l_partkey"), "p_type")
    return facts.join(p, "l_partkey", "left")


def shipments_from_facts(facts: DataFrame) -> DataFrame:
    """The shipments table (reference schema) derived from the facts;
    ``commodity_type`` is NULL unless the facts have ``p_type``."""
    delayed = F.col("l_returnflag") == "R"
    return facts.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("shipment_id"),
        "provider_id",
        "route_id",
        F.col("ship_date").alias("shipment_date"),
        F.col("l_quantity").cast("decimal(10,2)").alias("weight_kg"),
        F.lit(None).cast("decimal(8,3)").alias("volume_cbm"),
        (F.col("p_type") if "p_type" in facts.columns else F.lit(None).cast("string")).alias("commodity_type"),
        F.col("order_date").alias("promised_delivery"),
        F.col("ship_date").alias("actual_delivery"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(12,2)").alias("freight_cost_eur"),
        (F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(12,2)").alias("fuel_surcharge_eur"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("total_cost_eur"),
        F.when(delayed, F.lit("Delayed")).otherwise(F.lit("Delivered")).alias("status"),
        F.when(delayed, F.col("o_orderpriority")).alias("delay_reason"),
        (F.col("l_linestatus") == "O").alias("customer_complaint"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments_from_facts(shipment_facts(spark, sf_dir))


def weight_band(qty, bounds=BAND_BOUNDS):
    """Band label and band minimum for a quantity: ``0-a``, ``a-b``, ``b+``."""
    q = F.col(qty) if isinstance(qty, str) else qty
    lo, hi = bounds
    label = (F.when(q < lo, F.lit(f"0-{lo}")).when(q < hi, F.lit(f"{lo}-{hi}"))
             .otherwise(F.lit(f"{hi}+")))
    minimum = (F.when(q < lo, F.lit(0)).when(q < hi, F.lit(lo)).otherwise(F.lit(hi))).cast("decimal(8,2)")
    return label, minimum


def quotes_from_facts(facts: DataFrame) -> DataFrame:
    """Rate card per provider x route x weight band (partial aggregation
    map-side, so a hot provider does not concentrate rows in one task)."""
    band, minimum = weight_band("l_quantity")
    return (facts.withColumn("weight_band_kg", band).withColumn("min_shipment_kg", minimum)
            .groupBy("provider_id", "route_id", "weight_band_kg", "min_shipment_kg")
            .agg(round_half_up(F.min(safe_div("l_extendedprice", "l_quantity")), 4)
                 .cast("decimal(12,4)").alias("base_rate_eur_per_kg"),
                 round_half_up(F.max("l_tax") * 100, 2).cast("decimal(5,2)").alias("fuel_surcharge_pct"),
                 round_half_up(F.max("l_discount") * 100, 2).cast("decimal(5,2)").alias("volume_discount_pct"),
                 F.min("ship_date").alias("effective_date"),
                 F.max("ship_date").alias("expiry_date"))
            .withColumn("quote_source", F.lit("shipment history")))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_from_facts(shipment_facts(spark, sf_dir))


def lead_time_days():
    """Lead time per shipment in the test data: |actual - promised| in days."""
    return F.abs(F.datediff("actual_delivery", "promised_delivery"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from freightlens.operators.service import roll_up_history

    return roll_up_history(shipments(spark, sf_dir), providers(spark, sf_dir), lead_days=lead_time_days())
