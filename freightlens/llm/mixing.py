"""Mixing sources to target weights by Poisson replication.

A source of ``size`` characters with target weight ``w`` gets the mean rate
w * total / size.  Each document's number of copies is the inverse of the
Poisson distribution with that mean at a uniform value drawn from a hash of
the seed and the id, so it does not depend on partitioning, order or retries.
Documents are exploded by their count and dealt over the cluster by a hash of
(seed, id, copy), by which the rows of every partition are also sorted: a
random order that no source, however large, can crowd.

Everything runs on built-in functions.  A mean above ``PART`` is a sum of
independent parts, as exp(-mean) would vanish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import Scratch

PART = 500.0
SEED = 17
# The cumulative table of a source reaches this many standard deviations beyond the mean.
REACH = 12
# Production weights of the registered query; the other sources share the rest evenly.
WEIGHTS = {"src0": 0.20, "src1": 0.10, "src2": 0.10, "src3": 0.02}


def uniform(*parts: Column) -> Column:
    """A value in (0, 1) from 52 bits of a hash of the parts."""
    return (bits(*parts) + F.lit(0.5)) / F.lit(float(1 << 52))


def bits(*parts: Column) -> Column:
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def rates(docs: DataFrame, weights: dict[str, float], epochs: float = 1.0) -> DataFrame:
    """``source, size, rate``: mean copies of a document of each source.

    ``weights`` are shares of the output in characters; sources that it does
    not name share what is left evenly.  The output is ``epochs`` times the
    input's characters in the mean.  A source without characters has rate 0."""
    size = docs.groupBy("source").agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("double").alias("size"))
    named = F.lit(None).cast("double")
    for name, w in weights.items():
        named = F.when(F.col("source") == name, F.lit(float(w))).otherwise(named)
    size = size.withColumn("named", named)
    whole = size.agg(F.struct(F.sum("size").alias("total"), F.sum("named").alias("taken"),
                              F.sum(F.when(F.col("named").isNull(), 1.0)).alias("others"))).scalar()
    size = size.withColumn("whole", whole).select("*", "whole.*")
    share = F.coalesce("named", (F.lit(1.0) - F.coalesce("taken", F.lit(0.0))) / F.col("others"))
    return size.select(
        "source", "size", F.when(F.col("size") > 0, F.greatest(F.lit(0.0), share) * F.lit(float(epochs)) * F.col("total") / F.col("size"))
        .otherwise(0.0).alias("rate"))


def with_tables(rate: DataFrame) -> DataFrame:
    """``parts``: the number of equal parts of the rate; ``cdf``: the cumulative
    Poisson probabilities of one part, from 0 on."""
    mean = F.col("rate") / F.col("parts")
    last = F.ceil(mean + REACH * F.sqrt(mean) + REACH).cast("int")
    step = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf")),
        lambda acc, k: F.struct((acc["p"] * mean / k).alias("p"),
                                F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * mean / k)).alias("cdf")),
        lambda acc: acc["cdf"])
    return rate.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int"))).withColumn("cdf", step)


def replicate(docs: DataFrame, weights: dict[str, float], scratch: Scratch, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """``docs`` exploded to ``copies`` rows each and shuffled, with ``copy`` (from
    1), ``copies`` and ``shuffle_key``.

    Null sources are one source; null or empty texts count no characters but
    are drawn like the others of their source; a null id draws as one id;
    repeated rows draw alike; columns of these three names are replaced, the
    others stay; an empty table stays empty.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("copy", "copies", "shuffle_key")])
    table = scratch.write(with_tables(rates(docs, weights, epochs)).coalesce(1), "rates")  # a row per source: the planner sees its size
    table = table.select(F.struct("source", "parts", "cdf").alias("__mix"))
    drawn = docs.join(table, docs["source"].eqNullSafe(F.col("__mix.source")))
    draw = lambda part: uniform(F.lit(seed), part, F.col("doc_id"))
    copies = F.aggregate(F.sequence(F.lit(1), F.col("__mix.parts")), F.lit(0),
                         lambda acc, part: acc + F.size(F.filter("__mix.cdf", lambda c: c < draw(part))))
    return (drawn.withColumn("copies", copies.cast("int")).where("copies > 0").drop("__mix")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .withColumn("shuffle_key", bits(F.lit(seed), F.lit("order"), F.col("doc_id"), F.col("copy")))
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy"))
