"""Corpus statistics in single passes: counts, descriptions, histograms, distributions, samples and exact splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusforge.operators.ranking import hashed, numbered


def shares(df: DataFrame, *by: str | Column) -> DataFrame:
    """Counts by keys with their percentage; the total is summed over the counted keys."""
    c = df.groupBy(*by).agg(F.count("*").alias("n"))
    total = c.agg(F.sum("n").alias("_total"))
    return c.join(F.broadcast(total)).withColumn("percent", F.round(100.0 * F.col("n") / F.col("_total"), 6)).drop("_total")  # one row


def describe(df: DataFrame, *cols: str) -> DataFrame:
    """col, n, mean, std, min, quartiles, max: exact, one row per column."""
    every = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("x")) for c in cols])).alias("e")
    x = df.select(every).select("e.*")
    q = F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    g = x.groupBy("col").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), q.alias("q"), F.max("x").alias("max"))
    return g.select("col", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min")], *[F.round(F.get("q", F.lit(i)), 6).alias(n) for i, n in enumerate(("q1", "median", "q3"))], F.round("max", 6).alias("max"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """bin, n: equal widths between least and greatest value, the last bin closed."""
    ends = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    x = df.select(F.col(col).cast("double").alias("x")).join(F.broadcast(ends))  # one row
    at = F.least(F.floor((F.col("x") - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / bins)), F.lit(bins - 1))
    return x.groupBy(F.coalesce(at, F.lit(0)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def bucket(c: Column, edges: list[float]) -> Column:
    """The number of edges at or below a value: half-open buckets."""
    return sum(((c >= e).cast("int") for e in edges[1:]), (c >= edges[0]).cast("int"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """value, n, share at or below: sums run over distinct values, dealt by ranges."""
    c = numbered(df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n")), "value", name="rank")
    # running sums inside ranks' thousands, then over those
    part = F.floor((F.col("rank") - 1) / 1000).alias("part")
    c = c.withColumn("part", part).withColumn("in_part", F.sum("n").over(W.partitionBy("part").orderBy("rank")))
    before = c.groupBy("part").agg(F.sum("n").alias("p")).withColumn("before", F.coalesce(F.sum("p").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    total = c.agg(F.sum("n").alias("total"))
    return c.join(before.select("part", "before"), "part").join(F.broadcast(total)).select("value", "n", F.round((F.col("before") + F.col("in_part")) / F.col("total"), 9).alias("share"))


def sample(df: DataFrame, n: int, *key: str, seed: str = "42") -> DataFrame:
    """The n rows of the least hashes: the sample of a seed, in any engine."""
    return df.withColumn("_h", hashed(*key, salt=seed)).orderBy("_h", *key).limit(n).drop("_h")


def sample_by(df: DataFrame, group: str, n: int, *key: str, seed: str = "42") -> DataFrame:
    """n rows per group; Spark keeps n rows of a group before it shuffles them."""
    w = W.partitionBy(group).orderBy("_h", *key)
    return df.withColumn("_h", hashed(*key, salt=seed)).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_h", "_r")


def split(df: DataFrame, *key: str, seed: str = "42", train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """``df`` with split: shuffled by hash, exact sizes int(train * n) and int(validation * n), the rest is test."""
    rows = numbered(df.withColumn("_h", hashed(*key, salt=seed)), "_h", *key, name="_r")
    n = rows.count()
    a, b = int(train * n), int(train * n) + int(validation * n)
    return rows.withColumn("split", F.when(F.col("_r") <= a, "train").when(F.col("_r") <= b, "validation").otherwise("test")).drop("_h", "_r")
