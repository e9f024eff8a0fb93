"""Helpers shared by the training-data operators: shared storage, tables of intermediate rows, components."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every word definition in this package: space and bytes 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the folder that the driver and all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not base:  # one machine, as in tests
        base = tempfile.mkdtemp(prefix="forge-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/forge-{uuid.uuid4().hex}"


def stored(df: DataFrame, where: str | None = None) -> DataFrame:
    """The rows of ``df``, written as Parquet to the shared folder and read again, so that lineage ends here."""
    spark = df.sparkSession
    path = where or shared_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished jobs whose frames are no longer used."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``stored`` wrote and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def existing(spark: SparkSession, path: str) -> list[str]:
    """The path, if there is such a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return [path] if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p) else []


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else; null as empty."""
    return F.translate(F.coalesce(c, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id: Column, folds: int) -> Column:
    """True where crc32 of the id's decimal text is a multiple of ``folds`` (a null id counts as the text '')."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds) == 0


def portions(batch: pa.RecordBatch, column: int, size: int = 4_000_000, rows: int = 512):
    """The batch in slices of at most ``rows`` rows and about ``size`` bytes of a text column; a longer text is a slice of its own."""
    n = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = full = 0
    for i, x in enumerate(n.tolist()):
        if i > start and (full + x > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, full = i, 0
        full += x
    if batch.num_rows:
        yield batch.slice(start)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (id, component) per vertex that has an edge to
    another vertex, with the smallest reachable id.

    Alternating large-star and small-star steps. Each step is an aggregate of minima with partial sums and a join
    with those minima, so a vertex with very many edges is never gathered in one place; every step's edges are
    written to the shared folder.
    """
    spark = edges.sparkSession
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    path = shared_dir(spark)
    e = stored(e, f"{path}/0")
    before = None
    for i in range(1, rounds + 1):
        # large star: neighbours above u move to the least of u's closed neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: u and its lower neighbours move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = stored(small, f"{path}/{i}")
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        drop_path(spark, f"{path}/{i - 1}")
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots).distinct()


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least index of each vertex's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
