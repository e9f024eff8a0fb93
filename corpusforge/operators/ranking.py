"""Global order without a single task: row numbers from range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.sources.storage import written


def numbered(df: DataFrame, *order: str | Column, name: str = "rn") -> DataFrame:
    """``df`` with its row's number from 1 in ``order`` (a total one). Rows are dealt by ranges and sorted in place; only the
    number of rows per partition is collected. The sorted rows are written, for ranges are drawn anew in every run."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    sizes = {r.p: r.n for r in rows.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count("*").alias("n")).collect()}
    begin, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        begin.append(total)
        total += sizes.get(p, 0)
    at = F.get(F.array(*[F.lit(b).cast("long") for b in begin]), F.shiftright("_at", 33).cast("int"))
    return rows.withColumn(name, at + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; an aggregate with partial minima, not a window."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def hashed(*parts: Column | str, salt: str = "") -> Column:
    """31 random bits of the parts' text, the same in every engine: the first 8 hex digits of an MD5."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(salt)).cast("binary")), 1, 8), 16, 10).cast("long")
