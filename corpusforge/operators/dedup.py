"""Exact and near duplicates of pairs: keep-first semantics without windows over hot keys or lists of all pairs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import text as t
from corpusforge.sources.storage import written

PRIME = 2147483647
#: So many open rows at most are decided one after the other on the driver.
FEW = 20_000


def keep_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key in a total order."""
    rows = df.withColumn("_key", key)
    first = rows.groupBy("_key").agg(F.min(F.struct(*order)).alias("_first"))
    return rows.join(first, "_key").filter(F.struct(*order) == F.col("_first")).drop("_key", "_first")


def repeated(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """``df`` with ``again``: whether an earlier row has the key."""
    rows = df.withColumn("_key", key)
    first = rows.groupBy("_key").agg(F.min(F.struct(*order)).alias("_first"))
    return rows.join(first, "_key").withColumn("again", F.struct(*order) != F.col("_first")).drop("_key", "_first")


def permutations(k: int) -> list[tuple[int, int]]:
    """Multipliers and shifts of the hash family, from a linear congruential sequence."""
    out, x = [], 12345
    for _ in range(k):
        x = (x * 1103515245 + 12345) % (1 << 31)
        a = x % (PRIME - 1) + 1
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append((a % (1 << 30), x % (1 << 30)))
    return out


#: So many n-grams at most a worker keeps with their permuted hashes (32 MB at 128 permutations); others are hashed anew.
KEPT_GRAMS = 1 << 16
HASHERS: dict[int, MinHash] = {}


def hasher(k: int) -> MinHash:
    return HASHERS.setdefault(k, MinHash(k))


class MinHash:
    """Least permuted hashes of a text's character n-grams. The grams of a language are few: their permuted hashes are kept."""

    def __init__(self, k: int, most: int = KEPT_GRAMS):
        self.a, self.b = (np.array(x, np.int64) for x in zip(*permutations(k), strict=True))
        self.most, self.at, self.table = most, {}, np.empty((256, k), np.int32)

    def permuted(self, grams: list[str]) -> np.ndarray:
        h = np.array([int.from_bytes(hashlib.md5(g.encode()).digest()[:4], "big") % PRIME for g in grams], np.int64)
        return ((h[:, None] * self.a + self.b) % PRIME).astype(np.int32)

    def remember(self, grams: list[str]) -> None:
        first, last = len(self.at), len(self.at) + len(grams)
        if last > len(self.table):
            self.table = np.resize(self.table, (max(last, 2 * len(self.table)), self.table.shape[1]))
        self.table[first:last] = self.permuted(grams)
        self.at.update(zip(grams, range(first, last), strict=True))

    def least(self, x: str | None, n: int) -> np.ndarray:
        out, x = np.full(len(self.a), PRIME, np.int32), x or ""
        grams = {x[i : i + n] for i in range(len(x) - n + 1)}
        new = [g for g in grams if g not in self.at]
        room = self.most - len(self.at)
        if new and room > 0:
            for i in range(0, min(room, len(new)), 1024):
                self.remember(new[i : min(i + 1024, room)])
        known = [i for i in map(self.at.get, grams) if i is not None]
        for i in range(0, len(known), 4096):
            np.minimum(out, self.table[known[i : i + 4096]].min(axis=0), out=out)
        for i in range(max(room, 0), len(new), 1024):
            np.minimum(out, self.permuted(new[i : i + 1024]).min(axis=0), out=out)
        return out


def signature(c: Column, k: int = 128, n: int = 3) -> Column:
    """MinHash over character n-grams; a text without any gets the constant signature of the empty set. Hashes are of 31 bits, so that
    products stay within a long."""

    @F.arrow_udf("array<bigint>")
    def sign(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for x in texts:
            rows = np.empty((len(x), k), np.int64)
            for i, s in enumerate(x):
                rows[i] = hasher(k).least(s.as_py(), n)
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, k), pa.int32()), pa.array(rows.reshape(-1)))

    return sign(F.lower(t.strip(c)))


def bands(sig: Column, b: int = 3, r: int = 42) -> Column:
    one = F.transform(F.array(sig), lambda s: F.array(*[F.md5(F.array_join(F.slice(s, i * r + 1, r).cast("array<string>"), ",").cast("binary")) for i in range(b)]))
    return F.get(one, F.lit(0))


def keyed(df: DataFrame, sides: list[str], order: str, k: int = 128, b: int = 3, r: int = 42) -> DataFrame:
    """order, keys: those of every side's bands."""
    signed = df.select(order, *[signature(F.col(s), k).alias(f"_{i}") for i, s in enumerate(sides)])
    return signed.select(order, F.concat(*[bands(F.col(f"_{i}"), b, r) for i in range(len(sides))]).alias("keys"))


def buckets(df: DataFrame, sides: list[str], order: str, k: int = 128, b: int = 3, r: int = 42) -> DataFrame:
    """order, side, band, key: the buckets of every row; ``df`` may be what ``keyed`` gave."""
    rows = df if "keys" in df.columns else keyed(df, sides, order, k, b, r)
    e = rows.select(order, F.posexplode("keys").alias("at", "key"))
    return e.select(order, F.get(F.array(*map(F.lit, sides)), F.floor(F.col("at") / b).cast("int")).alias("side"), (F.col("at") % b).alias("band"), "key")


def in_sequence(open_: DataFrame, order: str) -> DataFrame:
    """The rows (order, bucket) that the sequential rule keeps, where few are open."""
    taken, of = set(), {}
    for o, bucket in open_.select(order, "bucket").collect():
        of.setdefault(o, []).append(bytes(bucket))
    keep = []
    for o in sorted(of):
        if taken.isdisjoint(of[o]):
            taken.update(of[o])
            keep.append((o,))
    return open_.sparkSession.createDataFrame(keep, open_.select(order).schema)


def greedy(df: DataFrame, sides: list[str], order: str, k: int = 128, b: int = 3, r: int = 42, few: int = FEW) -> DataFrame:
    """Rows in order, each dropped if a bucket of it holds an earlier kept row; dropped rows occupy no bucket.

    Of rows with the same buckets only the first can stay, so that later ones leave at once; rows that share no bucket stay.
    Of the others a row that is the least of all its buckets is kept, and whatever shares a bucket with it is dropped, until
    none is open: what is open shares no bucket with a kept row, so that every round passes over the open rows alone. Buckets
    pass minima only, never pairs. Every round decides the least open row at least; chains, which settle a row a round, are
    left to the driver once ``few`` rows are open.
    """
    firsts = written(keyed(df, sides, order, k, b, r).groupBy("keys").agg(F.min(order).alias(order)))
    rows = written(buckets(firsts, sides, order, k, b, r).select(order, F.unhex(F.md5(F.concat_ws(":", "side", "band", "key").cast("binary"))).alias("bucket")))
    least = lambda e: e.groupBy("bucket").agg(F.min(order).alias("_least"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    open_ = written(rows.join(least(rows), "bucket"))
    kept = rows.select(order).distinct().join(open_.select(order).distinct(), order, "left_anti")
    while (n := open_.select(order).distinct().count()) > few:
        now = written(open_.groupBy(order).agg(F.bool_and(F.col("_least") == F.col(order)).alias("_first")).filter("_first").select(order))
        gone = open_.join(now.select(F.col(order).alias("_least")), "_least", "left_semi").select(order).distinct()
        rest = written(open_.drop("_least").join(gone, order, "left_anti"))
        lone = rest.select(order).distinct()
        kept = kept.unionByName(now)
        open_ = written(rest.join(least(rest), "bucket"))
        kept = kept.unionByName(lone.join(open_.select(order).distinct(), order, "left_anti"))
    return df.join(kept.unionByName(in_sequence(open_, order)) if n else kept, order, "left_semi")
