"""Vector operations: Column arithmetic, and nearest neighbours in tiles of bounded size."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions import text as t

TILE = 2048


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    return t.bound(norm(a), lambda n: F.transform(a, lambda x: x / (n + 1e-12)))


def cosine(a: Column, b: Column, least: float = 1e-12) -> Column:
    return F.when((norm(a) < least) | (norm(b) < least), F.lit(0.0)).otherwise(dot(a, b) / (norm(a) * norm(b)))


def best_matches(df: DataFrame, tile: int = TILE) -> DataFrame:
    """grp, i, side, j, sim: for every vector (grp, side, i, v) the most similar one of the other side of its group, the least
    index of equal ones. Groups are cut into tiles of source and target blocks, so no task holds a group and no pair
    leaves a tile but each row's best."""
    sizes = df.groupBy("grp", "side").agg(F.count("*").alias("n"))
    blocks = lambda side: sizes.filter(F.col("side") == side).select("grp", F.ceil(F.col("n") / tile).cast("int").alias(f"n{side}"))
    rows = df.join(blocks("s").join(blocks("t"), "grp"), "grp")
    mine = F.when(F.col("side") == "s", F.pmod(F.xxhash64("i"), F.col("ns"))).otherwise(F.pmod(F.xxhash64("i"), F.col("nt"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == "s", F.col("nt")).otherwise(F.col("ns")) - 1))
    rows = rows.withColumn("_mine", mine).withColumn("_other", other)
    source = F.col("side") == "s"
    rows = rows.select("grp", "side", "i", "v", F.when(source, F.col("_mine")).otherwise(F.col("_other")).alias("_sb"), F.when(source, F.col("_other")).otherwise(F.col("_mine")).alias("_tb"))

    def tile_best(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("i")
        s, u = g[g.side == "s"], g[g.side == "t"]
        if not len(s) or not len(u):
            return pd.DataFrame({"grp": [], "side": [], "i": [], "j": [], "sim": []})
        sims = np.stack(s.v.to_list()) @ np.stack(u.v.to_list()).T
        a, b = sims.argmax(axis=1), sims.argmax(axis=0)
        si, ui = s.i.to_numpy(), u.i.to_numpy()
        return pd.DataFrame({
            "grp": g.grp.iloc[0], "side": ["s"] * len(s) + ["t"] * len(u), "i": np.concatenate([si, ui]), "j": np.concatenate([ui[a], si[b]]), "sim": np.concatenate([sims[np.arange(len(s)), a], sims[b, np.arange(len(u))]]),
        })

    kind = df.schema["grp"].dataType.simpleString()
    tiles = rows.groupBy("grp", "_sb", "_tb").applyInPandas(tile_best, f"grp {kind}, side string, i long, j long, sim double")
    return tiles.groupBy("grp", "side", "i").agg(F.min_by(F.struct("j", "sim"), F.struct((-F.col("sim")).alias("s"), F.col("j").alias("j"))).alias("b")).select("grp", "side", "i", F.col("b.j").alias("j"), F.col("b.sim").alias("sim"))


def mutual(best: DataFrame, least: float = 0.70) -> DataFrame:
    """grp, i, j, sim: pairs that are each other's best, by one equi-join."""
    s = best.filter("side = 's'").select("grp", "i", "j", "sim")
    u = best.filter("side = 't'").select("grp", F.col("i").alias("j"), F.col("j").alias("i"))
    return s.join(u, ["grp", "i", "j"]).filter(F.col("sim") >= least)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def trigram_vector(s: pd.Series) -> pd.Series:
    """Counts of character trigrams in 64 hash classes: a stand-in for a sentence encoder, which isn't here."""
    return s.map(lambda x: np.bincount([zlib.crc32(x[i : i + 3].encode()) % 64 for i in range(max(1, len(x) - 2))], minlength=64).astype(float).tolist())
