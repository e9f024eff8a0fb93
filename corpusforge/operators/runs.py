"""Runs: failures kept apart, phases, progress, and files that belong into another folder."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def isolated(df: DataFrame, key: str, work: Callable[[dict], dict], schema: str, stage: str) -> tuple[DataFrame, DataFrame]:
    """Rows (key, fields of ``schema``) of those that ``work`` handles, and the failure log (key, stage, error) of the others:
    one bad row fails neither its batch nor the run. Both come from one plan; write it before using both."""
    kinds = T._parse_datatype_string(schema)
    names = kinds.names

    def run(frames):
        for f in frames:
            out = []
            for row in f.to_dict("records"):
                try:
                    made = work(row)
                    out.append((row[key], *[made[n] for n in names], None))
                except Exception as e:  # whatever one row raises is its own failure
                    out.append((row[key], *[None] * len(names), f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[key, *names, "_error"], dtype=object)

    shape = T.StructType([df.schema[key], *kinds.fields, T.StructField("_error", T.StringType())])
    done = df.mapInPandas(run, shape)
    return done.filter("_error is null").drop("_error"), done.filter("_error is not null").select(key, F.lit(stage).alias("stage"), F.col("_error").alias("error"))


def phases(which: str, known: dict[str, Callable[[], object]], whole: tuple[str, ...]) -> dict[str, object]:
    """Runs one phase, or for ``all`` those of ``whole`` in their order; gives their results by name."""
    if which != "all" and which not in known:
        raise ValueError(f"unknown phase {which}: one of {', '.join(['all', *known])}")
    return {name: known[name]() for name in (whole if which == "all" else (which,))}


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The rows, and their count and other metrics, which are there once an action has run; no second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]), seen


def month_moves(files: DataFrame, path: str, month: str, year: str) -> DataFrame:
    """status, detail and new_path beside each file at pdfs/year/month/name: ``moved`` where the month found differs from the
    folder's, ``unchanged``, or ``failed``. A plan: see ``move``."""
    parts = F.split(path, "/")
    now = F.get(parts, F.lit(2)).try_cast("int")
    detail = F.when((F.size(parts) < 4) | now.isNull(), "invalid path").when(F.col(month).isNull(), "could not extract month")
    status = F.when(detail.isNotNull(), "failed").when(F.col(month) == now, "unchanged").otherwise("moved")
    new = F.concat(F.lit("pdfs/"), F.col(year).cast("string"), F.lit("/"), F.lpad(F.col(month).cast("string"), 2, "0"), F.lit("/"), F.get(parts, F.lit(3)))
    return files.withColumns({"status": status, "detail": detail, "new_path": F.when(status == "moved", new)})


def move(spark: SparkSession, base: str, moves: DataFrame, path: str) -> int:
    """Renames the files of a plan below ``base``, one after the other from an iterator; how many were renamed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    n = 0
    for r in moves.filter("status = 'moved'").select(path, "new_path").toLocalIterator():
        old, new = hadoop.Path(f"{base}/{r[0]}"), hadoop.Path(f"{base}/{r[1]}")
        fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(new.getParent())
        n += bool(fs.rename(old, new))
    return n
