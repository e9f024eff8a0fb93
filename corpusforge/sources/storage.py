"""Shared storage for tables that cut lineage: the folder that the session's spark.checkpoint.dir names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not base:  # one machine, as in tests
        base = tempfile.mkdtemp(prefix="forge-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows written as Parquet and read again."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
