"""The corpus pipeline: toxic documents go, one of each group of near copies stays, personal data is masked, sources are
mixed to their targets, and texts become ids. Each stage's rows are written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import mixing, personal, pieces, simhash, toxicity
from corpusforge.llm.common import held_out, shared_dir, stored
from corpusforge.llm.queries import PIECE_BPE, tokenizer


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, ~held_out(F.col("doc_id"), 5))
    return toxicity.score(docs, model).filter("score < 0.5").select(docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of the least id stays, of equal ids the one of the least text hash."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    groups = simhash.near_duplicates(docs.withColumn("_h", key), shingle=4, radius=4, extra=("_h",))
    groups = stored(groups, shared_dir(spark))
    kept = groups.groupBy("component").agg(F.min(F.struct("doc_id", "_h")).alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k._h").alias("_k")).distinct()
    rows = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_k")), "left_semi")
    # rows that repeat an id and a text
    again = groups.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_k"))).groupBy("_id", "_k").count().filter("count > 1")
    if again.isEmpty():
        return rows
    once = rows.join(again, F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_k")), "left_semi").dropDuplicates(["doc_id", "text"])
    return rows.join(again, F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_k")), "left_anti").unionByName(once)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to its kind; n_chars follows."""
    found = personal.find(docs)
    text = F.when(F.size("spans") > 0, personal.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    found = found.withColumn("text", text).withColumn("n_chars", F.when(F.size("spans") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and digests of ids and decoded text."""
    coded = pieces.encode_decode(docs.select("doc_id", "source", "text"), tokenizer(PIECE_BPE))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", clean), ("simhash", distinct), ("personal", masked), ("mixing", mixed), ("pieces", tokens)]
#: Kernel machines, fingerprints' components and merges have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
