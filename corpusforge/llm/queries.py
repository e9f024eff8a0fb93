"""The registered queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import egojoin, idfile, mixing, mpeg, pagetext, personal, pieces, pitmanyor, simhash, toxicity
from corpusforge.llm.common import held_out

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_digests(pieces.encode_decode(docs, tokenizer(PIECE_BPE)))


def piece_digests(df: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return df.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1_pitmanyor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 10))


def op2_pagetext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"), columns=("page_id", "url"))


def op3_egojoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = [personal.count_of("base", k).alias(f"n_{k}") for k in personal.KINDS]
    return found.select("doc_id", *count, F.sha2(personal.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), personal.joined(F.col("spans")).alias("spans"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=4, radius=4).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_idfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = idfile.read(idfile.write(docs, tokenizer(WORD_BPE), 2))
    return idfile.digests(back)


def op8_mpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = mpeg.read(mpeg.store(docs).select("doc_id", "media"))
    said = F.format_string("%s;%dHz;frames=%d;samples=%d;seconds=%.6f;crc=%d/%d;skipped=%d;vbr=%s;last=%d", "kinds", "rate", "n_frames", "samples", "duration_s", F.col("crc_checked") - F.col("crc_bad"), "crc_checked", "skipped", "vbr", F.coalesce(F.element_at("seek", -1), F.lit(-1)))
    return back.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -64)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), said.alias("feature"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 5)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~out)
    return toxicity.score(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


_ALL = (op1_pitmanyor, op2_pagetext, op3_egojoin, op4_mixing, op5_simhash, op6_personal, op7_idfile, op8_mpeg, op9_sentencepiece, op10_toxicity)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
ORACLES: dict[str, str] = {"op4_mixing": mixing.ORACLE}
