"""Readers and writers of pair tables: delimited text, JSON and Parquet, checkpoints and logs."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.operators.ranking import numbered
from corpusforge.sources.storage import shared_folder

#: Options by format. Quoted tables double their quotes; bare ones have none, and fields may not hold tabs or line feeds.
FORMATS: dict[str, tuple[str, dict[str, str]]] = {
    "csv": ("csv", {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}),
    "csv_quoted": ("csv", {"header": "true", "quote": '"', "escape": '"', "quoteAll": "true", "multiLine": "true"}),
    "tsv": ("csv", {"header": "true", "sep": "\t", "quote": '"', "escape": '"', "multiLine": "true"}),
    "tsv_bare": ("csv", {"header": "true", "sep": "\t", "quote": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}),
    "jsonl": ("json", {}), "parquet": ("parquet", {}), "orc": ("orc", {}),
}


def flat(df: DataFrame) -> DataFrame:
    """Tabs and line feeds of texts to spaces."""
    return df.select(*[F.translate(f.name, "\t\n\r", "   ").alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])


def write(df: DataFrame, path: str, kind: str, mode: str = "errorifexists", by: tuple[str, ...] = ()) -> None:
    name, options = FORMATS[kind]
    (flat(df) if kind == "tsv_bare" else df).write.mode(mode).partitionBy(*by).options(**options).format(name).save(path)


def read(spark: SparkSession, path: str, kind: str, schema: T.StructType) -> DataFrame:
    """With an explicit schema; numbers that don't parse become null."""
    name, options = FORMATS[kind]
    if name != "csv":
        return spark.read.options(**options).schema(schema).format(name).load(path)
    raw = spark.read.options(**options).schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])).csv(path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def round_trip(df: DataFrame, kind: str) -> DataFrame:
    path = shared_folder(df.sparkSession)
    write(df, path, kind)
    return read(df.sparkSession, path, kind, df.schema)


def documents_of(spark: SparkSession, folder: str, suffix: str = "pdf", limit: int | None = None) -> DataFrame:
    """path, doc_id, length, content: files below a folder; the id joins the path below ``pdfs`` by underscores. With a limit
    the first ones in order of path, which are found from the listing alone; contents are read for those only."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").load(folder)
    if limit is not None:
        f = f.join(f.select("path").orderBy("path").limit(limit), "path", "left_semi")
    below = F.regexp_extract("path", rf"/pdfs/(.*)\.{suffix}$", 1)
    name = F.when(below != "", F.translate(below, "/", "_")).otherwise(F.regexp_extract("path", rf"([^/]+)\.{suffix}$", 1))
    return f.select("path", name.alias("doc_id"), "length", "content")


def missing_files(spark: SparkSession, source: str, target: str, suffix: str = "pdf") -> DataFrame:
    """path, doc_id, length: files of one folder that another doesn't hold yet, from the listings alone."""
    have = documents_of(spark, target, suffix).select("doc_id")
    return documents_of(spark, source, suffix).select("path", "doc_id", "length").join(have, "doc_id", "left_anti")


def json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON array; damaged files give no rows."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.inline(F.from_json("value", T.ArrayType(schema))))


def log(df: DataFrame, path: str, cut: tuple[str, ...] = ("mk", "sq"), size: int = 200) -> None:
    """Appends rows to a log, long texts cut, scores to four digits."""
    cols = [F.substring(f.name, 1, size).alias(f.name) if f.name in cut else F.round(f.name, 4).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema]
    df.select(*cols).write.mode("append").json(path)


def pending(df: DataFrame, path: str, key: str) -> DataFrame:
    """Rows whose key a checkpoint table doesn't hold yet; all where there is none."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return df
    return df.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")


#: Texts that a tolerant table reader takes for missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def tolerant_tsv(spark: SparkSession, path: str, texts: tuple[str, ...] = ("mk", "sq"), number: str = "confidence") -> DataFrame:
    """All columns as texts under stripped names; missing ``texts`` are empty, a ``number`` that is none is 0.0."""
    _, options = FORMATS["tsv"]
    raw = spark.read.options(**options).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    known = {c: F.when(~F.col(c).isin(*MISSING), F.col(c)) for c in raw.columns}
    return raw.select(*[F.coalesce(x, F.lit("")).alias(c) if c in texts else F.coalesce(x.try_cast("double"), F.lit(0.0)).alias(c) if c == number else x.alias(c) for c, x in known.items()])


#: Aligned pairs of a document with the value of a missing field; texts and article numbers have none.
ALIGNED = T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("mk", "sq", "pdf_id")], *[T.StructField(n, T.LongType()) for n in ("item_number", "article_number")], *[T.StructField(n, T.StringType()) for n in ("alignment_strategy", "layout_type")],
    *[T.StructField(n, T.LongType()) for n in ("mk_word_count", "sq_word_count")], T.StructField("is_structural", T.BooleanType()),
])
DEFAULTS = {"pdf_id": "", "item_number": 0, "alignment_strategy": "", "layout_type": "", "mk_word_count": 0, "sq_word_count": 0, "is_structural": False}


def aligned(spark: SparkSession, path: str) -> DataFrame:
    """Aligned pairs from JSON lines, one file or a checkpoint by document; missing fields get their defaults, blank lines none."""
    raw = spark.read.schema(ALIGNED).option("mode", "FAILFAST").json(path)
    return raw.select(*[F.coalesce(c, F.lit(DEFAULTS[c])).alias(c) if c in DEFAULTS else F.col(c) for c in ALIGNED.names])


def checkpoint_documents(df: DataFrame, path: str, key: str = "pdf_id") -> None:
    """JSON lines in a folder for each document; a document that is written again replaces its own folder only."""
    df.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy(key).json(path)


def shortest(c: Column) -> Column:
    """A double as its shortest digits, in exponential form below 0.0001 only."""
    plain = F.regexp_replace(c.cast("decimal(20,16)").cast("string"), "0+$", "")
    small = F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.0)?E", "e"), r"e-(\d)$", "e-0$1")
    return F.when((F.abs(c) < 0.001) & (F.abs(c) >= 0.0001), plain).when((F.abs(c) < 0.0001) & (c != 0), small).otherwise(c.cast("string"))


def early_table(df: DataFrame) -> DataFrame:
    """mk, sq and meta (source, article, confidence, method) as the first generation's flat table; missing fields are empty."""
    meta = {"source_issue": "source", "article_id": "article", "confidence": "confidence", "alignment_method": "method"}
    kinds = {f.name: f.dataType for f in df.schema["meta"].dataType}
    text = lambda f: F.lit(None) if f not in kinds else shortest(F.col(f"meta.{f}")) if isinstance(kinds[f], T.DoubleType) else F.col(f"meta.{f}").cast("string")
    return df.select(F.col("mk").alias("mk_sentence"), F.col("sq").alias("sq_sentence"), *[F.coalesce(text(f), F.lit("")).alias(n) for n, f in meta.items()])


def write_json_array(df: DataFrame, path: str, *order: str) -> None:
    """One JSON array of objects in ``order`` (a total one), an object a line, in parts whose texts follow each other by name."""
    rows = numbered(df, *order, name="_rn")
    n = rows.count()
    item = F.concat(F.when(F.col("_rn") == 1, "[").otherwise(","), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    end = df.sparkSession.range(1).select(F.lit(n + 1).alias("_rn"), F.lit("]" if n else "[]").alias("value"))
    rows.select("_rn", item.alias("value")).unionByName(end).orderBy("_rn").select("value").write.text(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of an array that has one a line; lines are read side by side."""
    lines = spark.read.text(path).filter(~F.col("value").isin("]", "[]", "[", ""))
    return lines.select(F.from_json(F.regexp_replace("value", r"^[\[,]|,$", ""), schema).alias("x")).select("x.*")


def export(df: DataFrame, folder: str, name: str, formats: str = "tsv,jsonl", simple: bool = False, order: tuple[str, ...] = ("mk", "sq")) -> dict[str, str]:
    """Writes each known format of a comma-separated list to ``folder/name.format``; ``simple`` keeps the two texts. Unknown
    formats are logged and left out. Rows of equal ``order`` may change places in a JSON array."""
    df = df.select("mk", "sq") if simple else df
    made = {}
    for kind in (f.strip().lower() for f in formats.split(",")):
        path = f"{folder}/{name}.{kind}"
        if kind == "json":
            write_json_array(df, path, *order)
        elif kind in ("tsv", "csv", "jsonl", "parquet"):
            write(df, path, kind)
        else:
            logging.getLogger(__name__).warning("unknown format: %s", kind)
            continue
        made[kind] = path
    return made
