"""The tables that corpus queries run on, derived from the given ones, in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import text as t
from corpusforge.operators.ranking import hashed, numbered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bitext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id, s_doc, t_doc, s_text, t_text: the n-th source document with the n-th target one, which repeat."""
    d = table(spark, sf_dir, "documents")
    s = numbered(d.filter("lang = 'en'").select("doc_id"), "doc_id")
    u = numbered(d.filter("lang in ('fr', 'de', 'es')").select("doc_id"), "doc_id")
    n = u.count()
    pairs = s.select(F.col("rn").alias("pair_id"), F.col("doc_id").alias("s_doc"), ((F.col("rn") - 1) % max(1, n) + 1).alias("rn")).join(u.withColumnRenamed("doc_id", "t_doc"), "rn").drop("rn")
    a = d.select(F.col("doc_id").alias("s_doc"), F.col("text").alias("s_text"))
    b = d.select(F.col("doc_id").alias("t_doc"), F.col("text").alias("t_text"))
    return pairs.join(a, "s_doc").join(b, "t_doc").select("pair_id", "s_doc", "t_doc", "s_text", "t_text")


def sent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id, idx, mk, sq: sentences of both sides by position, up to the shorter side."""
    b = bitext(spark, sf_dir).select("pair_id", t.sentences(F.col("s_text")).alias("a"), t.sentences(F.col("t_text")).alias("b"))
    # an outer explode of a bound value: texts are cut once, not again in filters that Spark infers from the explode
    both = t.bound(F.struct("a", "b"), lambda x: F.slice(F.arrays_zip(x["a"].alias("a"), x["b"].alias("b")), F.lit(1), F.least(F.size(x["a"]), F.size(x["b"]))))
    return b.select("pair_id", F.posexplode_outer(both).alias("idx", "p")).filter("idx is not null").select("pair_id", "idx", F.col("p")["a"].alias("mk"), F.col("p")["b"].alias("sq"))


SIGNALS = ("labse", "laser3", "comet", "bt")


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sent_pairs with four scores from hashes, and is_structural."""
    p = sent_pairs(spark, sf_dir)
    return p.select("*", *[(hashed("pair_id", "idx", salt=s) % 10001 / 10000.0).alias(s) for s in SIGNALS], (F.col("idx") % 5 != 0).alias("is_structural"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page, body, cyr, lat: a line is a page; the first half of the alphabet stands for one script, the other for the other."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("page", "body"))
    return d.select("*", t.script_ratio(F.col("body"), "a-mA-M").alias("cyr"), t.script_ratio(F.col("body"), "n-zN-Z").alias("lat"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, k, word, x0, top, x1, bottom: every word of a document on one page of rows of 20."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(t.words(F.col("text"))).alias("k", "word"))
    k = F.col("k")
    x0, top = (k % 20) * 30.0, F.floor(k / 20) * 12.0 + (k % 3) * 0.4
    return d.select("doc_id", "k", "word", x0.alias("x0"), top.alias("top"), (x0 + 25.0).alias("x1"), (top + 10.0).alias("bottom"))


def boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, boxes: those of ``boxes`` in one array a document, in the order of k."""
    at = lambda w, k: F.struct(k.cast("int").alias("k"), w.alias("word"), ((k % 20) * 30.0).alias("x0"), (F.floor(k / 20) * 12.0 + (k % 3) * 0.4).alias("top"))
    return table(spark, sf_dir, "documents").select("doc_id", F.transform(t.words(F.col("text")), at).alias("boxes"))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, body: before every fifth line stands a line with an item number; numbers repeat after 40 items."""
    lines = F.split("text", "\n")
    numbered_ = F.transform(lines, lambda s, i: F.when(i % 5 == 0, F.concat(F.lit(" "), (F.lit(100) + (i / 5).cast("int") % 40).cast("string"), F.lit(". \n"), s)).otherwise(s))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.array_join(numbered_, "\n").alias("body"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id, side, body: every third sentence begins with an article mark, some of which the target side lacks."""
    b = bitext(spark, sf_dir)

    def side(c: str, word: str, gaps: bool):
        mark = lambda s, i: F.when((i % 3 == 0) & (F.lit(not gaps) | ((i / 3).cast("int") % 7 != 0)), F.concat(F.lit(f"{word} "), ((i / 3).cast("int") + 1).cast("string"), F.lit(" "), s)).otherwise(s)
        return F.array_join(F.transform(t.sentences(F.col(c)), mark), " ")

    return b.select("pair_id", F.lit("s").alias("side"), side("s_text", "Член", False).alias("body")).unionByName(b.select("pair_id", F.lit("t").alias("side"), side("t_text", "Neni", True).alias("body")))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """grp, side, i, v (double): embeddings of a label, even ids on the source side."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("label").alias("grp"), F.when(F.col("vec_id") % 2 == 0, "s").otherwise("t").alias("side"), F.col("vec_id").alias("i"), F.col("embedding").cast("array<double>").alias("v"))


# The same views for DuckDB.
def sql_words(s: str) -> str:
    return rf"list_filter(string_split_regex({s}, '\s+'), lambda x: x <> '')"


def sql_strip(s: str) -> str:
    return rf"regexp_replace({s}, '^\s+|\s+$', '', 'g')"


def sql_sentences(s: str, ends: str = ".!?") -> str:
    cut = rf"string_split(regexp_replace({s}, '([{ends}])\s+', '\1' || chr(1), 'g'), chr(1))"
    return rf"list_filter(list_transform({cut}, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"


def sql_kept(s: str, cls: str) -> str:
    return f"length(regexp_replace({s}, '[^{cls}]', '', 'g'))"


def sql_ratio(s: str, part: str, whole: str = r"\p{L}") -> str:
    n = sql_kept(s, whole)
    return f"case when {n} > 0 then {sql_kept(s, part)} / {n} else 0.0 end"


def sql_hash(*parts: str, salt: str = "") -> str:
    return "('0x' || substr(md5(concat_ws(':', " + ", ".join([*parts, f"'{salt}'"]) + ")), 1, 8))::bigint"


BITEXT = """
s_ as (select doc_id as s_doc, text as s_text, row_number() over (order by doc_id) as rn from documents where lang = 'en'),
t_ as (select doc_id as t_doc, text as t_text, row_number() over (order by doc_id) as rn from documents where lang in ('fr', 'de', 'es')),
bitext as (select s_.rn as pair_id, s_doc, t_doc, s_text, t_text from s_ join t_ on t_.rn = (s_.rn - 1) % (select count(*) from t_) + 1)"""
PAIRS = f"""{BITEXT},
zip_ as (select pair_id, {sql_sentences("s_text")} as a, {sql_sentences("t_text")} as b from bitext),
idx_ as (select pair_id, a, b, unnest(range(least(len(a), len(b)))) as idx from zip_),
sent_pairs as (select pair_id, idx, a[idx + 1] as mk, b[idx + 1] as sq from idx_)"""
SCORED = f"""{PAIRS},
scored_pairs as (select *, {", ".join(f"{sql_hash('pair_id', 'idx', salt=s)} % 10001 / 10000.0::double as {s}" for s in SIGNALS)}, idx % 5 <> 0 as is_structural from sent_pairs)"""
PAGES = rf"""
lines_ as (select doc_id, string_split(text, chr(10)) as l from documents),
pages_ as (select doc_id, unnest(range(len(l))) as page, unnest(l) as body from lines_),
lpages as (select *, {sql_ratio("body", "a-mA-M")} as cyr, {sql_ratio("body", "n-zN-Z")} as lat from pages_)"""
BOXES = f"""
w_ as (select doc_id, {sql_words("text")} as w from documents),
k_ as (select doc_id, unnest(range(len(w))) as k, unnest(w) as word from w_),
boxes as (select doc_id, k, word, (k % 20) * 30.0::double as x0, (k // 20) * 12.0::double + (k % 3) * 0.4::double as top, (k % 20) * 30.0::double + 25.0::double as x1, (k // 20) * 12.0::double + (k % 3) * 0.4::double + 10.0::double as bottom from k_)"""
MARKED = """
ml_ as (select doc_id, lang, string_split(text, chr(10)) as l from documents),
marked as (select doc_id, lang, array_to_string(list_transform(l, lambda s, i: case when (i - 1) % 5 = 0 then ' ' || (100 + ((i - 1) // 5) % 40)::varchar || '. ' || chr(10) || s else s end), chr(10)) as body from ml_)"""
ARTICLES = f"""{BITEXT},
as_ as (select pair_id, {sql_sentences("s_text")} as a, {sql_sentences("t_text")} as b from bitext),
articles as (select pair_id, 's' as side, array_to_string(list_transform(a, lambda s, i: case when (i - 1) % 3 = 0 then 'Член ' || ((i - 1) // 3 + 1)::varchar || ' ' || s else s end), ' ') as body from as_
  union all select pair_id, 't', array_to_string(list_transform(b, lambda s, i: case when (i - 1) % 3 = 0 and ((i - 1) // 3) % 7 <> 0 then 'Neni ' || ((i - 1) // 3 + 1)::varchar || ' ' || s else s end), ' ') from as_)"""
VECTORS = "vectors as (select label as grp, case when vec_id % 2 = 0 then 's' else 't' end as side, vec_id as i, embedding::double[] as v from embeddings)"


def sql_counts(sql: str) -> str:
    """count_if is a HUGEINT in DuckDB; the count of a case is a BIGINT."""
    while (at := sql.find("count_if(")) >= 0:
        depth, quoted, end = 1, False, at + len("count_if(")
        while depth:
            c = sql[end]
            quoted ^= c == "'"
            depth += 0 if quoted else (c == "(") - (c == ")")
            end += 1
        sql = f"{sql[:at]}count(case when {sql[at + len('count_if(') : end - 1]} then 1 end){sql[end:]}"
    return sql
