"""Documents to numbered items and articles, and their matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import text as t

CUT = "\x01"
#: Article marks of the first generation, and its unused marks of subsections.
ARTICLE_MK_EARLY = r"Член\s+(\d+[а-яА-Яa-zA-Z]?)|Чл\.\s*(\d+)|ЧЛЕН\s+(\d+)"
ARTICLE_SQ_EARLY = r"Neni\s+(\d+[a-zA-Zа-яА-Я]?)|NENI\s+(\d+)"
SUBSECTIONS = {"mk": (r"точка\s+(\d+)", r"Ставот?\s+(\d+)"), "sq": (r"Pika\s+(\d+)", r"Paragrafi\s+(\d+)", r"Shkronja\s+([a-zA-Z])")}


def numbered_parts(body: Column, pattern: str, number: str, keep: str = "") -> Column:
    """Array of (pos, number, body): what follows each match up to the next, after the match's part ``keep``, stripped;
    text before the first is dropped."""
    def made(parts: Column) -> Column:
        pairs = F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2))
        some = F.transform(pairs, lambda i: F.struct(((i - 1) / 2).cast("int").alias("pos"), F.get(parts, i).alias("number"), t.strip(F.get(parts, i + 1)).alias("body")))
        return F.when(F.size(parts) >= 3, some).otherwise(F.array().cast("array<struct<pos:int,number:string,body:string>>"))

    return t.bound(F.split(F.regexp_replace(body, pattern, f"{CUT}{number}{CUT}{keep}"), CUT), made)


def last_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with one key the last by position; a partial aggregate."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct("pos", "body"), "pos").alias("r")).select(*keys, "r.pos", "r.body")


def items(docs: DataFrame, keys: list[str], pattern: str = t.ITEM, least: int = 1) -> DataFrame:
    """keys, number, pos, body: numbered items; the last of a number wins, short bodies are dropped before."""
    e = docs.select(*keys, F.explode(numbered_parts(F.col("body"), pattern, "$1")).alias("x")).select(*keys, F.col("x.number").alias("number"), F.col("x.pos").alias("pos"), F.col("x.body").alias("body"))
    return last_of(e.filter(F.length("body") >= least), [*keys, "number"])


def headed_articles(docs: DataFrame, keys: list[str], word: str) -> DataFrame:
    """keys, number, pos, body: articles whose mark begins a line, the mark included; the last of a number wins."""
    e = docs.select(*keys, F.explode(numbered_parts(F.col("body"), rf"(?md)^\s*({word}\s+(\d+))", "$2", "$1")).alias("x"))
    return last_of(e.select(*keys, "x.number", "x.pos", "x.body"), [*keys, "number"])


def article_segments(docs: DataFrame, keys: list[str], pattern: str, groups: int, least: int = 10) -> DataFrame:
    """keys, pos, number (like '24a', of the first group that matches), heading, start, end, body: every article of at least
    ``least`` characters, with its offsets, the mark included; a text without marks, unless blank, is article '0'.
    ``keys`` name one row each."""
    number = "".join(f"${k}" for k in range(1, groups + 1))

    def made(parts: Column) -> Column:
        part = lambda pos, number, heading, raw, before: F.struct(pos.alias("pos"), number.alias("number"), heading.alias("heading"), F.length(raw).alias("n"), t.strip(raw).alias("body"), before.alias("before"))
        at = F.sequence(F.lit(1), F.greatest(F.size(parts) - 3, F.lit(1)), F.lit(3))
        first = F.get(parts, F.lit(0))
        some = F.transform(at, lambda i: part(((i - 1) / 3).cast("int"), F.get(parts, i), F.get(parts, i + 1), F.get(parts, i + 2), F.length(first)))
        return F.when(F.size(parts) >= 4, some).otherwise(F.array(part(F.lit(0), F.lit("0"), F.lit(""), first, F.lit(0))))

    parts = F.split(F.regexp_replace("body", pattern, f"{CUT}{number}{CUT}$0{CUT}"), CUT)
    e = docs.select(*keys, F.explode(t.bound(parts, made)).alias("x")).select(*keys, "x.*")
    span = F.length("heading") + F.col("n")
    end = F.col("before") + F.sum(span).over(Window.partitionBy(*keys).orderBy("pos"))
    e = e.withColumn("end", end).withColumn("start", F.col("end") - span)
    whole = (F.col("heading") == "") & (F.col("body") != "")
    return e.filter(whole | ((F.col("heading") != "") & (F.length("body") >= least))).select(*keys, "pos", "number", "heading", "start", "end", "body")


def subsections(docs: DataFrame, keys: list[str], language: str) -> DataFrame:
    """keys, kind (of the marks of ``language``), pos, number: marks of points, paragraphs and letters in order of each kind."""
    def of(kind: int, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all("body", F.lit(pattern), F.lit(1)), lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x.alias("number")))

    found = [of(k, p) for k, p in enumerate(SUBSECTIONS[language])]
    return docs.select(*keys, F.explode(F.concat(*found)).alias("x")).select(*keys, "x.*")


def matched(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides by number: kind both, source or target (a full outer join)."""
    x = a.select(*keys, F.col("body").alias("s_body"))
    y = b.select(*keys, F.col("body").alias("t_body"))
    kind = F.when(F.col("s_body").isNull(), "target").when(F.col("t_body").isNull(), "source").otherwise("both")
    return x.join(y, keys, "full_outer").withColumn("kind", kind)


def matched_or_whole(a: DataFrame, b: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """Matched items; documents without items on either side are one item of number 0."""
    some = a.select(key).union(b.select(key)).distinct()
    rest = whole.join(some, key, "left_anti")
    m = matched(a, b, [key, "number"]).filter("kind = 'both'").select(key, "number", "s_body", "t_body")
    return m.unionByName(rest.select(key, F.lit("0").alias("number"), F.col("s_text").alias("s_body"), F.col("t_text").alias("t_body")))
