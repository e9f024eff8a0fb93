"""Mixing sources to target weights by hash-threshold histograms, with DataFrame functions only.

Sources in code point order (null last) have weights that repeat; together they get ``share`` times all words. A target
stops at ``most`` times its source's words and the excess goes to the others by weight, which is the level at which
the least of cap and weight times level adds up to the budget. A source's target is a number of whole passes over it and
a rest. Documents of the rest are those whose hash lies below the source's threshold: words are summed by source and
leading hash bits, the bucket in which the rest is reached is found with sums over buckets, only documents of these
boundary buckets are summed again by the next bits, and so on until the bucket holds one hash value. No documents
are sorted, and thresholds are nested: a larger rest takes all that a smaller one takes.

A document is in the rest if the middle of its words, in hash order, lies within it. The hash is the leading 60 bits of
the MD5 of the id's decimal text, so reruns agree; rows of one id are taken or left together. Null text: size 0.
Null sources are a source. Sizes of 0 take nothing. Very long texts are counted where they stand. An empty table gives an
empty table. Columns pass through unless they have a name that is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusforge.llm.common import WORD, drop_path, shared_dir, stored

WEIGHTS = (5, 2, 1)
BITS, LEVEL = 60, 10


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """source, source_size, target, passes, rest: one row per source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # windows over the sources, one row each
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    cap = F.col("source_size") * most
    s = by_source.withColumn("weight", weight).withColumn("cap", cap)
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    above, below = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    budget = F.sum("source_size").over(everything) * F.lit(share)
    s = s.withColumn("level", (budget - F.coalesce(F.sum("cap").over(above), F.lit(0))) / F.sum("weight").over(below))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)
    s = s.withColumn("found", level["level"])
    target = F.least(F.col("cap").cast("double"), F.col("found") * F.col("weight"))
    s = s.withColumn("target", F.coalesce(target, F.col("cap").cast("double")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    s = s.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    return s.select("source", "source_size", "target", "passes", "rest")


def _matched(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    return rows.join(per_source.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")


def thresholds(sizes: DataFrame, goals: DataFrame, folder: str) -> DataFrame:
    """Per source with a rest: ``below``, the least hash that isn't taken (null: all are)."""
    todo = goals.filter("rest > 0").select("source", F.lit(0).cast("long").alias("prefix"), F.col("rest").alias("left"))
    done: DataFrame | None = None
    spark = sizes.sparkSession
    for depth in range(1, BITS // LEVEL + 1):
        down = BITS - LEVEL * depth
        rows = _matched(sizes, todo)
        rows = rows.filter(F.shiftright("h", down + LEVEL) == F.col("prefix"))
        sums = rows.groupBy("source", F.shiftright("h", down).alias("bucket")).agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"), F.first("left").alias("left"))
        w = W.partitionBy("source").orderBy("bucket")
        upto = F.sum("words").over(w)
        # at most 2^LEVEL rows a source; the boundary is the first bucket whose end isn't within the rest
        sums = sums.withColumn("before", upto - F.col("words")).withColumn("after", upto)
        edge = sums.filter("after > left").groupBy("source").agg(F.min_by(F.struct("bucket", "words", "before", "lo", "hi", "left"), "bucket").alias("b")).select("source", "b.*")
        edge = stored(edge, f"{folder}/edge{depth}")
        one = edge.filter(F.col("lo") == F.col("hi"))
        settled = one.select("source", F.when(2 * F.col("before") + F.col("words") <= 2 * F.col("left"), F.col("lo") + 1).otherwise(F.col("lo")).alias("below"))
        done = settled if done is None else done.unionByName(settled)
        todo = stored(edge.filter("lo < hi").select("source", F.col("bucket").alias("prefix"), (F.col("left") - F.col("before")).alias("left")), f"{folder}/todo{depth}")
        if todo.isEmpty():
            break
    return stored(done, f"{folder}/below") if done is not None else spark.createDataFrame([], "source string, below long")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """``docs`` with size, source_size, target, copies, and taken (words that the mix takes, repeats counted)."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    # the input's columns are fields of one, so that none clashes
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(source).cast("string").alias("source"), size_of(F.col(text)).alias("size"), hash_of(F.col(doc_id)).alias("h"))
    sizes = stored(given.select("source", "size", "h"), f"{folder}/sizes")
    goals = stored(targets(sizes, weights, share, most), f"{folder}/goals")
    below = thresholds(sizes, goals, folder).withColumnRenamed("source", "name")
    goals = stored(goals.join(below, F.col("source").eqNullSafe(F.col("name")), "left").drop("name"), f"{folder}/ends")
    drop_path(spark, f"{folder}/sizes")
    full = (F.col("rest") > 0) & F.coalesce(F.col("h") < F.col("below"), F.lit(True))
    copies = F.col("passes") + full.cast("long")
    return _matched(given, goals).select(*[F.col("row").getField(c).alias(c) for c in names], "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


#: Every step of ``mix`` for DuckDB: the thresholds by sums over all hashes instead of nested histograms.
ORACLE = """
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
             ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h from documents),
s0 as (select source, sum(size)::bigint as source_size from d group by source),
s1 as (select *, case (row_number() over (order by encode(source) nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight, 2 * source_size as cap from s0),
s2 as (select *, (sum(source_size) over () * 1.5::double - coalesce(sum(cap) over (order by cap::double / weight, encode(source) nulls last rows between unbounded preceding and 1 preceding), 0)::double)
             / sum(weight) over (order by cap::double / weight, encode(source) nulls last rows between current row and unbounded following)::double as level from s1),
s3 as (select *, (select arg_min(level, cap::double / weight) from s2 where level * weight <= cap) as found from s2),
s4 as (select source, source_size, least(cap::double, found * weight) as target from s3),
s5 as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes from s4),
s6 as (select *, target - passes * source_size as rest from s5),
g as (select source, h, sum(size) as words from d group by source, h),
p as (select source, h, words, sum(words) over (partition by source order by h) - words as before from g)
select d.doc_id, d.size, s6.source_size, s6.target, (d.size * (s6.passes + case when s6.rest > 0 and 2 * p.before + p.words <= 2 * s6.rest then 1 else 0 end))::bigint as taken
from d join s6 on d.source is not distinct from s6.source join p on p.source is not distinct from d.source and p.h = d.h
"""
