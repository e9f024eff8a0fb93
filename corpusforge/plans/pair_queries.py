"""Queries of alignment, vectors, scoring and duplicates, with DuckDB forms where SQL has them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusforge.functions import text as t
from corpusforge.operators import align, dedup, score, segment, vectors
from corpusforge.operators.ranking import numbered
from corpusforge.plans import views as v
from corpusforge.plans.text_queries import md5
from corpusforge.sources.storage import written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = v.sql_counts(sql)
        return f

    return add


def sides(spark, sf, ends=".!?;"):
    b = v.bitext(spark, sf)
    return b.select("pair_id", t.sentences(F.col("s_text"), ends).alias("a"), t.sentences(F.col("t_text"), ends).alias("b"))


@query()
def align_gale_church(spark, sf):
    return align.align(sides(spark, sf), ["pair_id"], "gale_church").withColumn("cost", F.round("cost", 6))


@query()
def align_gale_church_early(spark, sf):
    """With the confidence that the first generation gives a pair's distance."""
    a = align.align(sides(spark, sf, ".!?"), ["pair_id"], "early_gale_church")
    return a.withColumns({"confidence": t.cost_confidence(F.col("cost")), "confidence_whole": t.cost_confidence(F.col("cost"), True)}).withColumn("cost", F.round("cost", 6))


def matched_articles(spark, sf):
    a = v.articles(spark, sf)
    x = segment.items(a.filter("side = 's'"), ["pair_id"], t.ARTICLE_MK, 5)
    y = segment.items(a.filter("side = 't'"), ["pair_id"], t.ARTICLE_SQ, 5)
    m = segment.matched(x, y, ["pair_id", "number"]).filter("kind = 'both'")
    return m.select("pair_id", F.col("number").cast("int").alias("article"), t.sentences(F.col("s_body"), ".!?;").alias("a"), t.sentences(F.col("t_body"), ".!?;").alias("b"))


@query()
def align_articles(spark, sf):
    return align.align(matched_articles(spark, sf), ["pair_id", "article"], "article").withColumn("cost", F.round("cost", 6))


@query()
def align_articles_early(spark, sf):
    """By position where counts agree, by lengths where they differ by two at most, else cut to the shorter side."""
    m = matched_articles(spark, sf)
    diff, n = F.abs(F.size("a") - F.size("b")), F.least(F.size("a"), F.size("b"))
    zipped = m.filter((diff == 0) | (diff > 2)).select("pair_id", "article", F.when(diff == 0, 0.9).otherwise(0.5).alias("confidence"), F.posexplode(F.slice(F.arrays_zip("a", "b"), F.lit(1), n)).alias("idx", "p"))
    zipped = zipped.select("pair_id", "article", F.col("p.a").alias("mk"), F.col("p.b").alias("sq"), F.array("idx").alias("mk_indices"), F.array("idx").alias("sq_indices"), F.lit("1-1").alias("move"), "confidence")
    close = align.align(m.filter((diff > 0) & (diff <= 2)), ["pair_id", "article"], "early_article").withColumn("confidence", F.when(F.col("move") == "1-1", 0.85).otherwise(0.75))
    return zipped.unionByName(close.drop("cost"))


@query()
def align_cascade(spark, sf):
    """Articles first; documents without an aligned article by dense retrieval if it gives three pairs; the rest by Gale-Church."""
    whole = sides(spark, sf)
    by_article = written(align.align(matched_articles(spark, sf), ["pair_id", "article"], "article").select("pair_id", "article", "mk", "sq", F.lit("structural").alias("strategy")))
    rest = whole.join(by_article.select("pair_id").distinct(), "pair_id", "left_anti")
    no_article = F.lit(None).cast("int").alias("article")
    by_vector = written(align.dense(rest, "pair_id", vectors.trigram_vector).select("pair_id", no_article, "mk", "sq", F.lit("dense_retrieval").alias("strategy")))
    rest = rest.join(by_vector.select("pair_id").distinct(), "pair_id", "left_anti")
    by_length = align.align(rest, ["pair_id"], "gale_church").select("pair_id", no_article, "mk", "sq", F.lit("gale_church").alias("strategy"))
    return by_article.unionByName(by_vector).unionByName(by_length)


@query(f"""with {v.PAIRS}, l as (select pair_id, idx, length(mk)::double as a, length(sq)::double / 1.1::double as b, length(sq) as n from sent_pairs)
select pair_id, idx, round(abs((a - b) / sqrt((a + b) / 2 * 6.8::double)) + ln(2.0::double), 6) as early, round(-ln(0.89::double + 1e-12) + pow(ln(a / n / 1.1::double), 2) / 6.8::double, 6) as cost from l""")
def align_length_costs(spark, sf):
    s = v.sent_pairs(spark, sf)
    a, n = F.length("mk").cast("double"), F.length("sq").cast("double")
    b = n / 1.1
    early = F.abs((a - b) / F.sqrt((a + b) / 2 * 6.8)) + F.log(F.lit(2.0))
    return s.select("pair_id", F.col("idx").cast("long").alias("idx"), F.round(early, 6).alias("early"), F.round(-F.log(F.lit(0.89 + 1e-12)) + F.pow(F.log(a / n / 1.1), 2) / 6.8, 6).alias("cost"))


@query(f"""with {v.VECTORS}, s as (select *, row_number() over (partition by grp order by i) as r from vectors), n as (select grp, i, v, lead(v) over (partition by grp order by i) as w from s)
select grp, i, round(list_inner_product(v, w), 9) as dot, round(list_cosine_similarity(v, w), 9) as cosine, round(least(list_inner_product(v, w), list_inner_product(w, v)), 9) as both, round(v[1] / (sqrt(list_inner_product(v, v)) + 1e-12), 9) as first_unit, case when list_cosine_similarity(v, w) >= 0.80 then '' else 'low_doc_sim' end as gate from n where w is not null""")
def vector_pairs(spark, sf):
    w = Window.partitionBy("grp").orderBy("i")
    n = v.vectors(spark, sf).select("grp", "i", "v", F.lead("v").over(w).alias("w")).filter("w is not null")
    x, y = F.col("v"), F.col("w")
    c = vectors.cosine(x, y)
    return n.select("grp", "i", F.round(vectors.dot(x, y), 9).alias("dot"), F.round(c, 9).alias("cosine"), F.round(F.least(vectors.dot(x, y), vectors.dot(y, x)), 9).alias("both"), F.round(F.get(vectors.unit(x), F.lit(0)), 9).alias("first_unit"), F.when(c >= 0.80, "").otherwise("low_doc_sim").alias("gate"))


BEST = f"""{v.VECTORS}, p as (select a.grp, a.i as si, b.i as ti, list_inner_product(a.v, b.v) as sim from vectors a join vectors b on a.grp = b.grp and a.side = 's' and b.side = 't'),
best as (select grp, 's' as side, si as i, ti as j, sim from (select *, row_number() over (partition by grp, si order by sim desc, ti) as r from p) where r = 1
union all select grp, 't', ti, si, sim from (select *, row_number() over (partition by grp, ti order by sim desc, si) as r from p) where r = 1)"""


@query(f"with {BEST} select grp, side, i, j, round(sim, 6) as sim from best")
def vector_nearest(spark, sf):
    return vectors.best_matches(v.vectors(spark, sf)).withColumn("sim", F.round("sim", 6))


@query(f"with {BEST} select a.grp, a.i, a.j, round(a.sim, 6) as sim from best a join best b on a.side = 's' and b.side = 't' and a.grp = b.grp and a.j = b.i and a.i = b.j where a.sim >= 0.2")
def vector_mutual(spark, sf):
    return vectors.mutual(vectors.best_matches(v.vectors(spark, sf)), 0.2).withColumn("sim", F.round("sim", 6))


@query()
def vector_chain(spark, sf):
    """The heaviest rising chain of mutual matches of a group."""
    return align.chains(vectors.mutual(vectors.best_matches(v.vectors(spark, sf)), 0.2))


LENGTH = f"case when a > 0 and b > 0 and a / b between 0.4 and 2.5 then greatest(0.0, 1 - abs(1 - a / b) / 1.5) else 0.0 end"


def with_length(spark, sf):
    s = v.scored_pairs(spark, sf)
    return s.withColumn("length", t.length_ratio_score(t.word_count(F.col("mk")), t.word_count(F.col("sq"))))


@query(f"""with {v.SCORED}, l as (select *, len({v.sql_words("mk")}) as a, len({v.sql_words("sq")}) as b from scored_pairs), s as (select *, {LENGTH} as length from l),
h as (select *, case when labse < 0.45 then 'labse_low' when laser3 < 0.45 then 'laser3_low' when length < 0.30 then 'length_low' else '' end as hard from s),
u as (select *, hard = '' and not is_structural as second, hard = '' and not is_structural and comet < 0.5 as failed, hard = '' and not is_structural and comet >= 0.5 and labse > 0.75 and comet < 0.75 as third from h),
w as (select *, case when is_structural then (labse * 0.5::double + laser3 * 0.3::double + length * 0.2::double) / 1.0::double else labse * 0.25::double + laser3 * 0.20::double + (case when second then comet else 0.0 end) * 0.25::double + (case when third then bt else 0.0 end) * 0.20::double + length * 0.10::double end as x from u)
select pair_id, idx, case when third then 3 when second then 2 else 1 end as tier, round(case when hard <> '' or failed then 0.0 else x end, 6) as blended, case when hard <> '' then hard when failed then 'comet_low' when x < 0.40 then 'low_blended' else '' end as rejection_reason from w""")
def score_tiers(spark, sf):
    s = score.validated(with_length(spark, sf))
    return s.select("pair_id", F.col("idx").cast("long").alias("idx"), "tier", F.round("blended", 6).alias("blended"), "rejection_reason")


@query(f"""with {v.SCORED}, s as (select pair_id, idx, case when idx % 3 = 0 then null else labse end as x, case when idx % 6 in (0, 1) then null else laser3 end as y, comet, bt from scored_pairs)
select pair_id, idx, round((coalesce(x, 0) + coalesce(y, 0)) / greatest((x is not null)::int + (y is not null)::int, 1), 6) as combined, case when x is null and y is null then true else (coalesce(x, 0) + coalesce(y, 0)) / ((x is not null)::int + (y is not null)::int) >= 0.7 end as ok, round(case when comet + bt > 0 then 2 * comet * bt / (comet + bt) else 0.0 end, 6) as back from s""")
def score_combined(spark, sf):
    i = F.col("idx")
    x, y = F.when(i % 3 != 0, F.col("labse")), F.when(~(i % 6).isin(0, 1), F.col("laser3"))
    mean, ok = score.mean_of(x, y)
    return v.scored_pairs(spark, sf).select("pair_id", i.cast("long").alias("idx"), F.round(mean, 6).alias("combined"), ok.alias("ok"), F.round(score.harmonic(F.col("comet"), F.col("bt")), 6).alias("back"))


@query(f"""with {v.SCORED}, l as (select *, len({v.sql_words("mk")}) as a, len({v.sql_words("sq")}) as b from scored_pairs), s as (select *, {LENGTH} as length from l)
select pair_id, idx, round((labse * 0.5::double + length * 0.2::double) / 0.7::double, 6) as without_second, round((laser3 * 0.3::double + length * 0.2::double) / 0.5::double, 6) as without_first, round(length, 6) as length_only, round(0.15::double + 0.85::double * labse, 6) as plain from s""")
def score_blends(spark, sf):
    s = with_length(spark, sf)
    c = {k: F.col(k) for k in ("labse", "laser3", "length")}
    blend = lambda *k: F.round(score.blend_structural({x: c[x] for x in k}), 6)
    return s.select("pair_id", F.col("idx").cast("long").alias("idx"), blend("labse", "length").alias("without_second"), blend("laser3", "length").alias("without_first"), blend("length").alias("length_only"), F.round(0.15 + 0.85 * c["labse"], 6).alias("plain"))


@query()
def score_chrf(spark, sf):
    s = v.sent_pairs(spark, sf)
    return s.select("pair_id", "idx", F.round(score.chrf_score("mk", "sq"), 6).alias("chrf"))


KEY = rf"lower({v.sql_strip('mk')}) || ' ||| ' || lower({v.sql_strip('sq')})"
DOUBLED = f"""{v.PAIRS}, dup as (select pair_id, idx, mk, sq, row_number() over (order by pair_id, idx) as ord from (select * from sent_pairs union all select pair_id + 1000000, idx, translate(mk, 'aeiou', 'AEIOU'), sq from sent_pairs where idx % 3 = 0))"""


def doubled(spark, sf):
    """Every third pair again, in capitals."""
    s = v.sent_pairs(spark, sf)
    again = s.filter("idx % 3 = 0").select((F.col("pair_id") + 1000000).alias("pair_id"), "idx", F.translate("mk", "aeiou", "AEIOU").alias("mk"), "sq")
    return numbered(s.unionByName(again), "pair_id", "idx", name="ord")


@query(f"with {DOUBLED} select pair_id, idx, ord from (select *, row_number() over (partition by {KEY} order by ord) as r from dup) where r = 1")
def dedup_exact(spark, sf):
    return dedup.keep_first(doubled(spark, sf), t.pair_hash(F.col("mk"), F.col("sq")), ["ord"]).select("pair_id", F.col("idx").cast("long").alias("idx"), "ord")


@query(f"with {v.PAIRS} select pair_id, idx from (select *, row_number() over (partition by pair_id, substr(mk, 1, 120), substr(sq, 1, 120) order by idx) as r from sent_pairs) where r = 1")
def dedup_prefix(spark, sf):
    s = v.sent_pairs(spark, sf)
    return dedup.keep_first(s, F.struct("pair_id", F.substring("mk", 1, 120), F.substring("sq", 1, 120)), ["idx"]).select("pair_id", F.col("idx").cast("long").alias("idx"))


@query(f"with {DOUBLED} select pair_id, idx, row_number() over (partition by {KEY} order by ord) > 1 as again from dup")
def dedup_flag(spark, sf):
    return dedup.repeated(doubled(spark, sf), t.pair_hash(F.col("mk"), F.col("sq")), ["ord"]).select("pair_id", F.col("idx").cast("long").alias("idx"), "again")


@query(f"with {DOUBLED} select count(*) - count(distinct {KEY}) as n_again, count(*) - count(distinct {v.sql_strip('mk')} || '|' || {v.sql_strip('sq')}) as n_again_cased, count(*) as n from dup")
def dedup_rate(spark, sf):
    d, mk, sq = doubled(spark, sf), F.col("mk"), F.col("sq")
    return d.agg((F.count("*") - F.count_distinct(t.pair_hash(mk, sq))).alias("n_again"), (F.count("*") - F.count_distinct(F.concat(t.strip(mk), F.lit("|"), t.strip(sq)))).alias("n_again_cased"), F.count("*").alias("n"))


K, B, R = 128, 3, 42
PERMS = "[" + ", ".join(f"{{'a': {a}::bigint, 'b': {b}::bigint}}" for a, b in dedup.permutations(K)) + "]"
SIGS = rf"""{v.PAIRS}, x as (select pair_id, idx, lower({v.sql_strip("mk")}) as m from sent_pairs),
h as (select pair_id, idx, list_transform(list_distinct(list_transform(range(greatest(0, length(m) - 2)), lambda i: substr(m, i + 1, 3))), lambda s: ('0x' || substr(md5(s), 1, 8))::bigint % 2147483647) as h from x),
sig as (select pair_id, idx, list_transform({PERMS}, lambda p: coalesce(list_min(list_transform(h, lambda y: (y * p.a + p.b) % 2147483647)), 2147483647)) as sig from h)"""


@query(f"with {SIGS} select pair_id, idx, md5(array_to_string(sig, ',')) as signature from sig")
def dedup_signature(spark, sf):
    return v.sent_pairs(spark, sf).select("pair_id", F.col("idx").cast("long").alias("idx"), md5(F.array_join(dedup.signature(F.col("mk")).cast("array<string>"), ",")).alias("signature"))


@query(f"with {SIGS}, b as (select pair_id, idx, unnest(range({B})) as band, sig from sig) select band, md5(array_to_string(sig[band * {R} + 1 : band * {R} + {R}], ',')) as key, count(*) as n from b group by all having count(*) > 1")
def dedup_buckets(spark, sf):
    s = v.sent_pairs(spark, sf).select(F.posexplode(dedup.bands(dedup.signature(F.col("mk")))).alias("band", "key"))
    return s.groupBy(F.col("band").cast("long").alias("band"), "key").agg(F.count("*").alias("n")).filter("n > 1")


@query()
def dedup_greedy(spark, sf):
    """Pairs that stay when each is dropped that collides on either side with an earlier kept one."""
    return dedup.greedy(doubled(spark, sf), ["mk", "sq"], "ord").select("pair_id", "idx", "ord")


@query()
def dedup_greedy_early(spark, sf):
    """The first generation's form: both sides in one text, case kept."""
    d = doubled(spark, sf).select("ord", F.concat("mk", F.lit(" ||| "), "sq").alias("both"))
    return dedup.greedy(d, ["both"], "ord").select("ord")
