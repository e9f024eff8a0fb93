"""Queries of corpus statistics, sampling, splits, catalogs, readers and writers, with DuckDB forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions import text as t
from corpusforge.operators import dedup, score, stats
from corpusforge.operators.ranking import first_by, hashed
from corpusforge.plans import views as v
from corpusforge.plans.pair_queries import DOUBLED, doubled
from corpusforge.plans.text_queries import FLAGGED, flagged, md5
from corpusforge.sources import tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = v.sql_counts(sql)
        return f

    return add


def method_of(i):
    return F.when(i % 4 == 0, "structural_gc").when(i % 4 == 1, "structural").when(i % 4 == 2, "gale_church").otherwise("dense")


SQL_METHOD = "case idx % 4 when 0 then 'structural_gc' when 1 then 'structural' when 2 then 'gale_church' else 'dense' end"
REPORT = f"{v.SCORED}, rep as (select *, {SQL_METHOD} as method, 1990 + pair_id % 30 as year, len({v.sql_words('mk')}) as a, len({v.sql_words('sq')}) as b from scored_pairs)"


def report(spark, sf):
    s = v.scored_pairs(spark, sf)
    return s.withColumns({"method": method_of(F.col("idx")), "year": F.lit(1990) + F.col("pair_id") % 30, "a": t.word_count(F.col("mk")), "b": t.word_count(F.col("sq"))})


@query("with q as (select doc_id, case when length(text) < 300 then 'short' when length(regexp_replace(text, '[^0-9]', '', 'g')) / length(text) > 0.05 then 'digits' when len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) > 2000 then 'long' else '' end as reason from documents) select reason, count(*) as n from q group by reason")
def quality_reason_summary(spark, sf):
    """Documents by the first quality rule that they break."""
    from corpusforge.functions.predicates import first_reason

    x = F.col("text")
    reason = first_reason((F.length(x) < 300, "short"), (t.kept(x, "0-9") / F.length(x) > 0.05, "digits"), (t.word_count(x) > 2000, "long"))
    return v.table(spark, sf, "documents").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(f"with {REPORT}, c as (select method, count(*) as n from rep group by method) select method, n, round(100.0::double * n / (select sum(n) from c), 6) as percent from c")
def stat_method_counts(spark, sf):
    return stats.shares(report(spark, sf), "method")


@query(f"with {REPORT} select year, count(*) as n, round(avg(labse), 6) as mean, round(sum(a) / sum(b), 6) as ratio, round(avg((labse < 0.5)::int), 6) as low from rep group by year")
def stat_years(spark, sf):
    r = report(spark, sf)
    return r.groupBy("year").agg(F.count("*").alias("n"), F.round(F.avg("labse"), 6).alias("mean"), F.round(F.sum("a") / F.sum("b"), 6).alias("ratio"), F.round(F.avg((F.col("labse") < 0.5).cast("int")), 6).alias("low"))


DESCRIBE = " union all ".join(f"select '{c}' as col, count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, round(min({c})::double, 6) as min, round(quantile_cont({c}, 0.25)::double, 6) as q1, round(quantile_cont({c}, 0.5)::double, 6) as median, round(quantile_cont({c}, 0.75)::double, 6) as q3, round(max({c})::double, 6) as max from rep" for c in ("labse", "laser3", "comet", "a", "b"))


@query(f"with {REPORT} {DESCRIBE}")
def stat_describe(spark, sf):
    return stats.describe(report(spark, sf), "labse", "laser3", "comet", "a", "b")


@query(f"with {REPORT}, e as (select min(a)::double as lo, max(a)::double as hi from rep) select coalesce(least(floor((a - lo) / ((hi - lo) / 50)), 49), 0)::int as bin, count(*) as n from rep, e group by 1")
def stat_histogram(spark, sf):
    return stats.histogram(report(spark, sf), "a", 50)


@query(f"with {REPORT} select (labse >= 0)::int + (labse >= 0.3)::int + (labse >= 0.5)::int + (labse >= 0.6)::int + (labse >= 0.7)::int + (labse >= 0.8)::int + (labse >= 0.9)::int as bucket, count(*) as n from rep group by 1")
def stat_buckets(spark, sf):
    return report(spark, sf).groupBy(stats.bucket(F.col("labse"), [0, 0.3, 0.5, 0.6, 0.7, 0.8, 0.9]).alias("bucket")).agg(F.count("*").alias("n"))


@query(f"with {REPORT}, c as (select labse as value, count(*) as n from rep group by 1) select value, n, round(sum(n) over (order by value) / (select count(*) from rep), 9) as share from c")
def stat_distribution(spark, sf):
    return stats.distribution(report(spark, sf), "labse")


@query(f"with {REPORT} select method, round(quantile_cont(labse, 0.25), 6) as q1, round(quantile_cont(labse, 0.5), 6) as median, round(quantile_cont(labse, 0.75), 6) as q3, round(quantile_cont(labse, 0.75) - quantile_cont(labse, 0.25), 6) as iqr from rep group by method")
def stat_boxplot(spark, sf):
    g = report(spark, sf).groupBy("method").agg(F.percentile("labse", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    q = [F.get("q", F.lit(i)) for i in range(3)]
    return g.select("method", F.round(q[0], 6).alias("q1"), F.round(q[1], 6).alias("median"), F.round(q[2], 6).alias("q3"), F.round(q[2] - q[0], 6).alias("iqr"))


@query(f"""with {v.SCORED}, {FLAGGED} select count(distinct pair_id) as n_sources, count(distinct mk) as n_mk, count(distinct sq) as n_sq, count_if(confidence is null) as n_null, count_if(contains(mk, '`')) as n_tick, count_if(regexp_matches(mk, '[\\p{{L}}\\p{{N}}_] - ')) as n_hyphen,
count_if(regexp_matches(mk, '(?i)[0-9a-f]{{32}}')) as n_hex, count_if(len({v.sql_words("mk")}) < 3) as n_short, count_if(length(mk) / length(sq) > 5 or length(mk) / length(sq) < 0.2) as n_ratio, sum(len({v.sql_words("mk")}))::bigint as words, round(avg(length(mk)), 6) as chars, count_if(length({v.sql_strip("mk")}) < 5) as n_empty from flagged""")
def stat_issue_counters(spark, sf):
    f, mk = flagged(spark, sf), F.col("mk")
    ratio = t.char_ratio(mk, F.col("sq"))
    return f.agg(
        F.count_distinct("pair_id").alias("n_sources"), F.count_distinct("mk").alias("n_mk"), F.count_distinct("sq").alias("n_sq"), F.count_if(F.col("confidence").isNull()).alias("n_null"), F.count_if(F.contains(mk, F.lit("`"))).alias("n_tick"),
        F.count_if(mk.rlike(r"(?U)\w - ")).alias("n_hyphen"), F.count_if(mk.rlike("(?i)[0-9a-f]{32}")).alias("n_hex"), F.count_if(t.word_count(mk) < 3).alias("n_short"), F.count_if((ratio > 5) | (ratio < 0.2)).alias("n_ratio"),
        F.sum(t.word_count(mk)).alias("words"), F.round(F.avg(F.length(mk)), 6).alias("chars"), F.count_if(F.length(t.strip(mk)) < 5).alias("n_empty"),
    )


@query(f"with {v.PAIRS}, c as (select pair_id, count(*) as n from sent_pairs group by 1) select round(avg(n), 6) as mean, quantile_cont(n, 0.5)::double as median, max(n) as most, (select min(pair_id) from c where n = (select max(n) from c)) as which, count_if(n = 1) as singles, count(*) as sources, round(100.0::double * count(*) / (select count(*) from bitext), 6) as coverage from c")
def stat_per_source(spark, sf):
    """Pairs per source: mean, median, greatest, singles, and the share of documents with pairs."""
    c = v.sent_pairs(spark, sf).groupBy("pair_id").agg(F.count("*").alias("n"))
    n = v.table(spark, sf, "documents").filter("lang = 'en'").count()
    return c.agg(F.round(F.avg("n"), 6).alias("mean"), F.percentile("n", F.lit(0.5)).alias("median"), F.max("n").alias("most"), F.min_by("pair_id", F.struct((-F.col("n")).alias("m"), F.col("pair_id"))).alias("which"), F.count_if(F.col("n") == 1).alias("singles"), F.count("*").alias("sources"), F.round(F.lit(100.0) * F.count("*") / n, 6).alias("coverage"))


@query(f"with {REPORT} select count_if(regexp_full_match(idx::varchar, '\\d+') and idx % 3 <> 0) as numbered, count_if(idx % 3 = 0 and idx % 2 = 0) as fallback, count_if(idx % 3 = 0 and idx % 2 = 1) as other from rep")
def stat_article_ids(spark, sf):
    i = F.col("idx")
    a = v.scored_pairs(spark, sf).select(F.when(i % 3 != 0, i.cast("string")).when(i % 2 == 0, "gc").otherwise("x1").alias("id"))
    return a.agg(F.count_if(F.col("id").rlike(r"^\d+$")).alias("numbered"), F.count_if(F.col("id") == "gc").alias("fallback"), F.count_if(~F.col("id").rlike(r"^\d+$") & (F.col("id") != "gc")).alias("other"))


@query(f"with {REPORT}, k as (select 'before' as stage, * from rep union all select 'after', * from rep where labse >= 0.7) select stage, count(*) as n, round(avg(labse), 6) as mean, round(avg(a), 6) as words, count(distinct pair_id) as sources, round(avg((labse >= 0.5)::int), 6) as good from k group by stage")
def stat_before_after(spark, sf):
    r = report(spark, sf)
    both = r.withColumn("stage", F.explode(F.when(F.col("labse") >= 0.7, F.array(F.lit("before"), F.lit("after"))).otherwise(F.array(F.lit("before")))))
    return both.groupBy("stage").agg(F.count("*").alias("n"), F.round(F.avg("labse"), 6).alias("mean"), F.round(F.avg("a"), 6).alias("words"), F.count_distinct("pair_id").alias("sources"), F.round(F.avg((F.col("labse") >= 0.5).cast("int")), 6).alias("good"))


@query(f"""with {v.SCORED}, {FLAGGED} select count_if({v.sql_ratio("mk", "A-Za-z")} > 0.5) as script_ok, count_if({v.sql_ratio("mk", "A-Za-z")} <= 0.5) as script_bad, round(100.0::double * count_if(regexp_matches(sq, '[\\x{{0400}}-\\x{{04FF}}]')) / count(*), 6) as leak, count_if(contains(mk, ' - ')) as before, count_if(contains(regexp_replace(mk, '([\\p{{L}}\\p{{N}}_]) - ([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g'), ' - ')) as after from flagged""")
def stat_script_checks(spark, sf):
    f, mk = flagged(spark, sf), F.col("mk")
    ok = t.latin_ratio(mk) > 0.5
    fixed = F.regexp_replace(mk, r"(?U)(\w) - (\w)", "$1$2")
    return f.agg(F.count_if(ok).alias("script_ok"), F.count_if(~ok).alias("script_bad"), F.round(100.0 * F.count_if(F.col("sq").rlike(f"[{t.CYRILLIC}]")) / F.count("*"), 6).alias("leak"), F.count_if(F.contains(mk, F.lit(" - "))).alias("before"), F.count_if(F.contains(fixed, F.lit(" - "))).alias("after"))


@query(f"with {REPORT} select split_part(method, '_', 1) as prefix, count(*) as n, round(min(labse), 6) as least, round(avg(labse), 6) as mean, round(max(labse), 6) as most from rep group by 1")
def stat_method_prefix(spark, sf):
    r = report(spark, sf)
    return r.groupBy(F.get(F.split("method", "_"), F.lit(0)).alias("prefix")).agg(F.count("*").alias("n"), F.round(F.min("labse"), 6).alias("least"), F.round(F.avg("labse"), 6).alias("mean"), F.round(F.max("labse"), 6).alias("most"))


@query("select year(o_orderdate)::int as year, month(o_orderdate)::int as month, count(*) as n from orders group by all")
def stat_months(spark, sf):
    return v.table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))


TOP = "(select pair_id, idx, labse from scored_pairs order by labse {0}, pair_id, idx limit 10)"


@query(f"with {v.SCORED} select 'top' as kind, * from {TOP.format('desc')} union all select 'bottom', * from {TOP.format('asc')}")
def order_top_bottom(spark, sf):
    s = v.scored_pairs(spark, sf).select("pair_id", F.col("idx").cast("long").alias("idx"), "labse")
    top = s.orderBy(F.desc("labse"), "pair_id", "idx").limit(10).select(F.lit("top").alias("kind"), "*")
    return top.unionByName(s.orderBy("labse", "pair_id", "idx").limit(10).select(F.lit("bottom").alias("kind"), "*"))


@query(f"with {v.SCORED} select pair_id, idx from scored_pairs order by {v.sql_hash('pair_id', 'idx', salt='42')}, pair_id, idx limit 50")
def sample_seeded(spark, sf):
    return stats.sample(v.scored_pairs(spark, sf).select("pair_id", F.col("idx").cast("long").alias("idx")), 50, "pair_id", "idx")


@query(f"with {REPORT} select method, pair_id, idx from (select *, row_number() over (partition by method order by {v.sql_hash('pair_id', 'idx', salt='42')}, pair_id, idx) as r from rep) where r <= 2")
def sample_per_group(spark, sf):
    return stats.sample_by(report(spark, sf).select("method", "pair_id", F.col("idx").cast("long").alias("idx")), "method", 2, "pair_id", "idx")


@query(f"with {v.SCORED} select pair_id, idx, labse from scored_pairs where labse between 0.65 and 0.75 order by {v.sql_hash('pair_id', 'idx', salt='7')}, pair_id, idx limit 20")
def sample_borderline(spark, sf):
    s = v.scored_pairs(spark, sf).filter(F.col("labse").between(0.65, 0.75)).select("pair_id", F.col("idx").cast("long").alias("idx"), "labse")
    return stats.sample(s, 20, "pair_id", "idx", seed="7")


@query(f"with {v.SCORED}, c as (select 'low' as name, pair_id, idx from scored_pairs where labse < 0.1 union all select 'cyr', pair_id, idx from scored_pairs where {v.sql_ratio('mk', 'a-mA-M')} < 0.45) select * from c qualify row_number() over (partition by name order by pair_id, idx) <= 3")
def sample_first_failures(spark, sf):
    from pyspark.sql import Window

    s = v.scored_pairs(spark, sf).select("pair_id", F.col("idx").cast("long").alias("idx"), F.explode(F.array_compact(F.array(F.when(F.col("labse") < 0.1, "low"), F.when(t.script_ratio(F.col("mk"), "a-mA-M") < 0.45, "cyr")))).alias("name"))
    return s.withColumn("_r", F.row_number().over(Window.partitionBy("name").orderBy("pair_id", "idx"))).filter("_r <= 3").select("name", "pair_id", "idx")


@query(f"with {v.SCORED}, r as (select pair_id, idx, row_number() over (order by {v.sql_hash('pair_id', 'idx', salt='42')}, pair_id, idx) as r, count(*) over () as n from scored_pairs) select pair_id, idx, case when r <= floor(0.8::double * n) then 'train' when r <= floor(0.8::double * n) + floor(0.1::double * n) then 'validation' else 'test' end as split from r")
def split_exact(spark, sf):
    return stats.split(v.scored_pairs(spark, sf).select("pair_id", F.col("idx").cast("long").alias("idx")), "pair_id", "idx")


@query(f"with {v.SCORED} select pair_id, idx, round(labse, 4) as labse, round(laser3, 4) as laser3, coalesce(nullif(idx, 3), 0) as article_number, labse >= 0.7 as kept, substr(mk, 1, 200) as mk from scored_pairs")
def release_projection(spark, sf):
    """The released columns: scores to four digits, no null article, texts of a log line cut to 200."""
    s = v.scored_pairs(spark, sf)
    i = F.col("idx").cast("long")
    return s.select("pair_id", i.alias("idx"), F.round("labse", 4).alias("labse"), F.round("laser3", 4).alias("laser3"), F.coalesce(F.when(i != 3, i), F.lit(0)).alias("article_number"), (F.col("labse") >= 0.7).alias("kept"), F.substring("mk", 1, 200).alias("mk"))


LINKS = r"""links as (select page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) as href from pages), cat as (select page_id, href, md5(href) as issue_id, regexp_extract(url, '(\d+)/?(?:[?#].*)?$', 1) as number from links join pages using (page_id))"""


def catalog(spark, sf):
    p = v.table(spark, sf, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("href"))
    return p.select("page_id", "href", md5(F.col("href")).alias("issue_id"), F.regexp_extract("url", r"(\d+)/?(?:[?#].*)?$", 1).alias("number"))


@query(f"with {LINKS} select page_id, issue_id, number, count(*) as n from cat group by all")
def catalog_extract(spark, sf):
    return catalog(spark, sf).groupBy("page_id", "issue_id", "number").agg(F.count("*").alias("n"))


@query(f"with {LINKS} select issue_id, min(page_id) as page_id from cat group by 1")
def catalog_merge(spark, sf):
    """Known entries stay; new ones come by an anti join; ids are unique, the first page wins."""
    c = catalog(spark, sf)
    known = first_by(c.filter("page_id < 100").select("issue_id", "page_id"), ["issue_id"], [F.col("page_id")])
    fresh = first_by(c.filter("page_id >= 100").select("issue_id", "page_id").join(known.select("issue_id"), "issue_id", "left_anti"), ["issue_id"], [F.col("page_id")])
    return known.unionByName(fresh).groupBy("issue_id").agg(F.min("page_id").alias("page_id"))


@query(r"""select page_id, len(regexp_extract_all(html, '\b\d{1,2}[./]\d{1,2}[./]\d{4}\b')) as n_dates, len(regexp_extract_all(html, 'utm|ref')) as n_marks, replace(regexp_extract(url, '://[^/]+/(.*)$', 1), '/', '_') as doc_key from pages""")
def catalog_dates(spark, sf):
    h = F.col("html")
    return v.table(spark, sf, "pages").select("page_id", F.size(F.regexp_extract_all(h, F.lit(r"\b\d{1,2}[./]\d{1,2}[./]\d{4}\b"), F.lit(0))).cast("long").alias("n_dates"), F.size(F.regexp_extract_all(h, F.lit("utm|ref"), F.lit(0))).cast("long").alias("n_marks"), F.translate(F.regexp_extract("url", "://[^/]+/(.*)$", 1), "/", "_").alias("doc_key"))


@query("select distinct doc_id from documents where doc_id not in (select doc_id from labels) union select doc_id from labels where quality = 0")
def keys_set_operations(spark, sf):
    """Keys on one side only and keys of a condition: difference, then union."""
    d, l = v.table(spark, sf, "documents").select("doc_id"), v.table(spark, sf, "labels")
    return d.subtract(l.select("doc_id")).union(l.filter("quality = 0").select("doc_id")).distinct()


ROUND_TRIP = f"with {v.SCORED} select count(*) as n, sum(length(mk))::bigint as chars, round(sum(labse), 4) as total, count(distinct md5(translate(mk, chr(9) || chr(10), '  '))) as texts from scored_pairs"


def _round_trip(name: str):
    def run(spark, sf):
        s = v.scored_pairs(spark, sf).select("pair_id", "idx", "mk", "sq", "labse")
        back = tables.round_trip(s, name)
        flat = F.translate("mk", "\t\n", "  ")
        return back.agg(F.count("*").alias("n"), F.sum(F.length("mk")).alias("chars"), F.round(F.sum(F.col("labse").cast("double")), 4).alias("total"), F.count_distinct(md5(flat)).alias("texts"))

    run.__name__ = f"io_{name}"
    run.__doc__ = f"Writes the pairs as {name} and reads them again."
    return run


for _name in tables.FORMATS:
    query(ROUND_TRIP)(_round_trip(_name))


@query("select o_orderstatus as status, count(*) as n, sum(case when o_totalprice < 1000 then 1 else 0 end)::bigint as too_small from orders group by 1")
def run_statistics(spark, sf):
    """Rows by status, and downloads that are too small."""
    return v.table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.sum(F.when(F.col("o_totalprice") < 1000, 1).otherwise(0)).alias("too_small"))


@query(f"""with {DOUBLED}, r as (select *, len({v.sql_words("mk")}) as a, len({v.sql_words("sq")}) as b from dup), k as (select ord, mk, sq from r where a between 5 and 200 and b between 5 and 200 and a / b between 0.4 and 2.5),
u as (select ord from k qualify row_number() over (partition by lower({v.sql_strip("mk")}) || ' ||| ' || lower({v.sql_strip("sq")}) order by ord) = 1)
select case when {v.sql_hash("ord", salt="42")} % 10 < 8 then 'train' when {v.sql_hash("ord", salt="42")} % 10 = 8 then 'validation' else 'test' end as split, count(*) as n from u group by 1""")
def pipeline_clean_pairs(spark, sf):
    """Filter, drop repeated pairs, assign splits: the counts of the release."""
    d = doubled(spark, sf).withColumns({"a": t.word_count(F.col("mk")), "b": t.word_count(F.col("sq"))})
    d = d.filter(F.col("a").between(5, 200) & F.col("b").between(5, 200) & (F.col("a") / F.col("b")).between(0.4, 2.5))
    u = dedup.keep_first(d.select("ord", "mk", "sq"), t.pair_hash(F.col("mk"), F.col("sq")), ["ord"])
    h = hashed("ord", salt="42") % 10
    return u.groupBy(F.when(h < 8, "train").when(h == 8, "validation").otherwise("test").alias("split")).agg(F.count("*").alias("n"))


@query()
def pipeline_validated(spark, sf):
    """Scored pairs through the tiers: rows by tier and reason."""
    s = v.scored_pairs(spark, sf).withColumn("length", t.length_ratio_score(t.word_count(F.col("mk")), t.word_count(F.col("sq"))))
    return score.validated(s).groupBy("tier", "rejection_reason").agg(F.count("*").alias("n"))


@query("select user_id, count(*) as n, min(event_id) as first_event, sum(case when event_type = 'click' then 1 else 0 end)::bigint as clicks from events group by 1")
def stream_batches(spark, sf):
    """The incremental form: files as a stream, each batch merged into the written state, once."""
    from corpusforge.streaming.incremental import counted

    return counted(spark, f"{sf}/events.parquet")


