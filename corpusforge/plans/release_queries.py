"""Queries of article splitting, entry checks, tolerant readers, exports and runs, with their DuckDB forms.

Documents in English are written in Cyrillic letters here, so that the rules apply with their own thresholds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions import predicates as p
from corpusforge.functions import text as t
from corpusforge.operators import runs, segment, stats
from corpusforge.operators.ranking import hashed
from corpusforge.plans import views as v
from corpusforge.plans.text_queries import md5
from corpusforge.sources import tables
from corpusforge.sources.storage import shared_folder, written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = v.sql_counts(sql)
        return f

    return add


# Marks that end in 8, 9 or 0 stay inside their line; the others begin one.
LINED = rf"""{v.ARTICLES}, lined as (select pair_id, side, regexp_replace(body, ' ((Член|Neni) [0-9]*[1-7] )', chr(10) || ' \1', 'g') as body from articles),
{"".join(rf"""{n}_p as (select pair_id, string_split(regexp_replace(body, '(?m)^\s*({word}\s+(\d+))', chr(1) || '\2' || chr(1) || '\1', 'g'), chr(1)) as p from lined where side = '{n}'),
{n}_b as (select pair_id, pos, p[2 * pos + 2] as number, {v.sql_strip("p[2 * pos + 3]")} as body from (select *, unnest(range((len(p) - 1) // 2)) as pos from {n}_p)),
{n}_i as (select pair_id, number, body from {n}_b qualify row_number() over (partition by pair_id, number order by pos desc) = 1), """ for n, word in (("s", "Член"), ("t", "Neni")))[:-2]}"""


@query(f"with {LINED} select pair_id, 'article_' || number as article_id, md5(s_i.body) as s_body, md5(t_i.body) as t_body from s_i join t_i using (pair_id, number) where s_i.body <> '' and t_i.body <> ''")
def segment_articles_headed(spark, sf):
    """Articles whose mark begins a line, with their mark, that both sides have."""
    a = v.articles(spark, sf).withColumn("body", F.regexp_replace("body", " ((Член|Neni) [0-9]*[1-7] )", "\n $1"))
    side = lambda n, word: segment.headed_articles(a.filter(F.col("side") == n), ["pair_id"], word)
    m = segment.matched(side("s", "Член"), side("t", "Neni"), ["pair_id", "number"]).filter("kind = 'both' and s_body <> '' and t_body <> ''")
    return m.select("pair_id", F.concat(F.lit("article_"), "number").alias("article_id"), md5(F.col("s_body")).alias("s_body"), md5(F.col("t_body")).alias("t_body"))


def sql_segments(name: str, source: str, pattern: str, groups: int) -> str:
    number = "".join(rf"\{k}" for k in range(1, groups + 1))
    return rf"""{name}_p as (select pair_id, string_split(regexp_replace(body, '{pattern}', chr(1) || '{number}' || chr(1) || '\0' || chr(1), 'g'), chr(1)) as p from {source}),
{name}_e as (select pair_id, p, len(p) = 1 as whole, unnest(range(greatest(1, (len(p) - 1) // 3))) as pos from {name}_p),
{name}_b as (select pair_id, pos, case when whole then '0' else p[3 * pos + 2] end as number, case when whole then '' else p[3 * pos + 3] end as heading, case when whole then p[1] else p[3 * pos + 4] end as raw, case when whole then 0 else length(p[1]) end as lead from {name}_e),
{name}_o as (select *, lead + sum(length(heading) + length(raw)) over (partition by pair_id order by pos) as e, {v.sql_strip("raw")} as body from {name}_b),
{name} as (select pair_id, pos, number, heading, (e - length(heading) - length(raw))::bigint as "start", e::bigint as "end", body from {name}_o where (heading = '' and body <> '') or (heading <> '' and length(body) >= 10))"""


BENT = """case when pair_id % 4 = 0 then replace(replace(body, 'Член ', 'x '), 'Neni ', 'x ') else replace(replace(replace(replace(replace(body, 'Член 3 ', 'ЧЛЕН 3 '), 'Член 4 ', 'Член 4а '), 'Член 5 ', 'Чл.5 '), 'Neni 3 ', 'NENI 3 '), 'Neni 4 ', 'Neni 4а ') end"""
EARLY = f"""{v.ARTICLES}, bent as (select pair_id, side, {BENT} as body from articles), bs as (select * from bent where side = 's'), bt as (select * from bent where side = 't'),
{sql_segments("es", "bs", segment.ARTICLE_MK_EARLY, 3)}, {sql_segments("et", "bt", segment.ARTICLE_SQ_EARLY, 2)}"""


def early_segments(spark, sf):
    a = v.articles(spark, sf).withColumn("body", F.expr(BENT))
    side = lambda n, pattern, groups: segment.article_segments(a.filter(F.col("side") == n), ["pair_id"], pattern, groups)
    return side("s", segment.ARTICLE_MK_EARLY, 3), side("t", segment.ARTICLE_SQ_EARLY, 2)


@query(f"""with {EARLY}, u as (select 's' as side, * from es union all select 't', * from et) select side, pair_id, pos, number, heading, "start", "end", md5(body) as body from u""")
def segment_articles_early(spark, sf):
    """The first generation's articles with heading and offsets; a text without marks is article 0."""
    x, y = early_segments(spark, sf)
    u = x.select(F.lit("s").alias("side"), "*").unionByName(y.select(F.lit("t").alias("side"), "*"))
    return u.select("side", "pair_id", F.col("pos").cast("long").alias("pos"), "number", "heading", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), md5(F.col("body")).alias("body"))


@query(f"""with {EARLY}, ls as (select pair_id, number, body from es qualify row_number() over (partition by pair_id, number order by pos desc) = 1), lt as (select pair_id, number, body from et qualify row_number() over (partition by pair_id, number order by pos desc) = 1)
select pair_id, number, coalesce(try_cast(nullif(regexp_extract(number, '^(\\d+)', 1), '') as int), 999999) as place, regexp_replace(number, '^\\d+', '') as rest, case when ls.body is null then 'target' when lt.body is null then 'source' else 'both' end as kind, md5(ls.body) as s_body, md5(lt.body) as t_body from ls full join lt using (pair_id, number)""")
def join_articles_early(spark, sf):
    """Articles of both sides by text id ('24a'), with the columns that order them; unmatched ones are marked."""
    x, y = (segment.last_of(a, ["pair_id", "number"]) for a in early_segments(spark, sf))
    place, rest = t.article_order(F.col("number"))
    m = segment.matched(x, y, ["pair_id", "number"])
    return m.select("pair_id", "number", place.alias("place"), rest.alias("rest"), "kind", md5(F.col("s_body")).alias("s_body"), md5(F.col("t_body")).alias("t_body"))


PIECES = {"s": {"Член 1 ": "точка 1 ", "Член 2 ": "Ставот 2 ", "Член 3 ": "Ставо 3 "}, "t": {"Neni 2 ": "Pika 2 ", "Neni 3 ": "Paragrafi 3 ", "Neni 4 ": "Shkronja d "}}


def sql_pieces(side: str, language: str) -> str:
    body = "body"
    for old, new in PIECES[side].items():
        body = f"replace({body}, '{old}', '{new}')"
    return " union all ".join(f"select '{side}' as side, pair_id, {k} as kind, unnest(range(len(x))) as pos, unnest(x) as number from (select pair_id, regexp_extract_all({body}, '{pattern}', 1) as x from articles where side = '{side}')" for k, pattern in enumerate(segment.SUBSECTIONS[language]))


@query(f"with {v.ARTICLES}, u as ({sql_pieces('s', 'mk')} union all {sql_pieces('t', 'sq')}) select * from u")
def segment_subsections(spark, sf):
    a = v.articles(spark, sf)
    found = []
    for side, language in (("s", "mk"), ("t", "sq")):
        body = F.col("body")
        for old, new in PIECES[side].items():
            body = F.replace(body, F.lit(old), F.lit(new))
        found.append(segment.subsections(a.filter(F.col("side") == side).select("pair_id", body.alias("body")), ["pair_id"], language).select(F.lit(side).alias("side"), "pair_id", "kind", F.col("pos").cast("long").alias("pos"), "number"))
    return found[0].unionByName(found[1])


LATIN, CYRILLIC = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "абцдефгхијклмнопљрстувњџѕзАБЦДЕФГХИЈКЛМНОПЉРСТУВЊЏЅЗ"
WORDS = " or ".join(f"contains(body, '{w}')" for w in p.TARGET_WORDS)
ISSUES = f"""sz as (select doc_id, 30000 + {v.sql_hash("doc_id", salt="size")} % 100000 as size, {v.sql_hash("doc_id", salt="pages")} % 17 as m, string_split(case when lang = 'en' then translate(text, '{LATIN}', '{CYRILLIC}') else text end, chr(10)) as l from documents),
pg as (select doc_id, unnest(l) as body from sz where m > 0)"""


@query(rf"""with {ISSUES}, g as (select doc_id, count(*) as n, sum(length({v.sql_strip("body")})) as chars, bool_or(regexp_matches(body, '[ëËçÇ]') or {WORDS} or {v.sql_ratio("body", "A-Za-z")} > 0.20) as signal from pg group by doc_id),
d as (select doc_id, size / 1024 as kb, coalesce(n, 0) as n, coalesce(chars, 0) as chars, signal from sz left join g using (doc_id)),
r as (select *, case when kb < 50 then 'file_too_small' when n = 0 then 'corrupt_or_unreadable' when chars < 20 then 'scanned_no_text_layer' when not signal then 'no_albanian_detected' else 'none' end as reason from d)
select doc_id, reason = 'none' as should_process, reason, case reason when 'file_too_small' then round_even(kb, 0)::bigint || ' KB < 50 KB' when 'corrupt_or_unreadable' then n || ' pages' when 'scanned_no_text_layer' then 'Only ' || chars || ' chars across ' || n || ' pages' when 'no_albanian_detected' then 'No Albanian signals in ' || n || ' pages' else '' end as detail from r""")
def filter_entry(spark, sf):
    """The gatekeeper at its own thresholds: 50 KB, 20 characters, a page of over 20 percent Latin letters."""
    d = v.table(spark, sf, "documents")
    body = F.when(F.col("lang") == "en", F.translate("text", LATIN, CYRILLIC)).otherwise(F.col("text"))
    pages = d.filter(hashed("doc_id", salt="pages") % 17 > 0).select("doc_id", F.explode(F.split(body, "\n")).alias("body"))
    return p.gatekeeper(d.select("doc_id", (30000 + hashed("doc_id", salt="size") % 100000).alias("size")), pages)


@query(f"with {v.SCORED} select pair_id, idx, labse from scored_pairs where labse >= 0.25")
def filter_confidence(spark, sf):
    return v.scored_pairs(spark, sf).filter(p.confident(F.col("labse"))).select("pair_id", F.col("idx").cast("long").alias("idx"), "labse")


# Some confidences and texts are missing, as words that readers take so; names of columns have blanks.
LOOSE = f"{v.SCORED}, loose as (select pair_id, idx, case when idx % 7 = 3 then 'NA' when idx % 7 = 5 then '' else mk end as mk, sq, case when idx % 5 = 1 then 'n/a' when idx % 5 = 2 then 'high' else labse::varchar end as confidence from scored_pairs)"


@query(f"with {LOOSE} select pair_id::varchar as pair_id, idx::varchar as idx, md5(case when mk in ('', 'NA') then '' else mk end) as mk, md5(sq) as sq, coalesce(try_cast(confidence as double), 0.0::double) as confidence from loose")
def io_tolerant_tsv(spark, sf):
    i = F.col("idx") % 5
    mk = F.when(F.col("idx") % 7 == 3, "NA").when(F.col("idx") % 7 == 5, "").otherwise(F.col("mk"))
    s = v.scored_pairs(spark, sf).select("pair_id", "idx", mk.alias(" mk "), F.col("sq").alias("sq "), F.when(i == 1, "n/a").when(i == 2, "high").otherwise(F.col("labse").cast("string")).alias(" confidence"))
    path = shared_folder(spark)
    tables.write(s, path, "tsv")
    return tables.tolerant_tsv(spark, path).select("pair_id", "idx", md5(F.col("mk")).alias("mk"), md5(F.col("sq")).alias("sq"), "confidence")


def aligned_rows(spark, sf):
    """Aligned pairs whose even rows lack item, layout and word counts."""
    s, even = v.scored_pairs(spark, sf), F.col("idx") % 2 == 0
    full = lambda c: F.when(~even, c)
    return s.select("mk", "sq", F.concat(F.lit("d"), F.col("pair_id") % 50).alias("pdf_id"), full(F.col("idx").cast("long")).alias("item_number"), F.when(F.col("idx") % 3 == 0, F.col("idx").cast("long")).alias("article_number"), F.lit("structural").alias("alignment_strategy"), full(F.lit("mixed")).alias("layout_type"), full(t.word_count(F.col("mk")).cast("long")).alias("mk_word_count"), full(F.col("is_structural")).alias("is_structural"))


ALIGNED = f"{v.SCORED}, al as (select mk, sq, 'd' || (pair_id % 50) as pdf_id, case when idx % 2 = 0 then 0 else idx end as item_number, case when idx % 3 = 0 then idx end as article_number, case when idx % 2 = 0 then '' else 'mixed' end as layout_type, case when idx % 2 = 0 then 0 else len({v.sql_words('mk')}) end as mk_word_count, idx % 2 <> 0 and is_structural as is_structural from scored_pairs)"
ALIGNED_OUT = "md5(mk) as mk, md5(sq) as sq, pdf_id, item_number::bigint as item_number, article_number::bigint as article_number, 'structural' as alignment_strategy, layout_type, mk_word_count::bigint as mk_word_count, 0::bigint as sq_word_count, is_structural"


@query(f"with {ALIGNED} select {ALIGNED_OUT} from al")
def io_tolerant_jsonl(spark, sf):
    path = shared_folder(spark)
    tables.write(aligned_rows(spark, sf), path, "jsonl")
    return tables.aligned(spark, path).withColumns({"mk": md5(F.col("mk")), "sq": md5(F.col("sq"))})


@query(f"with {ALIGNED} select {ALIGNED_OUT} from al where pdf_id <> 'd7' or article_number is not null")
def io_document_checkpoints(spark, sf):
    """Checkpoints by document; one document is written again with fewer rows, which replaces only its own."""
    path, rows = shared_folder(spark), aligned_rows(spark, sf)
    tables.checkpoint_documents(rows, path)
    tables.checkpoint_documents(rows.filter("pdf_id = 'd7' and article_number is not null"), path)
    return tables.aligned(spark, path).withColumns({"mk": md5(F.col("mk")), "sq": md5(F.col("sq"))})


@query(f"with {v.SCORED} select md5(mk) as mk_sentence, md5(sq) as sq_sentence, pair_id::varchar as source_issue, case when idx % 3 = 0 then '' else idx::varchar end as article_id, coalesce(labse::varchar, '') as confidence, 'gc' as alignment_method from scored_pairs")
def io_early_table(spark, sf):
    """The flattened table of the first generation, written and read as texts."""
    meta = F.struct(F.col("pair_id").alias("source"), F.when(F.col("idx") % 3 != 0, F.col("idx")).alias("article"), F.col("labse").alias("confidence"), F.lit("gc").alias("method"))
    made = tables.early_table(v.scored_pairs(spark, sf).select("mk", "sq", meta.alias("meta")))
    back = tables.round_trip(made, "tsv")
    return back.select(md5(F.col("mk_sentence")).alias("mk_sentence"), md5(F.col("sq_sentence")).alias("sq_sentence"), "source_issue", F.coalesce("article_id", F.lit("")).alias("article_id"), "confidence", "alignment_method")


@query(f"with {v.SCORED} select pair_id, idx, md5(mk) as mk, case when idx % 3 > 0 then labse end as labse from scored_pairs")
def io_json_array(spark, sf):
    """One JSON array, nulls included, written in parts and read line by line."""
    s = v.scored_pairs(spark, sf).select("pair_id", F.col("idx").cast("long").alias("idx"), "mk", F.when(F.col("idx") % 3 > 0, F.col("labse")).alias("labse"))
    path = shared_folder(spark)
    tables.write_json_array(s, path, "pair_id", "idx")
    return tables.read_json_array(spark, path, s.schema).withColumn("mk", md5(F.col("mk")))


@query(f"with {v.SCORED}, r as (select mk, row_number() over (order by {v.sql_hash('pair_id', 'idx', salt='42')}, pair_id, idx) as r, count(*) over () as n from scored_pairs), s as (select mk, case when r <= floor(0.8::double * n) then 'train' when r <= floor(0.8::double * n) + floor(0.1::double * n) then 'validation' else 'test' end as split from r) select split, count(*) as n, sum(length(mk))::bigint as chars from s group by 1")
def io_split_folders(spark, sf):
    """Train, validation and test as folders of one Parquet table, whose readers see only the folders they ask for."""
    path = shared_folder(spark)
    tables.write(stats.split(v.scored_pairs(spark, sf).select("pair_id", "idx", "mk", "sq"), "pair_id", "idx"), path, "parquet", by=("split",))
    return spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"), F.sum(F.length("mk")).alias("chars"))


@query(f"with {v.SCORED}, k as (select unnest(['tsv', 'csv', 'jsonl', 'json']) as format) select format, count(*) as n, sum(length(mk) + length(sq))::bigint as chars, 2::bigint as n_columns from scored_pairs, k group by format")
def io_export_list(spark, sf):
    """Both texts alone in each known format of a list; the unknown one is left out."""
    s = written(v.scored_pairs(spark, sf))
    paths = tables.export(s, shared_folder(spark), "corpus", " TSV, csv,jsonl,json,xml", simple=True)
    schema = s.select("mk", "sq").schema
    found = None
    for kind, path in paths.items():
        back = tables.read_json_array(spark, path, schema) if kind == "json" else tables.read(spark, path, kind, schema)
        one = back.agg(F.lit(kind).alias("format"), F.count("*").alias("n"), F.sum(F.length("mk") + F.length("sq")).alias("chars"), F.lit(len(back.columns)).cast("long").alias("n_columns"))
        found = one if found is None else found.unionByName(one)
    return found


def words_of(row: dict) -> dict:
    """Words of a text; a text with an at sign isn't taken."""
    if "@" in row["text"]:
        raise ValueError("unexpected sign")
    return {"n_words": len(row["text"].split()), "first": row["text"][:1]}


@query(r"select doc_id, case when contains(text, '@') then null else len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))::bigint end as n_words, case when not contains(text, '@') then substr(text, 1, 1) end as first, case when contains(text, '@') then 'words' end as stage, case when contains(text, '@') then 'ValueError: unexpected sign' end as error from documents")
def run_isolated(spark, sf):
    """Rows that fail go to a log with their error, the others go on."""
    good, bad = runs.isolated(v.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", words_of, "n_words long, first string", "words")
    return good.unionByName(bad, allowMissingColumns=True)


@query("""with f as (select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, o_orderkey % 12 + 1 as found from orders)
select o_orderkey, case when o_orderkey % 11 = 0 or o_orderkey % 13 = 0 then 'failed' when found = m then 'unchanged' else 'moved' end as status, case when o_orderkey % 11 = 0 then 'invalid path' when o_orderkey % 13 = 0 then 'could not extract month' end as detail,
case when o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0 and found <> m then 'pdfs/' || y || '/' || lpad(found::varchar, 2, '0') || '/' || o_orderkey || '.pdf' end as new_path from f""")
def catalog_month_moves(spark, sf):
    """Files whose text names another month than their folder: a plan of moves, with what can't be decided."""
    k, y = F.col("o_orderkey"), F.year("o_orderdate")
    path = F.when(k % 11 == 0, F.concat(F.lit("pdfs/"), k.cast("string"))).otherwise(F.concat_ws("/", F.lit("pdfs"), y.cast("string"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"), F.concat(k.cast("string"), F.lit(".pdf"))))
    body = F.when(k % 13 == 0, "no date").otherwise(F.concat(F.lit("15."), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("."), y.cast("string")))
    f = v.table(spark, sf, "orders").select("o_orderkey", y.alias("year"), path.alias("path"), t.month_of(body, y).alias("month"))
    return runs.month_moves(f, "path", "month", "year").select("o_orderkey", "status", "detail", "new_path")


@query(f"with {v.PAIRS}, c as (select pair_id, count(*) as n from sent_pairs group by 1) select pair_id, n from c order by n desc, pair_id limit 20")
def stat_top_sources(spark, sf):
    """The 20 sources with most pairs."""
    return v.sent_pairs(spark, sf).groupBy("pair_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pair_id").limit(20)


@query(f"with {v.SCORED}, r as (select case when labse < 0.2 then 'labse' when laser3 < 0.2 then 'laser3' when comet < 0.2 then 'comet' else '' end as reason from scored_pairs), c as (select reason, count(*) as n from r group by 1) select reason, n, round(100.0::double * n / (select count(*) from r), 6) as percent, row_number() over (order by n desc, reason) as place from c where reason <> ''")
def stat_removal_log(spark, sf):
    """Reasons of removal by count, with their share of all rows; one row a reason is ordered in one task."""
    from pyspark.sql import Window

    s = v.scored_pairs(spark, sf)
    c = stats.shares(s.select(p.first_reason(*[(F.col(x) < 0.2, x) for x in ("labse", "laser3", "comet")]).alias("reason")), "reason").filter("reason <> ''")
    return c.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "reason")).cast("long"))
