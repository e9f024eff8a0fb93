"""Queries of text functions and page filters, with their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions import predicates as p
from corpusforge.functions import text as t
from corpusforge.plans import views as v

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = v.sql_counts(sql)
        return f

    return add


def md5(c):
    return F.md5(c.cast("binary"))


#: Defects put into the given texts, which have none of their own.
BENT = "concat('`A` ', regexp_replace(regexp_replace(text, 'th([a-z])', 't - h$1'), ' of ', ' o-  f '))"
SQL_BENT = r"concat('`A` ', regexp_replace(regexp_replace(text, 'th([a-z])', 't - h\1', 'g'), ' of ', ' o-  f ', 'g'))"
HYPHEN = r"regexp_replace({}, '([\p{{L}}\p{{N}}_])\s*[-–]\s*([a-zа-ш])', '\1\2', 'g')"
HEX = r"regexp_replace({}, '(?i)\b[0-9a-f]{{32,}}\b', '', 'g')"


@query(rf"""with b as (select doc_id, {SQL_BENT} as x from documents)
select doc_id, md5(replace(x, '`', 'ë')) as encoding, md5({HYPHEN.format("x")}) as hyphens, md5({HYPHEN.format(HYPHEN.format("x"))}) as hyphens_twice,
md5(regexp_replace(regexp_replace(x, '([\p{{L}}\p{{N}}_]) - ([а-яё])', '\1\2', 'g'), '([\p{{L}}\p{{N}}_]) - ([a-zëç])', '\1\2', 'g')) as spaced,
md5(regexp_replace(x, '([\p{{L}}\p{{N}}_])\s*-\s+([\p{{L}}\p{{N}}_])', '\1\2', 'g')) as broken from b""")
def text_hyphens(spark, sf):
    b = v.table(spark, sf, "documents").select("doc_id", F.expr(BENT).alias("x"))
    x = F.col("x")
    return b.select("doc_id", md5(t.fix_encoding(x)).alias("encoding"), md5(t.join_hyphens(x)).alias("hyphens"), md5(t.join_hyphens(t.join_hyphens(x))).alias("hyphens_twice"), md5(t.join_spaced_hyphens(x)).alias("spaced"), md5(t.join_broken_words(x)).alias("broken"))


@query(rf"""select doc_id, md5({v.sql_strip(HEX.format("text"))}) as hex, md5({v.sql_strip("regexp_replace(text, '(?i)[0-9a-f]{32,}', '', 'g')")}) as hex_anywhere,
md5({v.sql_strip(r"array_to_string(list_transform(string_split(text, chr(10)), lambda s: regexp_replace(regexp_replace(s, '[ \t\r\f]+', ' ', 'g'), '^\s+|\s+$', '', 'g')), chr(10))")}) as lines,
md5(array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '[ \t]+', ' ', 'g'), chr(10)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> ''), chr(10))) as tabs,
md5({v.sql_strip(r"regexp_replace(text, '\s+', ' ', 'g')")}) as spaces from documents""")
def text_whitespace_hex(spark, sf):
    x = F.col("text")
    return v.table(spark, sf, "documents").select("doc_id", md5(t.remove_hex(x)).alias("hex"), md5(t.remove_hex_anywhere(x)).alias("hex_anywhere"), md5(t.squeeze_lines(x)).alias("lines"), md5(t.squeeze_tabs(x)).alias("tabs"), md5(t.squeeze(x)).alias("spaces"))


@query(rf"""with b as (select doc_id, replace(nfc_normalize({SQL_BENT}), '`', 'ë') as x, nfc_normalize(text) as n from documents)
select doc_id, md5(n) as nfc, md5({v.sql_strip(HEX.format(HYPHEN.format("x")))}) as clean from b""")
def text_clean_unicode(spark, sf):
    b = v.table(spark, sf, "documents").select("doc_id", F.expr(BENT).alias("x"), "text")
    return b.select("doc_id", md5(t.nfc(F.col("text"))).alias("nfc"), md5(t.clean_text(F.col("x"), True)).alias("clean"))


RATIOS = {
    "cyrillic": (r"\x{0400}-\x{04FF}", r"\p{L}"), "latin": ("A-Za-z", r"\p{L}"), "latin_marks": ("A-Za-zëçËÇ", r"A-Za-zëçËÇ\x{0400}-\x{04FF}"), "latin_letters": ("A-Za-zëçËÇ", r"\p{L}"),
    "latin_umlaut": ("A-Za-zëçËÇÜü", r"\p{L}"), "latin_wide": ("A-Za-zÀ-ÖØ-öø-ÿĀ-žḀ-ỿ", r"\p{L}"), "first_half": ("a-mA-M", r"\p{L}"),
}


@query("select doc_id, " + ", ".join(f"round({v.sql_ratio('text', a, b)}, 9) as {k}" for k, (a, b) in RATIOS.items()) + f""", regexp_matches(text, '[ëËçÇ]') as markers, len({v.sql_words("text")}) as n_words,
round(case when length(text) > 0 then {v.sql_kept("text", r'\p{Nd}²³¹⁰-⁹₀-₉')} / length(text) else 0.0 end, 9) as digits,
round(case when len({v.sql_words("text")}) > 0 then len(list_filter({v.sql_words("text")}, lambda x: regexp_full_match(x, '[0-9.,/%]+'))) / len({v.sql_words("text")}) else 1.0 end, 9) as number_words,
({v.sql_strip("text")} = '' or {v.sql_kept("text", r'\p{L}')} / length(text) < 0.3) as low_quality from documents""")
def text_script_ratios(spark, sf):
    x = F.col("text")
    classes = tuple(dict.fromkeys([c for pair in RATIOS.values() for c in pair] + [t.DIGITS]))
    at = {c: F.col("n")[i] for i, c in enumerate(classes)}
    n_words, numbers = F.col("n")[len(classes)], F.col("n")[len(classes) + 1]
    share = lambda n, of, none: F.when(of > 0, n / of).otherwise(F.when(x.isNotNull(), F.lit(none)))
    d = v.table(spark, sf, "documents").select("doc_id", "text", t.counts(x, classes, "0-9.,/%").alias("n"))
    return d.select(
        "doc_id", *[F.round(share(at[a], at[b], 0.0), 9).alias(k) for k, (a, b) in RATIOS.items()], t.has_albanian_markers(x).alias("markers"), n_words.cast("long").alias("n_words"),
        F.round(share(at[t.DIGITS], F.length(x), 0.0), 9).alias("digits"), F.round(share(numbers, n_words, 1.0), 9).alias("number_words"), ((t.strip(x) == "") | (at[r"\p{L}"] / F.length(x) < 0.3)).alias("low_quality"),
    )


#: Lines with page numbers, headers and dates between the given ones.
SQL_NOISY = "list_transform(string_split(text, chr(10)), lambda s, i: case i % 6 when 1 then i::varchar || chr(10) || s when 3 then 'Стр. 2 - Бр. 6 11 јануари 2021' || chr(10) || s when 5 then 'faqe ' || i::varchar || chr(10) || s else s end)"


def noisy():
    lines = F.split("text", "\n")
    mark = lambda s, i: F.when(i % 6 == 0, F.concat((i + 1).cast("string"), F.lit("\n"), s)).when(i % 6 == 2, F.concat(F.lit("Стр. 2 - Бр. 6 11 јануари 2021\n"), s)).when(i % 6 == 4, F.concat(F.lit("faqe "), (i + 1).cast("string"), F.lit("\n"), s)).otherwise(s)
    return F.array_join(F.transform(lines, mark), "\n")


def sql_noise(s: str) -> str:
    x = v.sql_strip(s)
    return f"({x} = '' or (length({x}) <= 150 and (regexp_matches({x}, '{t.PAGE_NUMBER}') or regexp_matches({x}, '(?i){t.HEADER_FOOTER}') or regexp_matches({x}, '(?i){t.DATE_HEADER}'))))"


@query(rf"""with n as (select doc_id, array_to_string({SQL_NOISY}, chr(10)) as x from documents),
k as (select doc_id, x, array_to_string(list_filter(string_split(x, chr(10)), lambda s: not {sql_noise("s")}), chr(10)) as y from n)
select doc_id, md5(y) as stripped, md5(case when {v.sql_ratio("y", "a-mA-M")} < 0.5 and length({v.sql_strip("y")}) > 20 then '' else {v.sql_strip("y")} end) as side,
len(list_filter(string_split(x, chr(10)), lambda s: {sql_noise("s")})) as n_noise,
len(list_filter(string_split(x, chr(10)), lambda s: length({v.sql_strip("s")}) >= 3 and case when length(s) > 0 then {v.sql_kept("s", r'\p{Nd}²³¹⁰-⁹₀-₉')} / length(s) else 0.0 end <= 0.30 and not {sql_noise("s")})) as n_content,
md5({v.sql_strip(f"array_to_string(list_filter(list_transform(string_split(x, chr(10)), lambda s: {v.sql_strip('s')}), lambda s: s <> '' and not regexp_matches(s, '(?i){'|'.join(t.BUILDER_NOISE)}')), chr(10))")}) as builder from k""")
def text_noise_lines(spark, sf):
    n = v.table(spark, sf, "documents").select("doc_id", noisy().alias("x")).withColumn("y", t.strip_noise(F.col("x")))
    x, y, lines = F.col("x"), F.col("y"), F.split("x", "\n")
    return n.select("doc_id", md5(y).alias("stripped"), md5(t.clean_side(x, t.script_ratio(y, "a-mA-M"))).alias("side"), F.size(F.filter(lines, t.is_noise_line)).cast("long").alias("n_noise"), F.size(F.filter(lines, t.is_content_line)).cast("long").alias("n_content"), md5(t.clean_pages(x)).alias("builder"))


def sql_clean(rules: tuple[str, ...], text: str, flag: str) -> str:
    lines = f"list_filter(string_split({text}, chr(10)), lambda s: not regexp_full_match({v.sql_strip('s')}, '{flag}(?:{'|'.join(rules)})'))"
    return rf"array_to_string(list_filter(list_transform(string_split(regexp_replace(array_to_string({lines}, chr(10)), '[ \t]+', ' ', 'g'), chr(10)), lambda s: {v.sql_strip('s')}), lambda s: s <> ''), chr(10))"


@query(f"""with n as (select doc_id, nfc_normalize(array_to_string({SQL_NOISY}, chr(10))) as x from documents)
select doc_id, md5({sql_clean(t.CLEAN_MK, "translate(x, 'ёй', 'еи')", "")}) as mk, md5({sql_clean(t.CLEAN_SQ, "x", "(?i)")}) as sq from n""")
def text_clean_sides(spark, sf):
    n = v.table(spark, sf, "documents").select("doc_id", noisy().alias("x"))
    return n.select("doc_id", md5(t.clean_macedonian(F.col("x"))).alias("mk"), md5(t.clean_albanian(F.col("x"))).alias("sq"))


def digest(c):
    return md5(F.array_join(c, "\x01"))


def sql_digest(s: str) -> str:
    return f"md5(array_to_string({s}, chr(1)))"


PARAGRAPH = r"string_split(regexp_replace(text, '([.!?])\s+([A-ZА-ЯЀ-Ɀ])', '\1' || chr(1) || '\2', 'g'), chr(1))"


@query(rf"""select doc_id, {sql_digest(v.sql_sentences("text"))} as a, {sql_digest(v.sql_sentences("text", ".!?;"))} as b, {sql_digest(f"list_filter({v.sql_sentences('text')}, lambda s: len({v.sql_words('s')}) >= 5)")} as c,
{sql_digest(f"list_filter(list_transform(flatten(list_transform({PARAGRAPH}, lambda s: string_split(s, chr(10) || chr(10)))), lambda s: {v.sql_strip("regexp_replace(s, '\\s+', ' ', 'g')")}), lambda s: length(s) >= 15)")} as d,
{sql_digest(f"list_filter({v.sql_sentences('text')}, lambda s: length(s) > 20)")} as e, len({v.sql_sentences("text")}) as n from documents""")
def text_sentences(spark, sf):
    x = F.col("text")
    return v.table(spark, sf, "documents").select(
        "doc_id", digest(t.sentences(x)).alias("a"), digest(t.sentences(x, ".!?;")).alias("b"), digest(t.long_sentences(x)).alias("c"), digest(t.paragraph_sentences(x)).alias("d"),
        digest(F.filter(t.sentences(x), lambda s: F.length(s) > 20)).alias("e"), F.size(t.sentences(x)).cast("long").alias("n"),
    )


@query(rf"""with {v.PAIRS} select pair_id, idx, sha256(lower({v.sql_strip("mk")}) || ' ||| ' || lower({v.sql_strip("sq")})) as pair_hash,
md5(array_to_string(list_transform(range(greatest(0, length(mk) - 2)), lambda i: substr(mk, i + 1, 3)), '|')) as grams, round(length(mk) / length(sq), 9) as char_ratio,
round(case when a > 0 and b > 0 and a / b between 0.4 and 2.5 then greatest(0.0, 1 - abs(1 - a / b) / 1.5) else 0.0 end, 9) as length_score,
md5(case when length(mk) > 40 then substr(mk, (length(mk) - 40) // 2 + 1, 40) else mk end) as mid, regexp_matches(array_to_string(list_transform({v.sql_words("upper(mk)")}, lambda w: case when length(w) > 1 and regexp_matches(w, '\p{{Lu}}') then 'U' else 'L' end), ''), 'U{{6}}') as shouting
from (select *, len({v.sql_words("mk")}) as a, len({v.sql_words("sq")}) as b from sent_pairs)""")
def text_pair_scalars(spark, sf):
    s, mk, sq = v.sent_pairs(spark, sf), F.col("mk"), F.col("sq")
    return s.select(
        "pair_id", F.col("idx").cast("long").alias("idx"), t.pair_hash(mk, sq).alias("pair_hash"), md5(F.array_join(t.shingles(mk), "|")).alias("grams"), F.round(t.char_ratio(mk, sq), 9).alias("char_ratio"),
        F.round(t.length_ratio_score(t.word_count(mk), t.word_count(sq)), 9).alias("length_score"), md5(t.middle(mk, 40)).alias("mid"), t.upper_run(F.upper(mk)).alias("shouting"),
    )


@query(rf"""with {v.SCORED}, c as (select *, case when idx % 4 = 0 then null when idx % 4 = 1 then labse * 1000 else labse end as conf,
case idx % 4 when 0 then 'structural_gc' when 1 then 'structural' when 2 then 'gale_church' else 'dense' end as method, 'mk_' || (1990 + pair_id % 30)::varchar || '_' || idx::varchar as source, (idx % 30)::varchar || case when idx % 7 = 0 then 'а' else '' end as article from scored_pairs)
select pair_id, idx, round(least(greatest(coalesce(case when conf > 1 then conf / 1000 else conf end, 0.0), 0.0), 1.0), 9) as confidence, round(0.7 * labse + 0.3 * laser3, 9) as blended, round(greatest(0.0, least(1.0, 1 - comet * 12 / 10)), 3) as gc_confidence,
case when contains(method, 'structural') and contains(method, 'gc') then 'Structural + Gale-Church' when contains(method, 'structural') then 'Structural Only' when contains(method, 'gale_church') or contains(method, 'gc') then 'Gale-Church Only' else 'Other' end as category,
coalesce(list_filter(string_split(source, '_'), lambda x: regexp_full_match(x, '\d{{4}}'))[1], 'unknown') as year, coalesce(nullif(regexp_extract(article, '^(\d+)', 1), '')::int, 999999) as article_number, regexp_extract(article, '^\d+(.*)$', 1) as article_suffix from c""")
def text_scores_and_labels(spark, sf):
    s, i = v.scored_pairs(spark, sf), F.col("idx")
    s = s.withColumns({
        "conf": F.when(i % 4 == 0, None).when(i % 4 == 1, F.col("labse") * 1000).otherwise(F.col("labse")), "method": F.when(i % 4 == 0, "structural_gc").when(i % 4 == 1, "structural").when(i % 4 == 2, "gale_church").otherwise("dense"),
        "source": F.concat_ws("_", F.lit("mk"), (F.lit(1990) + F.col("pair_id") % 30).cast("string"), i.cast("string")), "article": F.concat((i % 30).cast("string"), F.when(i % 7 == 0, "а").otherwise("")),
    })
    n, rest = t.article_order(F.col("article"))
    return s.select("pair_id", i.cast("long").alias("idx"), F.round(t.normal_confidence(F.col("conf")), 9).alias("confidence"), F.round(0.7 * F.col("labse") + 0.3 * F.col("laser3"), 9).alias("blended"), t.cost_confidence(F.col("comet") * 12).alias("gc_confidence"), t.method_category(F.col("method")).alias("category"), t.year_of(F.col("source")).alias("year"), n.alias("article_number"), rest.alias("article_suffix"))


MONTH_TEXTS = [("15 јануари 1947", 1947), ("15. III 1947", 1947), ("15.03.1947", 1947), ("15 јануари 1948", 1947), ("broj 3, 12 avgusta 1950 god.", 1950), ("за март 1951 и 1.2.1952", 1951), ("10/13/1953", 1953), ("", 1953)]


def sql_months(y: str) -> str:
    rows = [f"(regexp_extract(lower(x), '(?:^|[^\\p{{L}}\\p{{N}}_])\\d{{1,2}}\\s*\\.?\\s*{n}\\s*\\.?\\s*(\\d{{4}})', 1), {m})" for d in (t.MONTH_NAMES_MK, t.MONTH_NAMES_SR) for n, m in d.items()]
    rows += [f"(regexp_extract(x, '(?:^|[^\\p{{L}}\\p{{N}}_])\\d{{1,2}}\\s*\\.?\\s*{r}\\s*\\.?\\s*(\\d{{4}})', 1), {t.ROMAN.index(r) + 1})" for r in sorted(t.ROMAN, key=len, reverse=True)]
    late = [f"(regexp_extract(lower(x), '(?:^|[^\\p{{L}}\\p{{N}}_]){n}\\s*\\.?\\s*(\\d{{4}})', 1), {m})" for n, m in {**t.MONTH_NAMES_MK, **t.MONTH_NAMES_SR}.items()]
    when = lambda r: " ".join(f"when {a} = {y}::varchar then {m}" for a, m in (x[1:-1].rsplit(", ", 1) for x in r))
    dates = f"list_filter(regexp_extract_all(x, '\\b\\d{{1,2}}[./]\\d{{1,2}}[./]\\d{{4}}\\b'), lambda d: right(d, 4) = {y}::varchar)[1]"
    month = f"try_cast(regexp_extract(coalesce({dates}, ''), '[./](\\d{{1,2}})[./]', 1) as int)"
    return f"case {when(rows)} when {month} between 1 and 12 then {month} {when(late)} end"


@query(f"""with x as (select * from (values {", ".join(f"({i}, '{a}', {b})" for i, (a, b) in enumerate(MONTH_TEXTS))}) as m(id, x, y) union all select 100 + doc_id, '7. ' || ['јануари', 'marta', 'XI', 'juni'][1 + doc_id % 4] || ' 19' || (50 + doc_id % 3)::varchar || ' ' || text, 1950 from documents)
select id, {sql_months("y")} as month from x""")
def text_month(spark, sf):
    a = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(MONTH_TEXTS)], "id long, x string, y int")
    names = F.element_at(F.array(*map(F.lit, ("јануари", "marta", "XI", "juni"))), (F.col("doc_id") % 4 + 1).cast("int"))
    b = v.table(spark, sf, "documents").select((F.col("doc_id") + 100).alias("id"), F.concat(F.lit("7. "), names, F.lit(" 19"), (50 + F.col("doc_id") % 3).cast("string"), F.lit(" "), "text").alias("x"), F.lit(1950).alias("y"))
    return a.unionByName(b).select("id", t.month_of(F.col("x"), F.col("y")).alias("month"))


@query(f"""with {v.SCORED}, r as (select pair_id, idx, len({v.sql_words("mk")}) as a, len({v.sql_words("sq")}) as b, mk, sq from scored_pairs)
select pair_id, idx, case when a < 5 then 'mk_too_short' when b < 5 then 'sq_too_short' when a > 200 then 'mk_too_long' when b > 200 then 'sq_too_long' when a / greatest(b, 1) < 0.4 or a / greatest(b, 1) > 2.5 then 'ratio'
when {v.sql_kept("mk", "0-9")} / length(mk) > 0.3 then 'mk_digits' when {v.sql_kept("sq", "0-9")} / length(sq) > 0.3 then 'sq_digits'
when length(mk) > 20 and {v.sql_ratio("mk", "a-mA-M")} < 0.5 then 'mk_script' when length(sq) > 20 and {v.sql_ratio("sq", "A-Za-z")} < 0.5 then 'sq_script' else '' end as reason from r""")
def filter_pairs(spark, sf):
    s = v.sent_pairs(spark, sf)
    reason = F.regexp_replace(p.pair_reason(F.col("mk"), F.col("sq"), "a-mA-M"), "_[0-9.]+$", "")
    return s.select("pair_id", F.col("idx").cast("long").alias("idx"), reason.alias("reason"))


@query(f"""with {v.PAIRS}, r as (select pair_id, idx, len({v.sql_words("mk")}) as a, len({v.sql_words("sq")}) as b, mk, sq from sent_pairs)
select case when {v.sql_strip("mk")} = '' or {v.sql_strip("sq")} = '' then 'empty' when a < 5 or b < 5 then 'too_short' when a > 200 or b > 200 then 'too_long' when a / b < 0.4 or a / b > 2.5 then 'ratio'
when len(list_filter({v.sql_words("mk")}, lambda x: regexp_full_match(x, '[0-9.,]+'))) / a > 0.3 or len(list_filter({v.sql_words("sq")}, lambda x: regexp_full_match(x, '[0-9.,]+'))) / b > 0.3 then 'numbers'
when regexp_matches(array_to_string(list_transform({v.sql_words("mk")}, lambda w: case when length(w) > 1 and upper(w) = w and regexp_matches(w, '\\p{{Lu}}') then 'U' else 'L' end), ''), 'U{{6}}') or regexp_matches(array_to_string(list_transform({v.sql_words("sq")}, lambda w: case when length(w) > 1 and upper(w) = w and regexp_matches(w, '\\p{{Lu}}') then 'U' else 'L' end), ''), 'U{{6}}') then 'uppercase' else '' end as reason, count(*) as n from r group by 1""")
def filter_early(spark, sf):
    return v.sent_pairs(spark, sf).groupBy(p.early_pair_reason(F.col("mk"), F.col("sq")).alias("reason")).agg(F.count("*").alias("n"))


FLAGGED = r"""flagged as (select pair_id, idx, case when idx % 11 = 3 then upper(md5(mk)) || ' ' || mk when idx % 11 = 5 then '12 13 14 ' || idx::varchar when idx % 11 = 7 then 'same text again' else mk end as mk,
case when idx % 11 = 7 then 'and here too' else sq end as sq, case when idx % 5 = 2 then null else labse end as confidence from scored_pairs)"""


def flagged(spark, sf):
    i = F.col("idx")
    mk = F.when(i % 11 == 3, F.concat(F.upper(F.md5(F.col("mk").cast("binary"))), F.lit(" "), "mk")).when(i % 11 == 5, F.concat(F.lit("12 13 14 "), i.cast("string"))).when(i % 11 == 7, "same text again").otherwise(F.col("mk"))
    return v.scored_pairs(spark, sf).select("pair_id", "idx", mk.alias("mk"), F.when(i % 11 == 7, "and here too").otherwise(F.col("sq")).alias("sq"), F.when(i % 5 == 2, None).otherwise(F.col("labse")).alias("confidence"))


@query(f"""with {v.SCORED}, {FLAGGED}, r as (select *, len({v.sql_words("mk")}) as a, len({v.sql_words("sq")}) as b, row_number() over (partition by mk, sq order by pair_id, idx) > 1 as again from flagged)
select pair_id, idx, case when confidence < 0.6 then 'low_confidence' when a < 3 or b < 3 then 'too_short' when a > 250 or b > 250 then 'too_long' when a / b < 0.3 or a / b > 3 then 'bad_ratio'
when {v.sql_ratio("mk", "a-mA-M")} < 0.5 then 'mk_not_cyrillic' when {v.sql_ratio("sq", "A-Za-zëçËÇ")} < 0.5 then 'sq_not_latin' when regexp_matches(mk, '[A-F0-9]{{32}}') or regexp_matches(sq, '[A-F0-9]{{32}}') then 'hex_hash'
when len(list_filter({v.sql_words("mk")}, lambda x: regexp_full_match(x, '[0-9.,/%]+'))) / a > 0.5 or len(list_filter({v.sql_words("sq")}, lambda x: regexp_full_match(x, '[0-9.,/%]+'))) / b > 0.5 then 'mostly_numbers' when again then 'duplicate' else '' end as reason from r""")
def filter_flags(spark, sf):
    f = flagged(spark, sf)
    # the duplicate test covers all rows, flagged ones too; the first of a key by an aggregate rather than a window
    first = f.groupBy("mk", "sq").agg(F.min(F.struct("pair_id", "idx")).alias("first"))
    f = f.join(first, ["mk", "sq"])
    again = F.struct("pair_id", "idx") != F.col("first")
    return f.select("pair_id", F.col("idx").cast("long").alias("idx"), p.flags(F.col("mk"), F.col("sq"), F.col("confidence"), again, "a-mA-M").alias("reason"))


@query(f"""with {v.SCORED}, {FLAGGED}, r as (select *, len({v.sql_words("mk")}) as a, len({v.sql_words("sq")}) as b from flagged),
s as (select mk, sq, (mk <> '' and sq <> '') as s1, (a between 3 and 250 and b between 3 and 250) as s2, (length(mk) / length(sq) between 0.25 and 4) as s3, ({v.sql_ratio("mk", "a-mA-M")} > 0.5) as s4, ({v.sql_kept("mk", "0-9")} / length(mk) < 0.4 and {v.sql_kept("sq", "0-9")} / length(sq) < 0.4) as s5 from r)
select count(*) as n0, count_if(s1) as n1, count_if(s1 and s2) as n2, count_if(s1 and s2 and s3) as n3, count_if(s1 and s2 and s3 and s4) as n4, count_if(s1 and s2 and s3 and s4 and s5) as n5, count(distinct case when s1 and s2 and s3 and s4 and s5 then struct_pack(a := mk, b := sq) end) as n6 from s""")
def filter_funnel(spark, sf):
    f, mk, sq = flagged(spark, sf), F.col("mk"), F.col("sq")
    steps = [(mk != "") & (sq != ""), t.word_count(mk).between(3, 250) & t.word_count(sq).between(3, 250), t.char_ratio(mk, sq).between(0.25, 4), t.script_ratio(mk, "a-mA-M") > 0.5, (t.digit_fraction(mk) < 0.4) & (t.digit_fraction(sq) < 0.4)]
    so_far, cols = F.lit(True), [F.lit(True)]
    for s in steps:
        so_far = so_far & s
        cols.append(so_far)
    f = f.select("mk", "sq", *[c.alias(f"s{i}") for i, c in enumerate(cols)])
    return f.agg(*[F.count_if(f"s{i}").alias(f"n{i}") for i in range(6)], F.count_distinct(F.when(F.col("s5"), F.struct("mk", "sq"))).alias("n6"))


KEYWORDS = " or ".join(f"contains(body, '{w}')" for w in p.TARGET_WORDS)


@query(f"""with {v.PAGES}, g as (select doc_id, count(*) as n_pages, sum(length({v.sql_strip("body")})) as chars, bool_or(regexp_matches(body, '[ëËçÇ]') or {KEYWORDS} or lat > 0.55) as signal from lpages group by doc_id)
select doc_id, case when chars < 300 then 'file_too_small' when n_pages = 0 then 'corrupt' when chars < 400 then 'scanned' when not signal then 'no_albanian' else '' end as reason from g""")
def filter_gatekeeper(spark, sf):
    """Size, pages, text layer, target signal, by document; the thresholds suit lines as pages."""
    x = F.col("body")
    signal = t.has_albanian_markers(x) | (F.col("lat") > 0.55)
    for w in p.TARGET_WORDS:
        signal = signal | F.contains(x, F.lit(w))
    g = v.pages(spark, sf).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length(t.strip(x))).alias("chars"), F.bool_or(signal).alias("signal"))
    return g.select("doc_id", p.first_reason((F.col("chars") < 300, "file_too_small"), (F.col("n") == 0, "corrupt"), (F.col("chars") < 400, "scanned"), (~F.col("signal"), "no_albanian")).alias("reason"))


@query(rf"""select doc_id, length(array_to_string(list_filter(string_split(text, chr(10)), lambda s: length({v.sql_strip("s")}) < 40 or {v.sql_ratio("s", "a-mA-M")} >= 0.5), chr(10))) as n_kept,
(length(text) >= 200 and len(string_split(text, chr(10))) >= 3) as bilingual, length({v.sql_strip("text")}) >= 100 as enough from documents""")
def filter_paragraphs(spark, sf):
    """Short paragraphs stay, others if their language is accepted; documents need text on enough pages."""
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda s: (F.length(t.strip(s)) < 40) | (t.script_ratio(s, "a-mA-M") >= 0.5))
    x = F.col("text")
    return v.table(spark, sf, "documents").select("doc_id", F.length(F.array_join(kept, "\n")).cast("long").alias("n_kept"), ((F.length(x) >= 200) & (F.size(lines) >= 3)).alias("bilingual"), (F.length(t.strip(x)) >= 100).alias("enough"))
