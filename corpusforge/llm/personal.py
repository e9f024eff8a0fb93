"""Personal data by rules and by bootstrapped contextual extraction, with DataFrame functions only.

Rules find the base spans: email, ip, card, phone. They are the seeds. The words of a text are counted, so that a seed and
a candidate in the same words have the same contexts: the two whole words before, and the word before with the word
after, are lexical patterns. Candidates are words that hold a digit or @, without marks at their ends at least ``LEAST``
long, that share no word with a base span. Patterns and instances form a graph weighted by occurrences, which is scored in rounds: a pattern's
confidence in a kind is the share of its occurrences, with one more added, that its known instances' scores vouch for,
if at least ``SUPPORT`` different known instances support it; a candidate's score in a kind is the greatest confidence of
its patterns. Seeds are known with score 1. Candidates with a score of ``SURE`` or more become known with their score,
and so induce patterns in turn, until scores settle or ``ROUNDS`` are over. Known candidates are spans of their best kind
(ties: the last kind in the alphabet) wherever they stand. So an identifier that no rule knows is found where contexts
of known ones introduce it, and what stands in the contexts of found ones after that.

Spans count code points, end exclusive; places are running sums of lengths in blocks, so that very long texts take time
in proportion. Null text: as empty, no spans. Rows with equal id and text get equal spans. An empty table gives an
empty table. Columns pass through, but for ``base`` and ``spans``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import drop_path, shared_dir, stored

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. A match may begin at the start of a run of its first class or where the last match ended, which
#: are the only leftmost places, and loops that end a pattern are possessive: linear time, the same matches.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CANDIDATE = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
SPACE = r"[\x20\x09-\x0D]++"
EDGE = "\"'`.,;:!?()[]{}<>|*_-"
LEAST, SUPPORT, SURE, ROUNDS = 6, 3, 0.8, 8
SPAN = "struct<start:int,end:int,value:string,first:int,last:int>"
BLOCK, SEGMENT = 64, 1024


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def running(xs: Column, zero: Column, join: Callable[[Column, Column], Column], depth: int = 3) -> Column:
    """The running results of ``join`` over an array, in blocks of blocks, since an array that grows by one is copied each time."""

    def plain(some: Column, start: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            return F.struct(join(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(join(acc["at"], x))).alias("out"))

        return F.aggregate(some, F.struct(start.alias("at"), F.slice(F.array(zero), 1, 0).alias("out")), step)["out"]

    if depth == 0:
        return plain(xs, zero)

    def blocks(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(xs) / BLOCK).cast("int") - 1), lambda g: F.slice(xs, g * BLOCK + 1, F.lit(BLOCK)))

    def scanned(cut: Column) -> Column:
        ends = running(F.transform(cut, lambda b: F.aggregate(b, zero, join)), zero, join, depth - 1)
        return bound(ends, lambda e: F.flatten(F.transform(cut, lambda b, g: plain(b, F.coalesce(F.get(e, g - 1), zero)))))

    return bound(xs, lambda x: F.when(F.size(x) > 0, bound(blocks(x), scanned)).otherwise(F.slice(F.array(zero), 1, 0)))


def matches(text: Column, pattern: str) -> Column:
    """Start, end and value of every match, and its first and last word: lengths and white space of the matches and of what
    lies between them add up."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"))
    size = lambda s: F.struct(F.char_length(s).alias("n"), F.regexp_count(s, F.lit(SPACE)).alias("w"))
    add = lambda x, y: F.struct((x["n"] + y["n"]).alias("n"), (x["w"] + y["w"]).alias("w"))

    def spans(both: Column) -> Column:
        inside = F.transform(both["found"], size)

        def named(own: Column) -> Column:
            steps = F.transform(own, lambda _, i: add(F.get(both["between"], i), F.coalesce(F.get(own, i - 1), zero)))
            return F.zip_with(
                running(steps, zero, add), F.arrays_zip(both["found"].alias("value"), own.alias("own")),
                lambda at, m: F.struct(at["n"].alias("start"), (at["n"] + m["own"]["n"]).alias("end"), m["value"].alias("value"), at["w"].alias("first"), (at["w"] + m["own"]["w"]).alias("last")),
            )

        return F.when(F.size(both["found"]) > 0, bound(inside, named)).otherwise(F.array().cast(f"array<{SPAN}>"))

    return bound(F.struct(found.alias("found"), F.transform(between, size).alias("between")), spans)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = F.reverse(digits(value))
    at = F.sequence(F.lit(1), F.length(d))

    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(at, F.lit(0), add) % 10 == 0


def _base(text: Column) -> dict[str, Column]:
    none = F.array().cast(f"array<{SPAN}>")
    count = lambda s, lo, hi: F.length(digits(s["value"])).between(lo, hi)
    ok = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return {
        "email": F.when(F.contains(text, F.lit("@")), matches(text, EMAIL)).otherwise(none),
        "ip": F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(matches(text, IP), lambda s: s["value"].rlike(rf"^{ok}(?:\.{ok}){{3}}$"))).otherwise(none),
        "card": F.when(text.rlike(r"[0-9][\x20-]?[0-9]"), F.filter(matches(text, CARD), lambda s: F.when(count(s, 13, 19), luhn(s["value"])).otherwise(False))).otherwise(none),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(matches(text, PHONE), lambda s: count(s, 9, 15))).otherwise(none),
    }


def _patterns(s: Column, words: Column) -> Column:
    word = lambda i: F.coalesce(F.get(words, i), F.lit(""))
    one = word(s["first"] - 1)
    return F.array(F.concat_ws(" ", F.lit("l"), word(s["first"] - 2), one), F.concat_ws(" ", F.lit("b"), one, word(s["last"] + 1)))


def discover(rows: DataFrame, folder: str) -> DataFrame:
    """kind, value: what high-confidence patterns find. ``rows``: kind (null: a candidate), value, patterns."""
    spark = rows.sparkSession
    edges = rows.select("kind", "value", F.explode("patterns").alias("pattern")).groupBy("pattern", "kind", "value").agg(F.count("*").alias("n"))
    edges = stored(edges, f"{folder}/edges")
    total = stored(edges.groupBy("pattern").agg(F.sum("n").alias("total")), f"{folder}/total")
    seeds, loose = edges.filter("kind is not null").withColumn("score", F.lit(1.0)), edges.filter("kind is null").drop("kind")
    known, before = seeds, None
    for i in range(ROUNDS):
        backed = known.groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("sure"), F.count("*").alias("support")).filter(F.col("support") >= SUPPORT)
        conf = backed.join(total, "pattern").select("pattern", "kind", (F.col("sure") / (F.col("total") + 1)).alias("conf"))
        best = loose.join(conf, "pattern").groupBy("value", "kind").agg(F.max("conf").alias("score")).groupBy("value").agg(F.max(F.struct("score", "kind")).alias("b"))
        found = stored(best.filter(F.col("b.score") >= SURE).select("value", "b.kind", "b.score"), f"{folder}/found{i}")
        if i:
            drop_path(spark, f"{folder}/found{i - 1}")
        now = found.agg(F.count("*"), F.round(F.sum("score"), 3)).first()
        if now == before:
            break
        before = now
        known = seeds.unionByName(loose.join(found, "value"))
    return found.select("value", "kind")


def _named(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(F.lit(KINDS.index(kind) + 1).alias("k"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with base and spans: arrays of (k, start, end, kind) in order of kind and start."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    given = docs.drop("base", "spans")
    names = given.columns
    # the input's columns are fields of one, so that none clashes
    given = given.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    field = lambda c: F.col("row").getField(c)
    body = F.coalesce(field(text), F.lit(""))
    given = given.select("row", field(doc_id).alias("id"), F.xxhash64(body).alias("hash"))
    work = given.select("id", "hash", body.alias("text")).filter(F.col("text").rlike("[0-9@+]"))
    free = F.filter(
        F.transform(
            matches(F.col("text"), CANDIDATE),
            lambda s: bound(F.ltrim(s["value"], F.lit(EDGE)), lambda v: F.struct((s["end"] - F.char_length(v)).alias("start"), (s["end"] - F.char_length(v) + F.char_length(F.rtrim(v, F.lit(EDGE)))).alias("end"), F.rtrim(v, F.lit(EDGE)).alias("value"), s["first"].alias("first"), s["last"].alias("last"))),
        ),
        lambda s: F.char_length(s["value"]) >= LEAST,
    )
    free = F.when(F.col("text").rlike("[0-9@]"), free).otherwise(F.array().cast(f"array<{SPAN}>"))
    work = work.select("id", "hash", "text", *[c.alias(k) for k, c in _base(F.col("text")).items()], free.alias("free")).filter(" or ".join(f"size({k}) > 0" for k in (*KINDS, "free")))
    words = F.split(F.lower(F.col("text")), SPACE, -1)
    every = F.struct(*[F.col(k) for k in (*KINDS, "free")], words.alias("words"))
    packed = lambda s, w: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["first"].alias("first"), s["last"].alias("last"), _patterns(s, w).alias("patterns"))
    every = bound(every, lambda e: F.struct(*[F.transform(e[k], lambda s: packed(s, e["words"])).alias(k) for k in (*KINDS, "free")]))
    work = stored(work.select("id", "hash", every.alias("e")).select("id", "hash", "e.*"), f"{folder}/matches")
    one = lambda k, kind: work.select("id", "hash", kind.alias("kind"), F.explode(k).alias("s")).select("id", "hash", "kind", "s.*")
    base = one(KINDS[0], F.lit(KINDS[0]))
    for k in KINDS[1:]:
        base = base.unionByName(one(k, F.lit(k)))
    taken = base.select(F.col("id").alias("tid"), F.col("hash").alias("thash"), F.explode(F.sequence("first", "last")).alias("tword"))
    loose = one("free", F.lit(None).cast("string"))
    loose = stored(loose.join(taken, F.col("id").eqNullSafe(F.col("tid")) & (F.col("hash") == F.col("thash")) & (F.col("first") == F.col("tword")), "left_anti"), f"{folder}/loose")
    found = discover(loose.unionByName(base).select("kind", "value", "patterns"), folder)
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    added = loose.drop("kind").join(found, "value").select("id", "hash", number.alias("k"), "start", "end", "kind").distinct()
    added = added.groupBy("id", "hash").agg(F.collect_list(F.struct("k", "start", "end", "kind")).alias("added")).select(F.col("id").alias("aid"), F.col("hash").alias("ahash"), "added")
    spans = work.select("id", "hash", F.flatten(F.array(*[_named(k) for k in KINDS])).alias("base")).dropDuplicates(["id", "hash"])
    spans = spans.join(added, F.col("id").eqNullSafe(F.col("aid")) & (F.col("hash") == F.col("ahash")), "left")
    none = F.array().cast("array<struct<k:int,start:int,end:int,kind:string>>")
    spans = spans.select(F.col("id").alias("sid"), F.col("hash").alias("shash"), "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans")).filter("size(spans) > 0")
    spans = stored(spans, f"{folder}/spans")
    for used in ("matches", "loose", "edges", "total"):
        drop_path(spark, f"{folder}/{used}")
    out = given.join(spans, F.col("id").eqNullSafe(F.col("sid")) & (F.col("hash") == F.col("shash")), "left")
    return out.select(*[field(c).alias(c) for c in names], F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first stands for all. The text is
    cut into segments, since finding a place in a string takes time by its distance."""
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def piece(segments: Column, a: Column, b: Column) -> Column:
        one, two = F.floor(a / SEGMENT).cast("int"), F.floor(b / SEGMENT).cast("int")
        head, tail = F.coalesce(F.get(segments, one), F.lit("")), F.coalesce(F.get(segments, two), F.lit(""))
        far = F.concat(F.substring(head, a % SEGMENT + 1, F.lit(SEGMENT)), F.array_join(F.slice(segments, one + 2, F.greatest(F.lit(0), two - one - 1)), ""), F.substring(tail, F.lit(1), b % SEGMENT))
        return F.when(one == two, F.substring(head, a % SEGMENT + 1, b - a)).otherwise(far)

    def written(e: Column) -> Column:
        # a span counts if it begins where all before it have ended
        ends = running(F.transform(e["spans"], lambda s: s["end"]), F.lit(0), lambda x, y: F.greatest(x, y))

        def joined_up(at: Column) -> Column:
            def part(s: Column, i: Column) -> Column:
                before = F.coalesce(F.get(at, i - 1), F.lit(0))
                return F.when(s["start"] >= before, F.concat(piece(e["segments"], before, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")

            return F.concat(F.array_join(F.transform(e["spans"], part), ""), piece(e["segments"], F.element_at(at, -1), e["n"]))

        return bound(ends, joined_up)

    segments = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SEGMENT}}}"), F.lit(0))
    whole = F.struct(by_start.alias("spans"), segments.alias("segments"), F.char_length(text).alias("n"))
    return F.when(F.size(spans) > 0, bound(whole, written)).otherwise(text)
