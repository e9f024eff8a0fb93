"""The training-data operators against brute force, the libraries, and odd rows."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import egojoin, idfile, mixing, mpeg, pagetext, personal, pieces, simhash, toxicity
from corpusforge.llm.common import components
from corpusforge.llm.queries import PIECE_BPE, WORD_BPE, tokenizer

COPY = "one two three four five six seven eight nine ten " * 4
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. Mail a.b@x.example.org or +1 (555) 010-9999.", "s1"),
    (2, None, "s1"),
    (3, "", None),
    (4, COPY, "s2"),
    (5, COPY, "s2"),
    (5, COPY, "s2"),
    (6, COPY + "eleven", "s2"),
    (7, "card 4111 1111 1111 1111, ip 10.0.0.255, not 10.0.0.256\nline\ttwo  ", "s3"),
    (8, "  漢字 😀 é ▁ <|endoftext|> \x00 " + "long" * 3000, "s3"),
    (9, "word " * 5000, "s1"),
    (None, "no id at all", "s4"),
]
SCHEMA = "doc_id long, text string, source string, ids string, size int, score string, media int, spans int"


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns clash with names that operators add
    return spark.createDataFrame([(i, t, s, "x", 1, "y", 2, 3) for i, t, s in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


def test_pieces(docs, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE_BPE))
    got = pieces.encode_decode(docs, tokenizer(PIECE_BPE)).select("doc_id", "ids", "decoded").collect()
    want = [(i, sp.encode(t or ""), sp.decode(sp.encode(t or "")) if t else "") for i, t, _ in TEXTS]
    assert same([(r.doc_id, r.ids, r.decoded) for r in got], want)
    assert pieces.encode_decode(none, tokenizer(PIECE_BPE)).count() == 0


def test_pieces_agenda():
    p = pieces.Pieces(tokenizer(PIECE_BPE))
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "é", "漢", "😀", "▁", "\t", "\x00", "the", "ing", "<0x41>", "<s>", "\r", "ß"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(500)] + ["", "\n", "ab" * 2000]
    assert [x.tolist() for x in p.encode(texts)] == p.sp.encode(texts)
    assert all(p.by_heap(c) == list(np.frombuffer(x, "<i4")) for c in ["▁hello", "▁▁▁x", "zzz"] for x in p.together([c]))


def test_idfile(spark, docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer(WORD_BPE))
    manifest = idfile.write(docs, tokenizer(WORD_BPE), 2)
    got = idfile.read(manifest).collect()
    rows = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))  # the only equal ids have equal texts
    want, start = [], 0
    for i, t, _ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, ids))
        start += len(ids)
    assert same([(r.doc_id, r.start, r.ids) for r in got], want)
    path = next(r.path for r in manifest.collect() if idfile.read_document(r.path, 7))
    assert idfile.read_document(path, 7) == next(x for i, _, x in want if i == 7)
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in idfile.digests(idfile.read(manifest)).collect()}
    assert all(crc[i, s] == zlib.crc32(np.array(x, "<u4").tobytes()) for i, s, x in want)
    assert idfile.read(idfile.write(none, tokenizer(WORD_BPE), 2)).count() == 0


def test_idfile_words(monkeypatch):
    """Remembered words, marks after them, letters that are lowered, and forgetting, against the library."""
    monkeypatch.setattr(idfile, "CACHE", 40)
    e, rng = idfile.Encoder(tokenizer(WORD_BPE)), random.Random(6)
    odd = ["A,b ÀÉ!!! İstanbul ΣΑΣ, ΟΔΟΣ. 12,5% x'S don'T, <|ENDOFTEXT|> a", "é, É!! KK ﬁ, ß. ||| a|b| 9!", "é̂,, 漢字, 1., ²! ٣, "]
    some = ["The", "the", "the,", "THE!!", "x'S", "é,", "9.", "%%%", "e\u0301,", "don't", "a", "a$$$", "ǅ:", "<|startoftext|>", ","]
    texts = odd + [" ".join(rng.choices(some, k=rng.randint(0, 60))) for _ in range(200)]
    for k in range(0, len(texts), 7):
        part = texts[k : k + 7]
        assert [np.frombuffer(x, e.kind).tolist() for x in e.encode(part)] == [e.tok.encode(t, add_special_tokens=False).ids for t in part]


def test_idfile_long(spark, monkeypatch):
    """Parts, shards and slices of long texts, and rows of one id over several shards."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(idfile, "PART", 1_000)
    monkeypatch.setattr(idfile, "SHARD", 50_000)
    tok = Tokenizer.from_file(tokenizer(WORD_BPE))
    texts = [(7 if i < 60 else i, f"{i} some words\tin  line {i}\n" * 100) for i in range(90)]
    manifest = idfile.write(spark.createDataFrame(texts, "doc_id long, text string"), tokenizer(WORD_BPE), 2)
    got = idfile.read(manifest).orderBy("start").collect()
    ids = sorted((i, [*tok.encode(t, add_special_tokens=False).ids, 2]) for i, t in texts)
    assert manifest.count() > 1 and sorted((r.doc_id, r.ids) for r in got) == ids and [r.doc_id for r in got] == sorted(i for i, _ in texts)
    assert [r.start for r in got] == np.cumsum([0, *[len(r.ids) for r in got]])[:-1].tolist()


def test_mpeg(docs, none):
    for r in mpeg.read(mpeg.store(docs)).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        data = (r.text or "").encode()
        assert r.payload == data + bytes(-len(data) % 64 or (0 if data else 64)) and r.n_bytes == len(data)
        assert r.crc_bad == 0 and r.crc_checked == r.n_frames == len(r.seek) and r.samples == 1152 * r.n_frames
    assert mpeg.read(mpeg.store(none)).count() == 0


def test_mpeg_damage():
    s = mpeg.stream(bytes(range(250)) * 40)
    whole = mpeg.parse(s)
    hurt = bytearray(s[:3000] + b"\xff\xfb\x00junk" + s[3000:])
    got = mpeg.parse(bytes(hurt))
    assert got["skipped"] > 0 and abs(len(got["seek"]) - len(whole["seek"])) <= 1
    hurt = bytearray(s)
    hurt[whole["seek"][2] + 8] ^= 4  # side information
    assert mpeg.parse(bytes(hurt))["crc_bad"] == 1
    assert mpeg.parse(b"")["seek"] == [] and mpeg.parse(b"no audio at all")["skipped"] == 15
    # the second layer, 44.1 kHz, two channels, with a closing tag
    frame = bytes([0xFF, 0xFD, 0x80, 0x00]) + bytes(144 * 128000 // 44100 - 4)
    got = mpeg.parse(frame * 3 + b"TAG" + b"name".ljust(125, b"\0"))
    assert (got["samples"], got["rate"], got["kinds"], got["tags"]["title"]) == (3456, 44100, {(1, 2)}, "name")


def brute_components(n, pairs):
    p = list(range(n))

    def root(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        p[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_simhash(docs, none):
    import xxhash

    got = simhash.near_duplicates(docs, shingle=4).collect()

    def fp(t):
        w = words(t)
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))

    f = [fp(t) for _, t, _ in TEXTS]
    at = brute_components(len(f), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 4])
    least = [min((TEXTS[j][0] for j in range(len(f)) if at[j] == at[i] and TEXTS[j][0] is not None), default=None) for i in range(len(f))]
    assert same([(r.doc_id, r.fp % 2**64, r.component_id) for r in got], [(TEXTS[i][0], f[i], least[i]) for i in range(len(f))])
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("radius, tile", [(4, 16), (4, 100_000), (0, 16), (1, 16), (3, 16), (5, 16)])
def test_simhash_links(spark, radius, tile):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(30)}
    values = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = dict(components(simhash.links(fps, radius, tile=tile)).collect())
    u = np.array(values, np.int64).view(np.uint64)
    at = brute_components(len(values), [(i, j) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u[i] ^ u) <= radius).tolist()])
    assert [got.get(v, v) for v in values] == [values[a] for a in at]


def test_simhash_long_text():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdef", k=rng.randint(1, 9))) for _ in range(400_000))
    whole = [text[:k].encode() for k in (5, 3_000, len(text))]
    old, simhash.PART = simhash.PART, 5_000
    parts = simhash.fingerprints_of(whole, 4).tolist()
    simhash.PART = 1 << 30
    assert parts == simhash.fingerprints_of(whole, 4).tolist()
    simhash.PART = old


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160)) and len(got) == 101
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_egojoin(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    x = np.vstack([base + rng.normal(size=base.shape) * s for s in (0, 0.1, 0.2, 0.3)] + [base[:1]] * 20)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] + [1.0] * 7), (904, [1.0]), (905, []), (906, [2.0]), (None, [1.0] * 8)]
    got = {r.vec_id: r for r in egojoin.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T >= 0.95
    at = brute_components(len(x), np.argwhere(s).tolist())
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (s[i].sum() - 1, at[i], at[i] == i)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in (900, 901, 902, 903, 905))
    assert (got[904].component_id, got[906].component_id) == (904, 904)
    assert egojoin.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_egojoin_skips_distant_runs():
    lo = np.array([[0.0], [1.0], [5.0], [5.1]])
    assert [egojoin.partners(i, lo, lo + 0.1, 0.3) for i in range(4)] == [[0], [1], [2, 3], [3]]


def test_egojoin_intervals(spark, monkeypatch):
    """Many intervals, of which distant ones are skipped, give what brute force gives."""
    monkeypatch.setattr(egojoin, "LEAST", 16)
    monkeypatch.setattr(egojoin, "INTERVAL_BYTES", 16 * 8 * 6)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 6))
    x = np.vstack([base + rng.normal(size=base.shape) * s for s in (0, 0.1, 0.2)])
    got = {r.vec_id: r for r in egojoin.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T >= 0.95
    at = brute_components(len(x), np.argwhere(s).tolist())
    assert all((got[i].n_links, got[i].component_id) == (s[i].sum() - 1, at[i]) for i in range(len(x)))


def test_mixing(docs, none, spark):
    rows = docs.select("doc_id", "text", "source", F.lit(1).alias("taken"))
    got = mixing.mix(rows).select("doc_id", "size", "source_size", "target", "taken").toPandas()
    con = duckdb.connect()
    documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    con.register("documents", documents.astype({"doc_id": "Int64"}))
    want = con.execute(mixing.ORACLE).fetchdf()
    assert same(got.astype(float).fillna(-1).values.tolist(), want.astype(float).fillna(-1).values.tolist())
    assert (got.taken <= 2 * got["size"]).all()
    assert mixing.mix(none.drop("size")).count() == 0


def test_mixing_levels(spark):
    big = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 7 as int))").alias("text"), F.expr("concat('s', id % 5)").alias("source"))
    got = mixing.mix(big).toPandas()
    con = duckdb.connect()
    con.register("documents", big.toPandas())
    want = con.execute(mixing.ORACLE).fetchdf()
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    assert same(got[cols].values.tolist(), want[cols].values.tolist())
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(by.taken - by.target) <= 3).all()


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for k, p in kinds.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if (k == "ip" and max(map(int, m[0].split("."))) > 255) or (k == "card" and not (13 <= len(d) <= 19 and luhn(d))) or (k == "phone" and not 9 <= len(d) <= 15):
                continue
            yield k, m.start(), m.end()


def test_personal_base(spark, docs, none):
    rng = random.Random(9)
    parts = ["a", "Z9", ".", "@", "b.c", "1", "255", "256", "10.1.2.3", "4111111111111111", " ", "-", "+", "+1 555", "(", ")", "x@y.z", "é", "😀", "_", "4111 1111 1111 1111", "\n", "00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(400)] + ["9" * 5000, "+1" + "(" * 3000, "a" * 5000 + "@", "1.1.1." * 500, "1 " * 4000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in personal.find(rows).select("doc_id", "base").collect()}
    assert [got[i] for i in range(len(texts))] == [list(base_spans(t)) for t in texts]
    got = personal.find(docs).collect()
    assert same([(r.doc_id, [(s.kind, s.start, s.end) for s in r.base]) for r in got], [(i, list(base_spans(t or ""))) for i, t, _ in TEXTS])
    assert personal.find(none).count() == 0


def test_personal_discovers(spark):
    texts = [f"please call me {'today' if i % 2 else 'soon'} on number +1 (555) 010-{1000 + i} thanks" for i in range(30)] + ["call on number 555-0199-AB thanks", "the year 2024-01-02 was long"]
    rows = personal.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r for r in rows.withColumn("masked", personal.redacted(F.col("text"), F.col("spans"))).collect()}
    assert [(s.kind, texts[30][s.start : s.end]) for s in got[30].spans] == [("phone", "555-0199-AB")] and not got[30].base
    assert got[30].masked == "call on number [PHONE] thanks" and not got[31].spans and got[31].masked == texts[31]
    assert got[0].masked == "please call me soon on number [PHONE] thanks"


def test_personal_bootstraps(spark):
    """Found values induce patterns that find others, and contexts are whole words however long."""
    long = "q" * 300
    texts = [f"{long} reach number +1 (555) 010-{1000 + i} now" for i in range(30)]
    texts += [f"{long} reach number desk-{10 + i}-x now" for i in range(6)] + [f"the badge desk-{10 + i}-x opens" for i in range(6) for _ in range(4)]
    texts += ["the badge hall-99-z opens", "q other number seat-1234 later", "the badge is old 2024-01-02"]
    rows = personal.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans] for r in rows.collect()}
    assert all(got[30 + i] == [f"desk-{10 + i}-x"] for i in range(6)) and all(got[36 + k] == [f"desk-{10 + k // 4}-x"] for k in range(24))
    assert got[60] == ["hall-99-z"] and got[61] == [] and got[62] == []


def test_personal_recall(spark):
    """Planted identifiers of a kind that no rule knows, in contexts of known ones and elsewhere."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    known = [f"{word()} {word()} contact mail u{i}@host{i % 7}.example.org please {word()}" for i in range(300)]
    planted = [f"{word()} contact mail u{i}@intranet please {word()} {word()}" for i in range(50)]
    clean = [f"{word()} version {i}.{i % 9}.beta of {word()} in 20{i:02d}-11" for i in range(99)]
    texts = known + planted + clean
    got = {r.doc_id: r for r in personal.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum([texts[i][s.start : s.end] for s in got[i].spans] == [f"u{i - 300}@intranet"] for i in range(300, 350)) >= 45
    assert all(not got[i].spans for i in range(350, len(texts)))


def test_personal_long(spark):
    """A text of 5 MB with half a million numbers and many spans, in time."""
    text = "call 555-1234-5 at 10.0.0.1 or +1 555 010 9999, " * 100_000
    rows = spark.createDataFrame([(1, text), (2, "x" * 5_000_000), (3, "1 " * 2_000_000), (4, "@" * 2_000_000)], "doc_id long, text string")
    began = time.time()
    out = personal.find(rows).withColumn("masked", personal.redacted(F.col("text"), F.col("spans")))
    got = {r.doc_id: r for r in out.select("doc_id", F.size("base").alias("n"), F.md5("masked").alias("h")).collect()}
    assert [got[i].n for i in (1, 2, 3, 4)] == [200_000, 0, 0, 0]
    assert got[1].h == hashlib.md5(("call 555-1234-5 at [IP] or [PHONE], " * 100_000).encode()).hexdigest() and time.time() - began < 60


def test_redacted(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("aé😀 ") for _ in range(rng.choice([0, 5, 1023, 1024, 1025, 5000])))
        spans = sorted({tuple(sorted(rng.sample(range(len(text) + 1), 2))) for _ in range(rng.randint(0, 150))} if text else [])
        rows.append((i, text, [(s, e, "ip") for s, e in spans]))
    got = {r.doc_id: r.m for r in spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start:int,end:int,kind:string>>").select("doc_id", personal.redacted(F.col("text"), F.col("spans")).alias("m")).collect()}
    for i, text, spans in rows:
        out, at = "", 0
        for s, e, _ in spans:
            out, at = (out + text[at:s] + "[IP]", e) if s >= at else (out, max(at, e))
        assert got[i] == out + text[at:]


def test_clashing_names(spark):
    """Columns with names that operators use inside."""
    names = ["_hash", "_sid", "_shash", "id", "hash", "row", "sid", "base", "rest", "passes", "below", "_source", "_h", "h", "copies", "target", "a.b", "_key", "_paths", "_html", "_host", "found", "k"]
    rows = spark.createDataFrame([(1, "mail a@b.org", "s", *["x"] * len(names))], "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    got = personal.find(rows).first().asDict()
    assert got["_hash"] == got["row"] == got["a.b"] == "x" and [s.kind for s in got["spans"]] == ["email"]
    got = mixing.mix(rows).first().asDict()
    assert got["rest"] == got["below"] == got["_source"] == got["a.b"] == "x" and got["size"] == 2
    got = pagetext.extract(rows.withColumn("html", F.lit("<p>t</p>")).withColumn("url", F.lit("u"))).first().asDict()
    assert got["_key"] == got["_html"] == got["a.b"] == "x" and got["text"] == "t"


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body class="home-page">
<header>top</header><nav><ul><li><a href="/">menu</a></ul></nav><div class="cookie-notice">we use</div><div id="wrap"><div class="post-42 entry">
<h1>Head&amp;line</h1><p>First <b>bold</b>&nbsp; text<br>with break<p>Second, unclosed <a href=x>link</a><script>x("<p>no</p>")</script><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></div>
<aside>side</aside><div class="comments"><p>reader says hello hello hello hello hello hello hello hello</p></div><form><p>form</p></form></div><footer>foot</footer></body></html>"""
BODY = "Head&line\nFirst bold text with break\nSecond, unclosed link\none\ntwo\nc1\nc2"


def test_pagetext(spark):
    odd = PAGE.replace("post-42 entry", "post-7 entry").replace("First", "A page of the same host")
    rows = [(1, "http://h.example/a", PAGE, 5), (2, "http://h.example/b", odd, 5), (3, None, None, 5), (4, "x", "", 5), (5, "http://g/", "plain <b>text</b> &lt;ok", 5), (1, "http://h.example/a", PAGE, 5), (6, "http://i/", "<article><p>a</p><div class='ad'>b</div>c</article>" + "<div>" * 3000 + "deep", 5)]
    got = pagetext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 7 and by[1].text == BODY and by[2].text == BODY.replace("First", "A page of the same host")
    assert (by[3].text, by[4].text, by[5].text, by[6].text) == ("", "", "plain text <ok", "a\nc")
    assert all(r.n_chars == len(r.text) for r in got)
    assert pagetext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pagetext_consensus(spark):
    """A page whose own best container is a list of teasers follows its host."""
    page = "<body><div class='story'><p>{0}</p></div><div class='teasers'><p>{1}</p></div></body>"
    rows = [(i, "http://h/", page.format("story " * 40, "tease")) for i in range(6)] + [(9, "http://h/", page.format("short", "tease " * 30))]
    got = {r.page_id: r.text for r in pagetext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert "short" in got[9] and got[0].startswith("story story")


def labelled(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choice(["ba", "lo", "mi", "ten", "ra", "so", "vi", "dor"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    out = []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(60)]
        if i % 4 == 0:
            for k in range(3):
                w[10 + 15 * k] = rng.choice(["grumblix", "snotface", "worfnagel"])
        out.append((" ".join(w) + ".", i % 4 == 0))
    return out


def test_toxicity():
    train, test = labelled(200, 1), labelled(80, 1)[40:]
    m = toxicity.fit([t for t, _ in train], [y for _, y in train])
    assert all((s >= 0.5) == y for s, (_, y) in zip(m.score([t for t, _ in test]), test, strict=True))
    bent = m.score(["ba lo mi gr-um-blix ten", "ba s n o t f a c e lo", "mi worfxnagel ra", "", "lo mi ba ten"])
    assert (bent[:3] >= 0.5).all() and (bent[3:] < 0.5).all()


def test_toxicity_kernel():
    assert toxicity.kernel("idiot", "idiot") == pytest.approx(1) and toxicity.kernel("idiot", "id.iot") > 0.5 > toxicity.kernel("idiot", "table")
    words_ = ["idiot", "banana", "x" * 30, "aaa", "ßéüø"]
    m = toxicity.Model(["idiot", "banana"], 2, 0.0)
    assert np.allclose(m.similar(words_), [[toxicity.kernel(a, b) for b in m.landmarks] for a in words_], atol=1e-5)
    # the bound dismisses nothing that is near
    rng = random.Random(4)
    some = ["".join(rng.choice("idotban") for _ in range(rng.randint(3, 9))) for _ in range(500)]
    assert all(ok or (v <= toxicity.FLOOR).all() for ok, v in zip(m.reachable(some), m.similar(some), strict=True))


def test_toxicity_frames(spark, docs, none):
    rows = labelled(120, 7)
    texts = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, (_, y) in enumerate(rows)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    m = toxicity.train(texts, labels, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r.score for r in toxicity.score(texts, m).collect()}
    assert all((got[i] >= 0.5) == y for i, (_, y) in enumerate(rows))
    assert toxicity.score(docs, m).count() == len(TEXTS) and toxicity.score(none, m).count() == 0
    m = toxicity.train(none, labels)
    assert [r.score for r in toxicity.score(texts, m).limit(1).collect()] == [0.0]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as p

    good = labelled(120, 3)
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, (t, _) in enumerate(good)] + [(500, COPY, "en", "s0", 1), (501, COPY, "en", "s0", 1), (502, None, None, None, None), (500, COPY, "en", "s0", 1), (503, "write to who@where.example.com " * 3, "en", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(y)) for i, (_, y) in enumerate(good)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    a = p.clean(spark, docs, str(tmp_path))
    assert {r.doc_id for r in a.collect()} == {i for i, (_, y) in enumerate(good) if not y} | {500, 501, 502, 503}
    b = p.distinct(spark, a, str(tmp_path))
    assert sorted(r.doc_id for r in b.collect() if r.doc_id >= 500) == [500, 502, 503] and b.columns == docs.columns
    c = p.masked(spark, b, str(tmp_path))
    assert next(r for r in c.collect() if r.doc_id == 503).text == "write to [EMAIL] " * 3
    d = p.mixed(spark, c, str(tmp_path))
    want = mixing.mix(c).agg(F.sum("copies")).first()[0]
    assert d.count() == want and d.columns == docs.columns
    e = p.run(spark, str(tmp_path)).collect()
    assert len(e) == want and all(r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() for r in e)
