"""Steps that once grew faster than their input: bounded slices, one pass instead of many, the same results."""

import hashlib
import random
import unicodedata
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusforge.functions import text as t
from corpusforge.operators import align, dedup, layout, score


def test_rows_with_the_same_buckets_are_decided_at_once(spark, monkeypatch):
    """Of 60 rows of three texts three reach the rounds."""
    df = spark.createDataFrame([(i, f"the {'first second third'.split()[i % 3]} of some texts") for i in range(60)], "ord long, mk string")
    seen, buckets = [], dedup.buckets
    monkeypatch.setattr(dedup, "buckets", lambda rows, *rest: seen.append(rows.count()) or buckets(rows, *rest))
    assert sorted(r.ord for r in dedup.greedy(df, ["mk"], "ord").collect()) == [0, 1, 2] and seen == [3]


def test_rounds_against_the_sequence(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(1, 5))) for _ in range(150)] + ["", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "ord long, mk string")
    of = {}
    for r in dedup.buckets(df, ["mk"], "ord", 12, 3, 4).collect():
        of.setdefault(r.ord, set()).add((r.side, r.band, r.key))
    taken, want = set(), []
    for i in sorted(of):
        if not of[i] & taken:
            want.append(i)
            taken |= of[i]
    for few in (0, 20):
        assert sorted(r.ord for r in dedup.greedy(df, ["mk"], "ord", 12, 3, 4, few=few).collect()) == want


@pytest.mark.parametrize("most", [0, 7, 1 << 16])
def test_kept_grams_are_bounded(most):
    h = dedup.MinHash(16, most)
    for x in ("", "ab", "abc", "бесплатно", "a longer text, of more grams than are kept", None):
        grams = {(x or "")[i : i + 3] for i in range(len(x or "") - 2)}
        hashes = [int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % dedup.PRIME for g in grams]
        assert h.least(x, 3).tolist() == [min(((v * a + b) % dedup.PRIME for v in hashes), default=dedup.PRIME) for a, b in dedup.permutations(16)]
        assert len(h.at) <= most


def test_chrf_by_counting_all_grams(monkeypatch):
    """Against the definition; strings are not cut into a tuple for every gram."""
    rng = random.Random(4)
    for _ in range(60):
        h, r = (" ".join("".join(rng.choice("abc.,") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 9))) for _ in range(2))
        want, orders = 0.0, 0
        for n in range(1, 7):
            a, b = (Counter(x[i : i + n] for i in range(len(x) - n + 1)) for x in ("".join(h.split()), "".join(r.split())))
            if a and b:
                hit, orders = sum((a & b).values()), orders + 1
                p, q = hit / sum(a.values()), hit / sum(b.values())
                want += 5 * p * q / (4 * p + q) if hit else 0.0
        assert score.chrf(h, r, words=0) == pytest.approx(want / orders if orders else 0.0)
    made = []
    monkeypatch.setattr(score, "tuple", lambda x: made.append(x) or tuple(x), raising=False)
    assert score.chrf("one two three", "one two four") > 0 and not made


def test_costs_come_in_blocks(monkeypatch):
    """A path calls the cost function per block of rows, not per row, and gives the same in blocks of any size."""
    rng = random.Random(6)
    a, b = ([rng.randint(1, 90) for _ in range(60)] for _ in range(2))
    for method, (moves, cost) in list(align.METHODS.items()):
        calls = []
        monkeypatch.setitem(align.METHODS, method, (moves, lambda *x, cost=cost, calls=calls: calls.append(1) or cost(*x)))
        whole = align.path(a, b, method)
        assert len(calls) <= len(moves) + len(whole)
        monkeypatch.setattr(align, "CELLS", 200)
        assert align.path(a, b, method) == whole
        monkeypatch.undo()


def test_pairs_are_handed_on_in_slices(spark, monkeypatch):
    monkeypatch.setattr(align, "MOST_PAIRS", 4)
    rows = [(i, ["Прва реченица.", "Втора."], ["Fjalia e parë.", "E dyta."]) for i in range(9)]
    run = {}
    df = spark.createDataFrame(rows, "id long, a array<string>, b array<string>")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: run.update(f=f) or self)
    align.align(df, ["id"], "gale_church")
    table = pa.table({"id": [r[0] for r in rows], "a": [r[1] for r in rows], "b": [r[2] for r in rows]})
    sizes = [x.num_rows for x in run["f"](iter(table.to_batches()))]
    assert sum(sizes) == 18 and max(sizes) <= 6


def test_only_texts_that_nfc_changes_go_through_python(spark):
    texts = ["plain", "é ü", "Член 5 – „x“", "é", "ӑ", None, "", "가", "Ω"]
    got = spark.createDataFrame([(x,) for x in texts], "x string").select("x", t.nfc(F.col("x")).alias("y"), F.col("x").rlike(f"[^{t.NFC_SAFE}]").alias("z")).collect()
    assert all(r.y == (r.x and unicodedata.normalize("NFC", r.x)) for r in got) and [bool(r.z) for r in got] == [False] * 3 + [True] * 2 + [False] * 2 + [True] * 2
    for first, last in ((0, 0x2FF), (0x400, 0x482), (0x48A, 0x4FF), (0x2010, 0x2027)):
        for c in map(chr, range(first, last + 1)):
            assert unicodedata.normalize("NFC", c) == c and not unicodedata.combining(c) and all(unicodedata.normalize("NFC", x + c) == x + c for x in "aeouAд")


def test_classes_and_words_in_one_pass(spark):
    texts = ["Член 5, ab² 1,5 %", "", " ", "no break   12", None, "x", "ëç\x1cÜ", "٠١ 中文"]
    classes = (r"\p{L}", t.CYRILLIC, t.DIGITS, "A-Za-zëçËÇ")
    df = spark.createDataFrame([(x,) for x in texts], "x string").select("x", t.counts(F.col("x"), classes, "0-9.,/%").alias("n"), F.array(*[t.kept(F.col("x"), c) for c in classes], t.word_count(F.col("x"))).alias("m"), t.number_word_fraction(F.col("x")).alias("f"))
    for r in df.collect():
        assert r.n is None if r.x is None else (r.n[:5] == r.m and r.f == (r.n[5] / r.n[4] if r.n[4] else 1.0))


def test_names_are_searched_for_only_where_they_are(spark):
    plan = spark.range(1).select(F.lit("x").alias("x"), F.lit(1950).alias("y")).select(t.month_of(F.col("x"), F.col("y")).alias("m"))._jdf.queryExecution().analyzed().toString()
    assert "transform(array(lower(" in plan and "Contains(lambda" in plan
    rows = [("12. III 1950", 3), ("III 1950", None), ("5 мај 1949 и 6 мај 1950", None), ("6. jun 1950", 6), ("juna 1950", 6)]
    assert all(r.m == r.want for r in spark.createDataFrame(rows, "x string, want int").select("want", t.month_of(F.col("x"), F.lit(1950)).alias("m")).collect())


def test_boxes_of_a_document_stay_in_place(spark):
    """No shuffle, the same as with a row a box."""
    rng = random.Random(9)
    rows = [(d, k, f"w{rng.randint(0, 99)}é", float(rng.randint(0, 600)), rng.randint(0, 40) * 1.3) for d in range(4) for k in range((0, 1, 25, 90)[d])]
    boxes = spark.createDataFrame(rows, "doc_id long, k int, word string, x0 double, top double")
    boxed = boxes.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("k", "word", "x0", "top"))).alias("boxes")).unionByName(spark.createDataFrame([(9, [])], "doc_id long, boxes array<struct<k:int,word:string,x0:double,top:double>>"))
    boxed = spark.createDataFrame(boxed.collect(), boxed.schema)
    order = [F.round("top", 1), F.col("x0"), F.col("k")]
    for a, b in (
        (layout.lines(boxes, F.lit(3.0), order), layout.boxed_lines(boxed, 3.0, lambda b: F.struct(F.round(b["top"], 1).alias("top"), b["x0"], b["k"]))),
        (layout.page_side_features(boxes, 612.0, 0.08, "a-mA-M", "A-Za-z"), layout.boxed_side_features(boxed, 612.0, 0.08, "a-mA-M", "A-Za-z")),
    ):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect())) and "Exchange" not in b._jdf.queryExecution().executedPlan().toString()
