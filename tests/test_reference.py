"""Literal cases, invariants and brute force for the corpus operators."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.functions import predicates as p
from corpusforge.functions import text as t
from corpusforge.operators import align, dedup, layout, ranking, score, segment, stats, vectors
from corpusforge.sources import tables


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text, f, want",
    [
        ("Ар - мијата", t.join_hyphens, "Армијата"), ("për-\nmbushur", t.join_hyphens, "përmbushur"), ("a-b-c", t.join_hyphens, "ab-c"), ("a-b-c", lambda c: t.join_hyphens(t.join_hyphens(c)), "abc"),
        ("post-2019", t.join_hyphens, "post-2019"), ("иѓ - ѓа", t.join_hyphens, "иѓ - ѓа"), ("Законот стапува на сила.", t.word_count, 4), ("Законот стапува на сила.", t.cyrillic_ratio, 1.0),
        ("Ligji hyn në fuqi.", t.latin_ratio, pytest.approx(0.928571, abs=1e-6)), ("Член 5 Neni 5", t.cyrillic_ratio, 0.5), ("²³", t.digit_fraction, 1.0), ("", t.digit_fraction, 0.0), ("", t.number_word_fraction, 1.0), ("", t.word_count, 0),
        ("Прва. Втора! Трета", t.sentences, ["Прва.", "Втора!", "Трета"]), ("a.  b; c? d", t.sentences, ["a.", "b; c?", "d"]), ("a.  b; c? d", lambda c: t.sentences(c, ".!?;"), ["a.", "b;", "c?", "d"]),
        ("abcd", t.shingles, ["abc", "bcd"]), ("ab", t.shingles, []), ("é`", lambda c: t.clean_text(c, True), "éë"), ("mk_1999_3", t.year_of, "1999"), ("none", t.year_of, "unknown"), ("A B CC DD EE FF GG HH x", t.upper_run, True), ("AA BB CC DD EE", t.upper_run, False),
    ],
)
def test_text(spark, text, f, want):
    assert one(spark, text, f) == want


def test_noise_lines(spark):
    cases = [("", True), ("12", True), ("12345", False), ("262.", False), ("СОДРЖИНА", False), ("Gazeta Zyrtare", False), ("faqe 3", True), ("5 mars 2020", True), ("x" * 160 + " Faqe 3", False), ("Стр. 2 - Бр. 6 11 јануари 2021", True), ("службен весник", True)]
    got = spark.createDataFrame(cases, "x string, y boolean").withColumn("z", t.is_noise_line(F.col("x"))).collect()
    assert all(r.y == r.z for r in got)


def test_length_ratio_and_months(spark):
    rows = [(10, 10, 1.0), (10, 20, 0.666667), (25, 10, 0.0), (26, 10, 0.0), (4, 10, 0.6), (3, 10, 0.0), (0, 5, 0.0)]
    got = spark.createDataFrame(rows, "a int, b int, y double").withColumn("z", t.length_ratio_score(F.col("a"), F.col("b"))).collect()
    assert all(abs(r.y - r.z) < 1e-6 for r in got)
    rows = [("15 јануари 1947", 1947, 1), ("15. III 1947", 1947, 3), ("15.03.1947", 1947, 3), ("15 јануари 1948", 1947, None)]
    assert all(r.y == r.z for r in spark.createDataFrame(rows, "x string, n int, y int").withColumn("z", t.month_of(F.col("x"), F.col("n"))).collect())


def test_items(spark):
    docs = spark.createDataFrame([(1, "intro\n 262. \nbody a\n\n263.\nbody b\n262.\nlast"), (2, "nothing"), (3, "")], "id long, body string")
    assert {(r.id, r.number, r.body) for r in segment.items(docs, ["id"]).collect()} == {(1, "262", "last"), (1, "263", "body b")}
    a = spark.createDataFrame([(1, "262", 0, "x"), (1, "263", 1, "y")], "id long, number string, pos int, body string")
    b = spark.createDataFrame([(1, "263", 0, "u"), (1, "264", 1, "v")], "id long, number string, pos int, body string")
    assert {(r.number, r.kind) for r in segment.matched(a, b, ["id", "number"]).collect()} == {("262", "source"), ("263", "both"), ("264", "target")}


def test_costs():
    cost = align.gale_church_cost
    assert [round(float(sum(cost(m, np.array([a]), np.array([b])))[0]), 6) for m, a, b in (((1, 1), 110, 100), ((1, 1), 50, 100), ((1, 0), 100, 0))] == [0.116534, 0.207955, 105.298317]
    assert [round(float(align.distance(a, b)), 6) for a, b in ((100, 110), (100, 100), (50, 100))] == [0.693147, 1.049972, 2.562154]


@pytest.mark.parametrize("method", list(align.METHODS))
def test_alignment_is_optimal(method):
    moves, cost = align.METHODS[method]
    rng = random.Random(1)

    def best(a, b):
        if not a and not b:
            return 0.0
        found = math.inf
        for di, dj in moves:
            if di <= len(a) and dj <= len(b):
                step = sum(float(np.ravel(x)[0]) for x in cost((di, dj), np.array([float(sum(a[:di]))]), np.array([float(sum(b[:dj]))])))
                found = min(found, step + best(a[di:], b[dj:]))
        return found

    for n, m in itertools.product(range(1, 5), repeat=2):
        a, b = [rng.randint(5, 90) for _ in range(n)], [rng.randint(5, 90) for _ in range(m)]
        steps, want = align.path(a, b, method), best(a, b)
        if math.isinf(want):
            assert not steps
        else:
            assert steps[-1][4] == pytest.approx(want) and steps[0][0] == steps[0][2] == 0 and steps[-1][1] == n and steps[-1][3] == m
            assert all(x[1] == y[0] and x[3] == y[2] for x, y in zip(steps, steps[1:], strict=False))


def test_alignment_without_a_way(spark):
    assert align.path([10], [10, 10, 10], "article") == []
    df = spark.createDataFrame([(1, ["Прва реченица."], ["Fjalia e parë."]), (2, [], ["x"])], "id long, a array<string>, b array<string>")
    assert [(r.id, r.mk_indices, r.move) for r in align.align(df, ["id"], "gale_church").collect()] == [(1, [0], "1-1")]


def test_monotone_chain():
    assert align.monotone_chain([(0, 2, 0.9), (1, 0, 0.8), (2, 1, 0.7)]) == [(1, 0, 0.8), (2, 1, 0.7)] and align.monotone_chain([]) == []


def test_blends(spark):
    df = spark.createDataFrame([(0.8, 0.6, 1.0)], "labse double, laser3 double, length double")
    c = {k: F.col(k) for k in ("labse", "laser3", "length")}
    r = df.select(score.blend_structural(c).alias("a"), score.blend_structural({k: c[k] for k in ("labse", "length")}).alias("b")).first()
    assert (round(r.a, 6), round(r.b, 6)) == (0.78, 0.857143)
    assert score.chrf("the cat", "the cat") == pytest.approx(1) and score.chrf("", "x") == 0 and 0 < score.chrf("the cat sat", "the cat sits") < 1


def test_greedy_keeps_what_the_sequence_keeps(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(3)) for _ in range(120)] + ["ab", "x", "ab"]
    df = spark.createDataFrame([(i, x, x[::-1]) for i, x in enumerate(texts)], "ord long, mk string, sq string")
    rows = dedup.buckets(df, ["mk", "sq"], "ord", 12, 3, 4).collect()
    of = {}
    for r in rows:
        of.setdefault(r.ord, set()).add((r.side, r.band, r.key))
    taken, want = set(), []
    for i in sorted(of):
        if not of[i] & taken:
            want.append(i)
            taken |= of[i]
    assert sorted(r.ord for r in dedup.greedy(df, ["mk", "sq"], "ord", 12, 3, 4).collect()) == want


def test_numbers_and_split(spark):
    df = spark.range(997).select((F.col("id") * 7 % 997).alias("k"))
    assert sorted((r.k, r.rn) for r in ranking.numbered(df, "k").collect()) == [(i, i + 1) for i in range(997)]
    assert {r["split"]: r["count"] for r in stats.split(df, "k").groupBy("split").count().collect()} == {"train": 797, "validation": 99, "test": 101}
    assert (int(0.8 * 81351), int(0.1 * 81351)) == (65080, 8135)


def test_best_matches_tiles(spark):
    rng = np.random.default_rng(2)
    rows = [(g, "s" if i % 2 == 0 else "t", i, rng.normal(size=4).tolist()) for g in (1, 2) for i in range(60)]
    df = spark.createDataFrame(rows, "grp int, side string, i long, v array<double>")
    whole, tiled = ({(r.grp, r.i): r.j for r in vectors.best_matches(df, n).collect()} for n in (1000, 7))
    assert whole == tiled and len(whole) == 120


def test_layout_split(spark):
    pages = spark.createDataFrame([(1, i, b, c, l) for i, (b, c, l) in enumerate([("a", 0.9, 0.0), ("b", 0.9, 0.1), ("c", 0.1, 0.9), ("d", 0.2, 0.8)])], "doc_id long, page int, body string, cyr double, lat double")
    r = layout.transitions(pages).first()
    assert (r.hard, r.transition) == (2, 2) and layout.decide(pages, F.lit(False)).first().layout == "sequential"
    s = layout.split_at(pages, F.lit(None).cast("int")).first()
    assert (s.source_text, s.target_text) == ("a\nb", "c\nd")


def test_reasons(spark):
    rows = [("a b", "a b c d e f", "mk_too_short_2"), ("one two three four five", "one two three four five", ""), ("1 2 3 4 5", "one two three four five", "mk_digits_0.56")]
    df = spark.createDataFrame(rows, "a string, b string, y string").withColumn("z", p.pair_reason(F.col("a"), F.col("b"), "A-Za-z"))
    assert [(r.y, r.z) for r in df.collect() if r.y != r.z] == []


@pytest.mark.parametrize("kind", list(tables.FORMATS))
def test_formats(spark, tmp_path, kind):
    df = spark.createDataFrame([("a \"quoted\", text", 0.5, 1), ("Член 5", None, 2), ("plain", 1.5, None)], "mk string, s double, n long")
    tables.write(df, f"{tmp_path}/x", kind)
    assert sorted(map(str, tables.read(spark, f"{tmp_path}/x", kind, df.schema).collect())) == sorted(map(str, df.collect()))


def test_files_and_checkpoints(spark, tmp_path):
    (tmp_path / "pdfs/1999/b").mkdir(parents=True)
    (tmp_path / "pdfs/1999/b/x.pdf").write_bytes(b"1")
    (tmp_path / "y.pdf").write_bytes(b"22")
    assert {(r.doc_id, r.length) for r in tables.documents_of(spark, str(tmp_path)).collect()} == {("1999_b_x", 1), ("y", 2)}
    df = spark.createDataFrame([(1, "a" * 300, 0.123456), (2, "b", 1.0)], "k long, mk string, s double")
    assert tables.pending(df, f"{tmp_path}/done", "k").count() == 2
    df.filter("k = 1").write.parquet(f"{tmp_path}/done")
    assert [r.k for r in tables.pending(df, f"{tmp_path}/done", "k").collect()] == [2]
    tables.log(df, f"{tmp_path}/log")
    tables.log(df, f"{tmp_path}/log")
    got = spark.read.json(f"{tmp_path}/log")
    assert got.count() == 4 and got.agg(F.max(F.length("mk"))).first()[0] == 200
    (tmp_path / "bad.json").write_text("[{")
    assert tables.json_array(spark, f"{tmp_path}/bad.json", df.schema).count() == 0
