"""Article splitting, entry checks, tolerant readers, exports and runs on small literals."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import predicates as p
from corpusforge.operators import align, runs, segment, vectors
from corpusforge.sources import tables


def docs(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "doc_id long, body string")


def test_headed_articles_keep_their_mark_and_the_last_of_a_number(spark):
    d = docs(spark, "a Член 9 inline\n Член 1\none\n\n  Член 2 two\nЧлен 1 again", "no marks", "", None)
    got = {(r.doc_id, r.number, r.body) for r in segment.headed_articles(d, ["doc_id"], "Член").collect()}
    assert got == {(0, "1", "Член 1 again"), (0, "2", "Член 2 two")}


def test_article_segments_have_headings_and_offsets(spark):
    body = "intro Член 24а first body text ЧЛЕН 3 x Чл.5 third body text "
    d = docs(spark, body, "  only text ", "  ", None)
    got = segment.article_segments(d, ["doc_id"], segment.ARTICLE_MK_EARLY, 3).orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.pos, r.number, r.heading, r.body) for r in got] == [(0, 0, "24а", "Член 24а", "first body text"), (0, 2, "5", "Чл.5", "third body text"), (1, 0, "0", "", "only text")]
    assert body[got[0].start : got[0].end] == "Член 24а first body text " and got[1].end == len(body) and (got[2].start, got[2].end) == (0, 12)


def test_subsections(spark):
    d = docs(spark, "точка 5 Ставот 2 Ставо 3", "", None)
    assert {(r.doc_id, r.kind, r.pos, r.number) for r in segment.subsections(d, ["doc_id"], "mk").collect()} == {(0, 0, 0, "5"), (0, 1, 0, "2"), (0, 1, 1, "3")}
    assert [r.number for r in segment.subsections(docs(spark, "Shkronja b"), ["doc_id"], "sq").collect()] == ["b"]


def test_gatekeeper(spark):
    big = 60 * 1024
    sizes = spark.createDataFrame([(1, 49 * 1024), (2, big), (3, big), (4, big), (5, big), (6, None)], "doc_id long, size long")
    pages = spark.createDataFrame([(1, "Neni"), (3, " х "), (4, "само кирилица на страницата"), (4, None), (5, "само кирилица на страницата"), (5, "Gazeta")], "doc_id long, body string")
    got = {r.doc_id: (r.should_process, r.reason, r.detail) for r in p.gatekeeper(sizes, pages).collect()}
    assert got == {
        1: (False, "file_too_small", "49 KB < 50 KB"), 2: (False, "corrupt_or_unreadable", "0 pages"), 3: (False, "scanned_no_text_layer", "Only 1 chars across 1 pages"),
        4: (False, "no_albanian_detected", "No Albanian signals in 2 pages"), 5: (True, "none", ""), 6: (False, "corrupt_or_unreadable", "0 pages"),
    }


def test_confidence(spark):
    d = spark.createDataFrame([(0.25,), (0.2,), (None,)], "c double")
    assert d.filter(p.confident(F.col("c"))).count() == 1 and d.filter(p.confident(F.col("c"), 0)).count() == 3


def test_tolerant_table(spark, tmp_path):
    (tmp_path / "x.tsv").write_text(' mk \tsq\tconfidence \tsource\na\t"b\nc"\t0.5\ts\nNA\t\thigh\tnull\nd\te\t\t\n')
    got = tables.tolerant_tsv(spark, str(tmp_path / "x.tsv"))
    assert got.columns == ["mk", "sq", "confidence", "source"]
    assert {tuple(r) for r in got.collect()} == {("a", "b\nc", 0.5, "s"), ("", "", 0.0, None), ("d", "e", 0.0, None)}


def test_aligned_defaults_and_blank_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"mk": "a", "sq": "b", "extra": 1}\n\n{"mk": "c", "sq": "d", "article_number": 4, "is_structural": true}\n')
    assert {tuple(r) for r in tables.aligned(spark, str(tmp_path / "x.jsonl")).collect()} == {("a", "b", "", 0, None, "", "", 0, 0, False), ("c", "d", "", 0, 4, "", "", 0, 0, True)}


@pytest.mark.parametrize("n", [0, 1, 50])
def test_json_array_parts_are_one_array(spark, tmp_path, n):
    rows = [(i, None if i % 3 else 'q"\n,]') for i in range(n)]
    d = spark.createDataFrame(rows, "k long, s string").repartition(3)
    tables.write_json_array(d, str(tmp_path / "a"), "k")
    whole = "".join(f.read_text() for f in sorted(Path(tmp_path / "a").glob("part-*")))
    assert [(x["k"], x["s"]) for x in json.loads(whole)] == rows
    assert sorted(tuple(r) for r in tables.read_json_array(spark, str(tmp_path / "a"), d.schema).collect()) == rows


def test_export_list_leaves_out_unknown_formats(spark, tmp_path):
    d = spark.createDataFrame([("a", "b", 1)], "mk string, sq string, n long")
    got = tables.export(d, str(tmp_path), "x", "tsv, XML ,JSON", simple=True)
    assert set(got) == {"tsv", "json"} and tables.read_json_array(spark, got["json"], d.select("mk", "sq").schema).collect() == [("a", "b")]


def test_early_table(spark):
    d = spark.createDataFrame([("a", "b", ("s", 0.0004)), ("c", "d", (None, 5e-05)), ("e", "f", None), ("g", "h", ("s", 0.75))], "mk string, sq string, meta struct<source:string,confidence:double>")
    assert [(r.source_issue, r.article_id, r.confidence, r.alignment_method) for r in tables.early_table(d).collect()] == [("s", "", "0.0004", ""), ("", "", "5e-05", ""), ("", "", "", ""), ("s", "", "0.75", "")]


def test_missing_files_and_limited_listing(spark, tmp_path):
    for folder, names in (("a", "xyz"), ("b", "y")):
        (tmp_path / folder).mkdir()
        for n in names:
            (tmp_path / folder / f"{n}.pdf").write_bytes(n.encode())
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert {r.doc_id for r in tables.missing_files(spark, a, b).collect()} == {"x", "z"}
    assert {(r.doc_id, bytes(r.content)) for r in tables.documents_of(spark, a, limit=2).collect()} == {("x", b"x"), ("y", b"y")}


def half(row):
    if row["n"] % 2:
        raise ArithmeticError("odd")
    return {"half": row["n"] // 2}


def test_failures_are_kept_apart(spark):
    d = spark.createDataFrame([(i, i) for i in range(5)], "k long, n long")
    good, bad = runs.isolated(d, "k", half, "half long", "halving")
    assert {tuple(r) for r in good.collect()} == {(0, 0), (2, 1), (4, 2)} and {tuple(r) for r in bad.collect()} == {(1, "halving", "ArithmeticError: odd"), (3, "halving", "ArithmeticError: odd")}


def test_phases_and_observed_rows(spark):
    ran = []
    known = {n: lambda n=n: ran.append(n) for n in ("scrape", "align", "test")}
    runs.phases("all", known, ("scrape", "align"))
    runs.phases("test", known, ("scrape", "align"))
    assert ran == ["scrape", "align", "test"]
    with pytest.raises(ValueError):
        runs.phases("other", known, ())
    d, seen = runs.observed(spark.range(7), "run", most=F.max("id"))
    d.collect()
    assert seen.get == {"rows": 7, "most": 6}


def test_month_moves(spark, tmp_path):
    rows = [("pdfs/1999/02/a.pdf", 3), ("pdfs/1999/02/b.pdf", 2), ("pdfs/1999/02/c.pdf", None), ("pdfs/d.pdf", 1), ("pdfs/1999/xx/e.pdf", 1)]
    plan = runs.month_moves(spark.createDataFrame(rows, "path string, month int").withColumn("year", F.lit(1999)), "path", "month", "year")
    assert [(r.status, r.detail, r.new_path) for r in plan.collect()] == [("moved", None, "pdfs/1999/03/a.pdf"), ("unchanged", None, None), ("failed", "could not extract month", None), ("failed", "invalid path", None), ("failed", "invalid path", None)]
    (tmp_path / "pdfs/1999/02").mkdir(parents=True)
    (tmp_path / "pdfs/1999/02/a.pdf").write_bytes(b"a")
    assert runs.move(spark, f"file://{tmp_path}", plan, "path") == 1 and (tmp_path / "pdfs/1999/03/a.pdf").read_bytes() == b"a"


def weight(chain):
    return sum(x[2] for x in chain)


def test_chain_is_the_heaviest_rising_one():
    draw = random.Random(5)
    for _ in range(50):
        pairs = [(i, draw.randrange(12), draw.choice((0.5, 0.7, 0.9))) for i in range(draw.randrange(10))]
        got = align.monotone_chain(pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:], strict=False))
        every = [[x for k, x in enumerate(pairs) if m >> k & 1] for m in range(1 << len(pairs))]
        assert weight(got) == pytest.approx(max((weight(c) for c in every if all(a[1] < b[1] for a, b in zip(c, c[1:], strict=False))), default=0))


def test_dense_pairs_need_three(spark):
    lines = ["the mayor opened the bridge", "taxes are due in spring", "new schools were built", "zebra quartz jumps"]
    d = spark.createDataFrame([(1, lines, lines), (2, lines[:2], lines[:2]), (3, lines[:1], lines), (4, None, lines)], "k long, a array<string>, b array<string>")
    got = {(r.k, r.mk, r.sq) for r in align.dense(d, "k", vectors.trigram_vector).collect()}
    assert got == {(1, x, x) for x in lines}
