"""Registered queries with the reference's parameters, and rows that a bound would leave undecided."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import dedup
from corpusforge.plans import pair_queries
from corpusforge.plans import views as v


def documents(spark, folder, source, target):
    """A folder with documents in which the n-th source text stands beside the n-th target text."""
    rows = [(i, x, lang, "web", len(x)) for i, (x, lang) in enumerate([(x, "en") for x in source] + [(x, "fr") for x in target])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def signature(text):
    text = text.strip().lower()
    hashes = {int(hashlib.md5(text[i : i + 3].encode()).hexdigest()[:8], 16) % dedup.PRIME for i in range(len(text) - 2)}
    return [min(((h * a + b) % dedup.PRIME for h in hashes), default=dedup.PRIME) for a, b in dedup.permutations(128)]


def band_keys(text):
    s = signature(text)
    return {(k, ",".join(map(str, s[k * 42 : k * 42 + 42]))) for k in range(3)}


@pytest.fixture(scope="module")
def related(spark, tmp_path_factory):
    """Sentences that differ by a word or two: related, hardly any near copies."""
    towns = "Ohrid Skopje Tirana Bitola Prizren Durres Vlora Struga Tetovo Kumanovo".split()
    line = "The municipal council of {} adopted the budget for the coming year and opened the new school near the {} bridge."
    source = [" ".join(line.format(a, b) for b in towns[:5]) for a in towns]
    target = [" ".join(f"Le conseil municipal de {a} a vote le budget de la ville et ouvert une ecole pres du pont {b}." for b in towns[5:]) for a in towns]
    return documents(spark, tmp_path_factory.mktemp("related"), source, target)


def test_signatures_of_128_permutations(spark, related):
    want = {(r.pair_id, r.idx): hashlib.md5(",".join(map(str, signature(r.mk))).encode()).hexdigest() for r in v.sent_pairs(spark, related).collect()}
    assert len(want) > 20 and {(r.pair_id, r.idx): r.signature for r in pair_queries.dedup_signature(spark, related).collect()} == want


@pytest.mark.parametrize("early", [False, True])
def test_related_pairs_stay(spark, related, early):
    rows = sorted(pair_queries.doubled(spark, related).collect(), key=lambda r: r.ord)
    taken, want = set(), []
    for r in rows:
        texts = [f"{r.mk} ||| {r.sq}"] if early else [r.mk, r.sq]
        keys = {(side, *k) for side, x in enumerate(texts) for k in band_keys(x)}
        if taken.isdisjoint(keys):
            taken |= keys
            want.append(r.ord)
    got = (pair_queries.dedup_greedy_early if early else pair_queries.dedup_greedy)(spark, related)
    assert sorted(r.ord for r in got.collect()) == want and len(want) < len(rows)


def test_bands_of_42_rows(spark, related):
    count = {}
    for r in v.sent_pairs(spark, related).collect():
        for k, x in band_keys(r.mk):
            key = (k, hashlib.md5(x.encode()).hexdigest())
            count[key] = count.get(key, 0) + 1
    assert {(r.band, r.key): r.n for r in pair_queries.dedup_buckets(spark, related).collect()} == {k: n for k, n in count.items() if n > 1}


def chain(spark, n):
    """Rows each of which shares a bucket with its neighbours only."""
    return spark.range(n).select(F.col("id").alias("ord"), F.lit("mk").alias("side"), F.posexplode(F.array(F.floor(F.col("id") / 2), F.floor((F.col("id") + 1) / 2))).alias("band", "key")).withColumn("key", F.col("key").cast("string"))


@pytest.mark.parametrize("n, few", [(400, dedup.FEW), (400, 380), (9, 0)])
def test_chains_are_decided_to_the_end(spark, monkeypatch, n, few):
    monkeypatch.setattr(dedup, "buckets", lambda *_: chain(spark, n))
    df = spark.range(n).select(F.col("id").alias("ord"), F.lit("").alias("mk"))
    assert sorted(r.ord for r in dedup.greedy(df, ["mk"], "ord", few=few).collect()) == list(range(0, n, 2))


def test_prefix_of_120_characters(spark, tmp_path):
    opening = "In accordance with the decision of the assembly of the republic, "
    source = " ".join(f"{opening}article {i} enters into force on the first day." for i in range(3)) + " " + " ".join(f"{'x' * 120} tail {i}." for i in range(2))
    folder = documents(spark, tmp_path, [source], [source])
    assert {r.idx for r in pair_queries.dedup_prefix(spark, folder).collect()} == {0, 1, 2, 3}
