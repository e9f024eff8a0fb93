"""The hierarchical Pitman-Yor model against brute force."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import pitmanyor
from corpusforge.llm.queries import op1_pitmanyor
from tests.llm.test_llm import SCHEMA, TEXTS, words


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, "x", 1, "y", 2, 3) for i, t, s in TEXTS], SCHEMA)


@pytest.fixture()
def many_buckets(monkeypatch):
    monkeypatch.setattr(pitmanyor, "BLOCK", 2_000)


def base_of(train, w):
    n, v = sum(train.values()), len(train)
    return sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)


def checked(rows, held):
    """Counts and base score against brute force."""
    train = Counter(w for t, h in zip((t for _, t, _ in TEXTS), held, strict=True) if not h for w in [*words(t), "\n"])
    want = Counter()
    for (i, t, _), h in zip(TEXTS, held, strict=True):
        w = [*words(t), "\n"]
        want[i, h, len(w), sum(x in train for x in w), sum(train.values()), round(base_of(train, w), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(r.score <= 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in rows)


@pytest.mark.parametrize("block", [2_000, 6_000_000])
def test_counts_and_base(docs, monkeypatch, block):
    monkeypatch.setattr(pitmanyor, "BLOCK", block)
    got = pitmanyor.score(docs, F.col("doc_id") == 1).collect()
    checked(got, [i == 1 for i, _, _ in TEXTS])
    again = pitmanyor.score(docs, F.col("doc_id") == 1).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_nothing_to_learn_from(docs):
    checked(pitmanyor.score(docs, F.lit(True)).collect(), [True] * len(TEXTS))
    assert pitmanyor.score(docs.limit(0), F.lit(False)).count() == 0


def test_query(spark, tmp_path):
    import zlib

    spark.createDataFrame([(i, "a b c " * (i + 1)) for i in range(30)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op1_pitmanyor(spark, str(tmp_path)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) and r.n_tokens == 3 * (r.doc_id + 1) + 1 for r in got) and len(got) == 30


def test_bigrams_of_the_model(spark, many_buckets):
    """What follows a context is likelier after it, and an unseen context backs off to the word alone."""
    learned = [(i, "x a z y b z") for i in range(40)]
    asked = [(1000, "x a z"), (1001, "x b z"), (1002, "q a z"), (1003, "q b z")]
    rows = spark.createDataFrame(learned + asked, "doc_id long, text string")
    got = {r.doc_id: r.score for r in pitmanyor.score(rows, F.col("doc_id") >= 1000).collect()}
    assert got[1000] > got[1001] + 0.5 and abs(got[1002] - got[1003]) < 0.5


def test_predictions_sum_to_one():
    m = pitmanyor.Sweep({"d2": 0.6, "d1": 0.4, "theta2": 3.0, "theta1": 10.0, "c1": 60.0, "t1": 14.0}, 9)
    c1, t1 = np.array([20, 15, 9, 6, 4, 3, 1, 1, 1, 0]), np.array([3, 2, 2, 2, 1, 1, 1, 1, 1, 0])
    shared = m.shared(c1, t1)
    c, t = np.array([50, 7, 3, 0, 0, 1, 0, 0, 0, 0]), np.array([4, 2, 1, 0, 0, 1, 0, 0, 0, 0])
    assert shared.sum() == pytest.approx(1) and m.predict(c, t, c.sum(), t.sum(), shared).sum() == pytest.approx(1)


def seatings(n, d):
    """Weights of all seatings of n customers by number of tables, one customer after the other."""
    at = Counter({(1,): 1.0})
    for _ in range(n - 1):
        new = Counter()
        for s, w in at.items():
            new[(*s, 1)] += w
            for k in range(len(s)):
                new[(*s[:k], s[k] + 1, *s[k + 1 :])] += w * (s[k] - d)
        at = new
    out = np.zeros(n + 1)
    for s, w in at.items():
        out[len(s)] += w
    return out


@pytest.mark.parametrize("d", [0.1, 0.5, 0.9])
def test_posterior_of_a_restaurant(d):
    """Draws against the posterior by enumeration of all seatings."""
    n, w = 6, 1.7
    want = seatings(n, d)
    assert np.allclose(np.exp(pitmanyor.stirling(d, 8)[n, : n + 1]), want)
    p = want * w ** np.arange(n + 1)
    got = np.bincount(pitmanyor.draw(np.full(40_000, n), np.full(40_000, w), d, np.random.default_rng(1)), minlength=n + 1) / 40_000
    assert abs(got - p / p.sum()).max() < 0.01


@pytest.mark.parametrize("d", [0.3, 0.6, 0.9])
@pytest.mark.parametrize("w", [0.01, 1.0, 20.0, 300.0, 3000.0])
def test_large_dishes(d, w):
    """The chain beyond ``EXACT`` customers against the exact posterior at 4,096."""
    n = 4096
    p = pitmanyor.stirling(d, n)[n, 1:] + np.arange(1, n + 1) * math.log(w)
    p = np.exp(p - p.max())
    want = (p * np.arange(1, n + 1)).sum() / p.sum()
    got = pitmanyor.draw(np.full(2000, n), np.full(2000, w), d, np.random.default_rng(1))
    assert got.mean() == pytest.approx(want, rel=0.02) and got.max() <= n
    assert pitmanyor.draw(np.array([10**9]), np.array([w]), d, np.random.default_rng(1))[0] > 0


def test_long_text(spark):
    text = "w" * 3_000_000 + " a b" * 500_000
    r = pitmanyor.score(spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string"), F.col("doc_id") == 2).orderBy("doc_id").collect()
    assert [x.n_tokens for x in r] == [1_000_002, 3] and r[1].n_known == 3
