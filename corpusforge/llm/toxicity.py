"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

The kernel of two words sums, over all subsequences of three characters within a span of five, the product of their
weights (``DECAY`` to the power of the span), divided by the words' norms. So an insult with inserted characters, gaps
or another ending keeps most of its similarity. Landmarks are words of the sample whose subsequences tell toxic texts
from others and that aren't alike, and the clean words most like those as counter-examples. The kernel of a sentence with
a landmark is the greatest of its words' kernels, where only words count that are like a telling landmark, above
``FLOOR``; a sentence is described by these, mapped by the inverse root of the landmarks' kernel matrix. A linear machine with squared
hinge loss is trained on the sentences of labelled texts, in rounds: all sentences of clean texts are negative; of a toxic
text's, those that the machine of the round before finds positive, or its highest one. Sentences of a single landmark
with inserted characters, doubled letters and separators are positive examples too. A text's score is the logistic calibration of its
highest sentence. A sentence of more than ``SPAN`` words is read in parts of as many.

Training uses at most ``SAMPLE`` labelled texts of each class, those with the least hash of the id (a documented bound), and of these
in order at most ``SAMPLE_BYTES`` in all, a text that passes the bound by itself excepted;
scoring reads every word of every text. Similarities of distinct words are remembered, up to ``CACHE`` per worker; a
bound from the landmarks' greatest weights dismisses only words that no landmark can reach.

Null and empty texts have the score of a text without any similarity. Very long texts are slices of their own and read whole. Labels of
null and texts without label aren't learned from; of two labels of an id the toxic one holds. Without examples of both classes
the score is the toxic share of what there is (0.0 for nothing). Equal texts have equal scores. An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.llm.common import portions, stored

DECAY, FLOOR = 0.7, 0.4
PAIRS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))  # places of the second and third character after the first
LANDMARKS = 96
COUNTER = 48
FAMILIES = 16
PART = 0.6  # share of a rare word's subsequences that must tell
TOLD, MORE = 12.0, 6.0  # likelihood ratio and ratio of rates from which a subsequence tells toxic texts
SAMPLE = 1_500
SAMPLE_BYTES = 64_000_000
SPAN = 32
ROUNDS = 3
CACHE = 400_000
LONG = 64  # a longer word is read in overlapping windows of this length
WINDOW, STEP = 16, 4  # windows over every word longer than that, so that up to 13 letters stand in one whole
MANY = 16_384  # forms that are compared at once
ALPHABET = 64

SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
SPACED = re.compile(r"(?<!\S)(?:\w[\s.*_-]+){2,}\w(?!\w)")
APART = re.compile(r"[\W\d_]+")
EDGE = "\"'`.,;:!?()[]{}<>|*_-–—…«»“”„"


def codes(word: str) -> np.ndarray:
    """a-z as 1 to 26, other characters dealt over the rest of the alphabet."""
    return np.array([ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) * 31 % (ALPHABET - 27) for c in word], np.int64)


def features(word: str) -> dict[int, float]:
    """The weights of a word's subsequences."""
    c, out = codes(word).tolist(), Counter()
    for a, b in PAIRS:
        w = DECAY ** (b + 1)
        for i in range(len(c) - b):
            out[(c[i] * ALPHABET + c[i + a]) * ALPHABET + c[i + b]] += w
    return out


def norm(f: dict[int, float]) -> float:
    return math.sqrt(sum(x * x for x in f.values())) or 1.0


def kernel(a: str, b: str) -> float:
    x, y = features(a), features(b)
    return sum(w * y.get(f, 0.0) for f, w in x.items()) / (norm(x) * norm(y))


def whole_forms(token: str) -> list[str]:
    """A token without marks at its ends; where marks stand inside, also with letters only and split at them."""
    s = token.strip(EDGE)
    out = [s] if len(s) <= LONG else [s[i : i + LONG] for i in range(0, len(s) - LONG // 2, LONG // 2)]
    if not s.isalpha():
        letters = "".join(filter(str.isalpha, s))
        out += [letters] if len(letters) <= LONG else [letters[i : i + LONG] for i in range(0, len(letters) - LONG // 2, LONG // 2)]
        out += [w for part in APART.split(s) for w in ([part] if len(part) <= LONG else windows(part))]
    return [w for w in dict.fromkeys(out) if len(w) >= 3]


def windows(s: str) -> list[str]:
    """Overlapping parts of about twice an insult's length, to the very end."""
    return [s[i : i + WINDOW] for i in range(0, len(s) - WINDOW + STEP, STEP)] if len(s) > WINDOW else []


def forms(token: str) -> list[str]:
    """What a token is compared as: its whole forms, and windows over the token and over its letters."""
    s = token.strip(EDGE)
    letters = "" if s.isalpha() else "".join(filter(str.isalpha, s))
    return list(dict.fromkeys([*whole_forms(token), *windows(s), *windows(letters)])) if len(s) > WINDOW else whole_forms(token)


class Model:
    """Landmarks, map, weights and calibration; pickled to the workers without what it remembers."""

    def __init__(self, landmarks: list[str], telling: int, share: float):
        """``telling``: how many landmarks, from the first, stand for insults; the others are counter-examples."""
        self.landmarks, self.telling, self.share = landmarks, telling, share
        self.weights: np.ndarray | None = None
        self.bias, self.slope, self.shift, self.least = 0.0, 1.0, 0.0, -1.0
        self._prepare()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("reach", "at", "table", "known", "rows")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._prepare()

    def _prepare(self) -> None:
        """The landmarks' weights by subsequence, and each subsequence's greatest weight in a telling landmark."""
        parts = [(w, features(w)) for w in self.landmarks]
        every = sorted({k for _, f in parts for k in f})
        self.at = np.zeros(ALPHABET**3, np.int32)
        self.at[every] = np.arange(1, len(every) + 1)
        self.table = np.zeros((len(every) + 1, len(self.landmarks)), np.float32)
        for i, (_, f) in enumerate(parts):
            n = norm(f)
            for k, x in f.items():
                self.table[self.at[k], i] = x / n
        # families of telling landmarks, by the first that is like each
        family, heads = [], []
        for i, (w, f) in enumerate(parts[: self.telling]):
            like = [sum(x * parts[h][1].get(k, 0.0) for k, x in f.items()) / (norm(f) * norm(parts[h][1])) for h in heads]
            if not heads or (max(like) < 0.3 and len(heads) < FAMILIES):
                heads.append(i)
                family.append(len(heads) - 1)
            else:
                family.append(int(np.argmax(like)))
        self.reach = np.zeros((ALPHABET**3, max(1, len(heads))), np.float32)
        for g in range(len(heads)):
            self.reach[every, g] = self.table[1:, [i for i, x in enumerate(family) if x == g]].max(axis=1)
        self.known: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def similar(self, words: list[str]) -> np.ndarray:
        """The kernel of words of three characters or more with the landmarks."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        for k in range(0, len(words), 4096):
            offset, code, weight = coded(words[k : k + 4096])
            n = len(offset) - 1
            word = np.repeat(np.arange(n), np.diff(offset))
            key, where = np.unique(word * ALPHABET**3 + code, return_inverse=True)
            sums = np.bincount(where, weight)
            norms = np.sqrt(np.bincount(key // ALPHABET**3, sums**2, n))
            out[k : k + n] = np.add.reduceat(self.table[self.at[code]] * weight[:, None], offset[:-1], axis=0) / norms[:, None]
        return out

    def reachable(self, words: list[str]) -> np.ndarray:
        """Whether a landmark can be within the floor of each word: a bound on the kernel by the greatest weights."""
        size = np.array([len(w) for w in words])
        out = np.zeros(len(words), bool)
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            c = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, n)
            c = np.where((c >= 97) & (c <= 122), c - 96, 27 + c * 31 % (ALPHABET - 27))
            most, least = np.zeros((len(at), self.reach.shape[1]), np.float32), 0.0
            for a, b in PAIRS:
                if n > b:
                    w = DECAY ** (b + 1)
                    most += w * self.reach[(c[:, : n - b] * ALPHABET + c[:, a : n - b + a]) * ALPHABET + c[:, b:]].sum(axis=1)
                    least += (n - b) * w * w
            out[at] = most.max(axis=1) >= FLOOR * math.sqrt(least) * 0.999 if least else False
        return out

    def likenesses(self, tokens: list[str]) -> dict[int, np.ndarray]:
        """The similarities of the tokens that are like a telling landmark; of a token's forms the one most like one."""
        out: dict[int, np.ndarray] = {}
        for flat in itertools.batched(((i, w) for i, t in enumerate(tokens) for w in forms(t)), MANY):
            ok = self.reachable([w for _, w in flat])
            near = [x for x, y in zip(flat, ok, strict=True) if y]
            for (i, _), v in zip(near, self.similar([w for _, w in near]), strict=True):
                if (m := v[: self.telling].max()) > FLOOR and (i not in out or m > out[i][: self.telling].max()):
                    out[i] = v.copy()  # not a view of all of them
        return out

    def sentences(self, text: str) -> list[list[str]]:
        """The words of sentences, long ones in parts; spaced-out words stand alone, for marks inside may end sentences."""
        t = text.lower()
        out = [["".join(filter(str.isalnum, m))] for m in SPACED.findall(t)]
        for s in SENTENCE.split(t):
            w = s.split()
            out += [w[k : k + SPAN] for k in range(0, len(w), SPAN)]
        return out

    def see(self, texts: list[str]) -> list[np.ndarray]:
        """For every text the features of its sentences that have a word like a telling landmark."""
        split = [{*(t := x.lower()).split(), *["".join(filter(str.isalnum, m)) for m in SPACED.findall(t)]} for x in texts]
        everything = set().union(*split)
        new = everything.difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            self.rows.clear()
            new = everything
        new = sorted(new)
        self.known.update(dict.fromkeys(new, -1))
        for i, v in self.likenesses(new).items():
            self.known[new[i]] = len(self.rows)
            self.rows.append(v)
        get, out = self.known.__getitem__, []
        for text, words in zip(texts, split, strict=True):
            found = []
            if any(get(w) >= 0 for w in words):
                for s in self.sentences(text):
                    if at := [k for w in s if (k := get(w)) >= 0]:
                        found.append(self.rows[at[0]] if len(at) == 1 else np.max([self.rows[k] for k in at], axis=0))
            out.append(np.array(found, np.float32).reshape(-1, len(self.landmarks)))
        return out

    def decide(self, texts: list[str]) -> np.ndarray:
        """The highest sentence; the least value for texts without a word like a telling landmark."""
        return np.array([max(self.least, float((x @ self.weights).max()) + self.bias) if len(x) else self.least for x in self.see(texts)])

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.share)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.decide(texts) + self.shift, -30, 30)))


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 1.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Squared hinge loss by Newton steps over the rows within the margin; the last weight is the bias."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-3
    before = None
    for _ in range(steps):
        near = y * (z @ w) < 1
        if before is not None and (near == before).all():
            break
        a = z[near] * (c * weight[near])[:, None]
        w, before = np.linalg.solve(a.T @ z[near] + ridge, a.T @ y[near]), near
    return w[:-1], float(w[-1])


def platt(f: np.ndarray, toxic: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of a logistic fit with smoothed targets."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z, w = np.stack([f, np.ones_like(f)], axis=1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + 1e-6 * np.eye(2), z.T @ (target - p) - 1e-6 * w)
        w += np.clip(step, -5, 5)
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, codes and weights of the subsequences of many words."""
    size = np.array([len(w) for w in words])
    count = sum(np.maximum(0, size - b) for _, b in PAIRS)
    offset = np.concatenate([[0], np.cumsum(count)])
    code, weight = np.zeros(offset[-1], np.int32), np.zeros(offset[-1], np.float32)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        c = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, n)
        c = np.where((c >= 97) & (c <= 122), c - 96, 27 + c * 31 % (ALPHABET - 27))
        k = offset[at]
        for a, b in PAIRS:
            for i in range(n - b):
                code[k], weight[k] = (c[:, i] * ALPHABET + c[:, i + a]) * ALPHABET + c[:, i + b], DECAY ** (b + 1)
                k = k + 1
    return offset, code, weight


def gains(with1: np.ndarray, with0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Log ratio of rates of what is told by a likelihood ratio to be more frequent in toxic texts; 0 for the rest."""
    rate1, rate0, rate = (with1 + 0.5) / (n1 + 1), (with0 + 0.5) / (n0 + 1), (with1 + with0 + 1) / (n1 + n0 + 2)
    gain = 2 * (with1 * np.log(rate1 / rate) + with0 * np.log(rate0 / rate))
    return np.where((gain >= TOLD) & (rate1 >= MORE * rate0), np.log(rate1 / rate0), 0.0)


def landmarks_of(words: list[set[str]], toxic: np.ndarray) -> tuple[list[str], int]:
    """Telling words: first those that occur in toxic texts rather than in others, then those whose subsequences do; and clean words
    that are most like them, as counter-examples. No two are alike."""
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    names = sorted({w for x in words for w in x if w.isalpha()})
    if not names:
        return [], 0
    index = {w: i for i, w in enumerate(names)}
    offset, code, _ = coded(names)
    seen, found = np.zeros((2, ALPHABET**3), np.int32), np.zeros((2, len(names)), np.int32)
    for x, label in zip(words, toxic.tolist(), strict=True):
        at = np.array([index[w] for w in x if w in index], np.int64)
        found[int(label)][at] += 1
        mark = np.zeros(ALPHABET**3, bool)
        if len(at):
            mark[np.concatenate([code[offset[i] : offset[i + 1]] for i in at.tolist()])] = True
        seen[int(label)] += mark
    by_word, by_part = gains(found[1], found[0], n1, n0), gains(seen[1], seen[0], n1, n0)
    del code
    share, value = np.zeros(len(names)), np.zeros(len(names))
    for k in range(0, len(names), 20_000):
        offset, code, weight = coded(names[k : k + 20_000])
        part, total = by_part[code], np.add.reduceat(weight, offset[:-1])
        share[k : k + 20_000] = np.add.reduceat(weight * (part > 0), offset[:-1]) / total
        value[k : k + 20_000] = np.add.reduceat(weight * part, offset[:-1]) / total
    loose = (share >= PART) & (found[0] == 0) & (found[1] > 0)
    rank = np.where(by_word > 0, 1e6 + found[1] * by_word, np.where(loose, found[1] * value, 0.0))
    order = np.lexsort((np.arange(len(names)), -rank))[: 10 * LANDMARKS]
    chosen: list[tuple[str, dict[int, float], float]] = []

    def add(w: str, most: int) -> None:
        f = features(w)
        n = norm(f)
        if len(chosen) < most and all(sum(v * g.get(k, 0.0) for k, v in f.items()) < 0.85 * n * o for _, g, o in chosen):
            chosen.append((w, f, n))

    for i in order.tolist():
        if rank[i] > 0:
            add(names[i], LANDMARKS)
    telling = len(chosen)
    if chosen:
        m = Model([w for w, _, _ in chosen], telling, 0.0)
        clean = np.flatnonzero((found[0] >= 1) & (by_word == 0) & ~loose)
        clean = clean[m.reachable([names[i] for i in clean])] if len(clean) else clean
        like = m.similar([names[i] for i in clean]).max(axis=1) if len(clean) else np.zeros(0)
        order = np.lexsort((clean, -like * np.log(1 + found[0][clean])))
        for i in clean[order[: 4 * COUNTER]].tolist():
            add(names[i], telling + COUNTER)
    return [w for w, _, _ in chosen], telling


def variants(word: str) -> list[str]:
    """A word with an inserted character, a doubled letter and separators."""
    h = len(word) // 2
    return [word[:h] + "x" + word[h:], word[:2] + word[1:], word[:h] + "." + word[h:], "*".join(word), " ".join(word)]


def fit(texts: list[str], toxic: list[bool]) -> Model:
    """A model of labelled texts, each distinct text once."""
    once = dict(zip(texts, toxic, strict=True))
    texts, toxic = list(once), list(once.values())
    y = np.array(toxic, bool)
    n1, n0 = int(y.sum()), int((~y).sum())
    if not n1 or not n0:
        return Model([], 0, n1 / len(y) if len(y) else 0.0)
    words = [{w for token in t.lower().split() for w in whole_forms(token)} for t in texts]
    m = Model(*landmarks_of(words, y), n1 / len(y))
    if not m.telling:
        return m
    k = m.similar(m.landmarks).astype(float)
    val, vec = np.linalg.eigh((k + k.T) / 2)
    root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 0.05))) @ vec.T
    # the sample's telling words as they are written to be overlooked, where no clean text has them
    bent = {v for w in m.landmarks[: m.telling] for v in variants(w)}
    bent -= set().union(*(bent & x for x, label in zip(words, y.tolist(), strict=True) if not label))
    del words
    seen = [x for part in itertools.batched(texts, 64) for x in m.see(part)]
    bent = m.see(sorted(bent))
    x = np.concatenate([*seen, *bent]).astype(float) @ root
    of = np.repeat(np.arange(len(seen)), [len(g) for g in seen])
    toxic_row = np.concatenate([y[of], np.ones(len(x) - len(of), bool)])
    own = np.arange(len(x)) < len(of)
    if not toxic_row.any():
        return m
    positive = toxic_row.copy()
    for _ in range(ROUNDS):
        at = np.flatnonzero(positive | ~toxic_row)
        t = np.where(positive[at], 1.0, -1.0)
        weight = np.ones(len(at))
        for side in (t > 0, t < 0):
            weight[side] *= 0.5 * len(t) / max(1, side.sum())
        w, b = svm(x[at], t, weight, 10.0)
        f = x @ w + b
        best = np.full(len(seen), -np.inf)
        np.maximum.at(best, of, f[: len(of)])
        positive = toxic_row & ((f > 0) | ~own)
        positive[: len(of)] |= toxic_row[: len(of)] & (f[: len(of)] == best[of])
    m.weights, m.bias = root @ w, b
    m.least = min(-1.0, b)
    m.slope, m.shift = platt(np.concatenate([m.decide(part) for part in itertools.batched(texts, 64)]), y)
    m.known.clear()
    m.rows.clear()
    return m


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, text: str = "text", sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` labelled texts of each class; ``learn`` says which labels may be used."""
    ids = labels.filter("toxic in (0, 1) and doc_id is not null")
    if learn is not None:
        ids = ids.filter(learn)
    ids = ids.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), "doc_id")
    some = ids.filter("toxic = 1").orderBy(*order).limit(sample).unionByName(ids.filter("toxic = 0").orderBy(*order).limit(sample))
    # at most 2 * sample ids of 12 bytes; of rows with one id the least text
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    rows = stored(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")))
    ids, full = [], 0
    for r in rows.select("doc_id", F.octet_length("text").alias("n")).orderBy(*order).collect():
        full += r.n
        if ids and full > SAMPLE_BYTES:
            break
        ids.append(r.doc_id)
    if not ids:
        return fit([], [])
    last = rows.filter(F.struct(*order) <= F.struct(F.xxhash64(F.lit(ids[-1]).cast(rows.schema["doc_id"].dataType)), F.lit(ids[-1]).cast(rows.schema["doc_id"].dataType)))
    got = last.orderBy(*order).collect()
    return fit([r.text for r in got], [r.toxic == 1 for r in got])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the double ``score``."""
    keep = [c for c in docs.columns if c not in ("score", "_toxic_text")]
    given = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_toxic_text"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for whole in batches:
            for b in portions(whole, whole.num_columns - 1):
                s = m.score(b.column(b.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.float64())], names=[*keep, "score"])

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField("score", T.DoubleType())]))
