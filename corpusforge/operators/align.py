"""Length-based sentence alignment by dynamic programming, one document pair at a time.

A row holds both sides' sentences, so alignment is a narrow operation over Arrow batches. The program computes the costs of
a block of rows at once, fills one row at a time from all moves that come from earlier rows, and walks along the row for
moves that stay in it. Of equal costs the move from the earliest cell wins.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusforge.operators import vectors
from corpusforge.sources.storage import written

MEAN_RATIO, VARIANCE = 1.1, 6.8
#: Priors of moves, second and first generation.
PRIORS = {(1, 1): 0.89, (1, 0): 0.005, (0, 1): 0.005, (1, 2): 0.05, (2, 1): 0.05, (2, 2): 0.01}
PRIORS_EARLY = {(1, 1): 0.89, (1, 0): 0.005, (0, 1): 0.005, (1, 2): 0.04, (2, 1): 0.04, (2, 2): 0.02}

Cost = Callable[[tuple[int, int], np.ndarray, np.ndarray], list[np.ndarray]]


def penalty(a, b):
    """The squared log ratio of lengths; 100 where a side is empty."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.log(a / b / MEAN_RATIO) ** 2 / VARIANCE
    return np.where((a == 0) & (b == 0), 0.0, np.where((a == 0) | (b == 0), 100.0, p))


def distance(a, b):
    """The first generation's distance of two lengths."""
    a, b = np.asarray(a, float), np.asarray(b, float) / MEAN_RATIO
    mean = (a + b) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(mean > 0, np.abs(a - b) / np.sqrt(mean * VARIANCE) + math.log(2.0), 0.0)


def gale_church_cost(move, a, b):
    return [-math.log(PRIORS[move] + 1e-12) + penalty(a, b)]


def early_gale_church_cost(move, a, b):
    prior = -math.log(PRIORS_EARLY[move])
    return [prior] if 0 in move else [distance(a, b), prior]


def article_cost(move, a, b):
    with np.errstate(divide="ignore", invalid="ignore"):
        return [np.where(np.asarray(b) > 0, np.log(a / b / MEAN_RATIO) ** 2 / VARIANCE, np.where(np.asarray(a) > 0, np.inf, 0.0))]


def early_article_cost(move, a, b):
    # merged sentences are joined by a space
    return [np.log(np.maximum(a + (move[0] > 1), 1) / np.maximum(b + (move[1] > 1), 1)) ** 2]


METHODS: dict[str, tuple[list[tuple[int, int]], Cost]] = {
    "article": ([(1, 1), (1, 2), (2, 1)], article_cost), "gale_church": (list(PRIORS), gale_church_cost),
    "early_gale_church": (list(PRIORS_EARLY), early_gale_church_cost), "early_article": ([(1, 1), (1, 2), (2, 1)], early_article_cost),
}


#: Cells of which the costs are computed at once.
CELLS = 1 << 18


def path(a: list[int], b: list[int], method: str) -> list[tuple[int, int, int, int, float]]:
    """Steps (from i, to i, from j, to j, cost so far) through sentences of these lengths; none if the end isn't reachable.
    Costs are computed for blocks of rows; of the table only the moves and the last rows are held."""
    moves, cost = METHODS[method]
    moves = sorted(moves, key=lambda m: (-m[0], -m[1]))  # earliest cell first
    n, m = len(a), len(b)
    sa, sb = np.concatenate([[0], np.cumsum(a)]).astype(float), np.concatenate([[0], np.cumsum(b)]).astype(float)

    def parts(k: int, first: int, last: int) -> list[np.ndarray]:
        """The summands of a move's costs into rows first to last - 1, one array row each."""
        di, dj = moves[k]
        x, y = (sa[first:last] - sa[first - di : last - di])[:, None], (sb[dj:] - sb[: m + 1 - dj])[None, :]
        return [np.broadcast_to(p, (last - first, m + 1 - dj)) for p in cost((di, dj), *np.broadcast_arrays(x, y))]

    down = [k for k, (di, dj) in enumerate(moves) if di and m >= dj]
    along = moves.index((0, 1)) if (0, 1) in moves and m else None
    if along is not None:
        steps = cost((0, 1), 0.0, sb[1:] - sb[:-1])
        step = np.array(np.broadcast_to(sum(steps[1:], steps[0]), m))
    came, total, every = np.full((n + 1, m + 1), -1, np.int8), np.full((len(moves), m + 1), np.inf), np.arange(m + 1)
    rows, block = [np.full(m + 1, np.inf)] * 2, max(1, CELLS // (m + 1))
    for i in range(n + 1):
        row = np.full(m + 1, np.inf)
        if i == 0:
            row[0] = 0.0
        elif down:
            if i == 1 or (i - 1) % block == 0:
                begin = i
                costs = {k: parts(k, max(i, moves[k][0]), min(n + 1, i + block)) for k in down if max(i, moves[k][0]) < min(n + 1, i + block)}
            for k in down:
                di, dj = moves[k]
                if i >= di:
                    into, at = total[k, dj:], i - max(begin, di)
                    first, *others = costs[k]
                    np.add(rows[-di][: m + 1 - dj], first[at], out=into)
                    for p in others:
                        np.add(into, p[at], out=into)
            k = total.argmin(axis=0)
            row = total[k, every]
            came[i] = np.where(np.isfinite(row), k, -1)
        if along is not None and (row[:-1] + step < row[1:]).any():
            cells, ahead = row.tolist(), step.tolist()
            for j in range(m):
                if cells[j] + ahead[j] < cells[j + 1]:
                    cells[j + 1] = cells[j] + ahead[j]
                    came[i, j + 1] = along
            row = np.array(cells)
        rows = [rows[-1], row]
    out, i, j = [], n, m
    while (i or j) and came[i, j] >= 0:
        di, dj = moves[came[i, j]]
        out.append((i - di, i, j - dj, j))
        i, j = i - di, j - dj
    steps, so_far = [], 0.0
    for i0, i1, j0, j1 in out[::-1]:
        for p in cost((i1 - i0, j1 - j0), sa[i1] - sa[i0], sb[j1 : j1 + 1] - sb[j0 : j0 + 1]):
            so_far = so_far + float(np.ravel(p)[0])
        steps.append((i0, i1, j0, j1, so_far))
    return steps


#: Pairs that are handed on at once, and characters of them.
MOST_PAIRS, MOST_CHARS = 8_192, 2_000_000


def align(df: DataFrame, keys: list[str], method: str, a: str = "a", b: str = "b") -> DataFrame:
    """keys, mk, sq, mk_indices, sq_indices, move, cost: pairs with text on both sides; the cost so far, or for the early
    Gale-Church method the pair's own distance. Documents are read from a batch one by one, and their pairs handed on in slices."""
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = T.StructType.fromDDL(f"{kinds}, mk string, sq string, mk_indices array<int>, sq_indices array<int>, move string, cost double")
    arrow = to_arrow_schema(schema)

    def run(batches):
        out, full = [], 0
        for f in batches:
            columns = [f.column(f.schema.get_field_index(c)) for c in (*keys, a, b)]
            for r in range(f.num_rows):
                *key, x, y = (c[r].as_py() for c in columns)
                if not x or not y:
                    continue
                for i0, i1, j0, j1, cost in path([len(s) for s in x], [len(s) for s in y], method):
                    if i1 > i0 and j1 > j0:
                        own = float(distance(sum(map(len, x[i0:i1])), sum(map(len, y[j0:j1])))) if method == "early_gale_church" else cost
                        out.append((*key, " ".join(x[i0:i1]), " ".join(y[j0:j1]), list(range(i0, i1)), list(range(j0, j1)), f"{i1 - i0}-{j1 - j0}", own))
                        full += len(out[-1][-6]) + len(out[-1][-5])
                if full > MOST_CHARS or len(out) >= MOST_PAIRS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow)
                    out, full = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)], schema=arrow)

    return df.select(*keys, a, b).mapInArrow(run, schema)


def monotone_chain(pairs: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The heaviest subset in which the second index rises with the first; the first best end wins. A tree of prefix maxima
    over the second index gives each pair's best predecessor in logarithmic time."""
    pairs = sorted(pairs, key=lambda p: (p[0], p[1]))
    if not pairs:
        return []
    rank = {j: r for r, j in enumerate(sorted({p[1] for p in pairs}), 1)}
    tree: list[tuple[float, int]] = [(-math.inf, 0)] * (len(rank) + 1)  # best total and the negated place of its first pair
    total, came = [], []
    for k, (_, j, w) in enumerate(pairs):
        best, at = (-math.inf, 0), rank[j] - 1
        while at > 0:
            best, at = max(best, tree[at]), at & (at - 1)
        total.append(best[0] + w if best[0] > 0 else w)
        came.append(-best[1] if best[0] > 0 else -1)
        at = rank[j]
        while at <= len(rank):
            tree[at] = max(tree[at], (total[k], -k))
            at += at & -at
    k, out = int(np.argmax(total)), []
    while k >= 0:
        out.append(pairs[k])
        k = came[k]
    return out[::-1]


def chains(matches: DataFrame) -> DataFrame:
    """grp, i, j, sim: the heaviest rising chain of each group's matches."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        got = monotone_chain(list(zip(g.i, g.j, g.sim, strict=True)))
        return pd.DataFrame({"grp": [g.grp.iloc[0]] * len(got), "i": [x[0] for x in got], "j": [x[1] for x in got], "sim": [x[2] for x in got]})

    return matches.groupBy("grp").applyInPandas(run, f"grp {matches.schema['grp'].dataType.simpleString()}, i long, j long, sim double")


def dense(sides: DataFrame, key: str, embed: Callable[[Column], Column], least: float = 0.70, fewest: int = 3) -> DataFrame:
    """key, mk, sq, sim: sentences (arrays a and b) that are each other's nearest, in a rising chain, of documents with at
    least two sentences a side and ``fewest`` pairs. ``embed`` gives a text's vector (array<double>)."""
    s = sides.filter((F.size("a") >= 2) & (F.size("b") >= 2))
    part = lambda c, side: s.select(F.col(key).alias("grp"), F.lit(side).alias("side"), F.posexplode(c).alias("i", "body"))
    rows = written(part("a", "s").unionByName(part("b", "t")).select("grp", "side", F.col("i").cast("long").alias("i"), "body", embed(F.col("body")).alias("v")))
    chain = written(chains(vectors.mutual(vectors.best_matches(rows.select("grp", "side", "i", vectors.unit(F.col("v")).alias("v"))), least)))
    enough = chain.groupBy("grp").count().filter(F.col("count") >= fewest).select("grp")
    text = lambda side, i, name: rows.filter(F.col("side") == side).select("grp", F.col("i").alias(i), F.col("body").alias(name))
    return chain.join(enough, "grp", "left_semi").join(text("s", "i", "mk"), ["grp", "i"]).join(text("t", "j", "sq"), ["grp", "j"]).select(F.col("grp").alias(key), "mk", "sq", "sim")
