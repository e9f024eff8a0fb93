"""Scores of pairs in tiers, blending, and sentence-level chrF."""

from __future__ import annotations

from collections import Counter
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Weights and thresholds of tiered validation.
STRUCTURAL = {"labse": 0.5, "laser3": 0.3, "length": 0.2}
OTHERS = {"labse": 0.25, "laser3": 0.20, "comet": 0.25, "bt": 0.20, "length": 0.10}
HARD = {"labse": 0.45, "laser3": 0.45, "length": 0.30}
COMET, BLENDED, UNSURE = 0.50, 0.40, 0.75


def blend_structural(scores: dict[str, Column]) -> Column:
    """Weights of the signals that are there, scaled to 1."""
    w = {k: STRUCTURAL[k] for k in STRUCTURAL if k in scores}
    return sum((scores[k] * x for k, x in list(w.items())[1:]), scores[next(iter(w))] * next(iter(w.values()))) / sum(w.values())


def blend_others(scores: dict[str, Column]) -> Column:
    return sum((scores[k] * x for k, x in list(OTHERS.items())[1:]), scores["labse"] * OTHERS["labse"])


def validated(df: DataFrame, available: tuple[str, ...] = ("labse", "laser3"), comet: bool = True) -> DataFrame:
    """``df`` (labse, laser3, comet, bt, length, is_structural) with tier, blended and rejection_reason ('' : accepted)."""
    s = {k: F.col(k) for k in ("labse", "laser3", "comet", "bt", "length")}
    hard = F.coalesce(*[F.when(s[k] < HARD[k], f"{k}_low") for k in ("labse", "laser3") if k in available], F.when(s["length"] < HARD["length"], "length_low"), F.lit(""))
    open_ = hard == ""
    second = open_ & ~F.col("is_structural") & F.lit(comet)
    failed = second & (s["comet"] < COMET)
    third = second & ~failed & (s["labse"] > UNSURE) & (s["comet"] > 0) & (s["comet"] < UNSURE)
    have = {k: s[k] for k in (*available, "length")}
    bt = F.when(third, s["bt"]).otherwise(F.lit(0.0))
    blended = F.when(F.col("is_structural"), blend_structural(have)).otherwise(blend_others({**s, "bt": bt, "comet": F.when(second, s["comet"]).otherwise(F.lit(0.0))}))
    rejected = F.when(~open_, hard).when(failed, "comet_low").when(blended < BLENDED, "low_blended").otherwise("")
    return df.withColumns({
        "tier": F.when(third, 3).when(second, 2).otherwise(1), "blended": F.when(~open_ | failed, 0.0).otherwise(blended), "rejection_reason": rejected,
    })


def mean_of(*sims: Column, least: float = 0.70) -> tuple[Column, Column]:
    """The mean of the similarities that are there, and whether it passes; a pair without any passes."""
    n = sum((s.isNotNull().cast("int") for s in sims[1:]), sims[0].isNotNull().cast("int"))
    mean = sum((F.coalesce(s, F.lit(0.0)) for s in sims[1:]), F.coalesce(sims[0], F.lit(0.0))) / F.greatest(n, F.lit(1))
    return mean, F.when(n == 0, F.lit(True)).otherwise(mean >= least)


def chrf(hypothesis: str, reference: str, chars: int = 6, words: int = 2, beta: float = 2.0) -> float:
    """chrF++ of a sentence, 0 to 1: the mean F-score over character and word n-gram orders that both sides have."""

    def split_marks(s: str) -> list[str]:
        out = []
        for w in s.split():
            if len(w) > 1 and not w[-1].isalnum():
                out += [w[:-1], w[-1]]
            elif len(w) > 1 and not w[0].isalnum():
                out += [w[0], w[1:]]
            else:
                out.append(w)
        return [(w,) for w in out]

    total, orders = 0.0, 0
    for units, most in ((lambda s: "".join(s.split()), chars), (split_marks, words)):
        h, r = units(hypothesis), units(reference)
        grams = [h, r]
        for n in range(1, most + 1):
            # n-grams of one size more: each with the unit behind it
            grams = [list(map(add, g, x[n - 1 :])) if n > 1 else list(x) for g, x in zip(grams, (h, r), strict=True)]
            na, nb = len(grams[0]), len(grams[1])
            if not na or not nb:
                continue
            orders += 1
            a, b = Counter(grams[0]), Counter(grams[1])
            hit = sum(min(a[g], b[g]) for g in a.keys() & b.keys())
            p, q = hit / na, hit / nb
            total += (1 + beta**2) * p * q / (beta**2 * p + q) if hit else 0.0
    return total / orders if orders else 0.0


@F.pandas_udf(T.DoubleType())
def chrf_score(h: pd.Series, r: pd.Series) -> pd.Series:
    return pd.Series([chrf(a or "", b or "") for a, b in zip(h, r, strict=True)])


def harmonic(a: Column, b: Column) -> Column:
    return F.when(a + b > 0, 2 * a * b / (a + b)).otherwise(0.0)
