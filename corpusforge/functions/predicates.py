"""Filters that say why: each gives the first failing rule's reason, or an empty text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import text as t

#: Words that show the target language.
TARGET_WORDS = ("Neni", "LIGJ", "ligj", "Maqedonisë", "Veriut", "denarë", "Gazeta")


def first_reason(*rules: tuple[Column, Column | str]) -> Column:
    return F.coalesce(*[F.when(rule, reason if isinstance(reason, Column) else F.lit(reason)) for rule, reason in rules], F.lit(""))


def has_target_signal(c: Column, words: tuple[str, ...] = TARGET_WORDS, least_latin: float = 0.20) -> Column:
    found = t.has_albanian_markers(c)
    for w in words:
        found = found | F.contains(c, F.lit(w))
    return F.coalesce(found | (t.latin_ratio(c) > least_latin), F.lit(False))


def gatekeeper(sizes: DataFrame, pages: DataFrame, key: str = "doc_id", least_kb: int = 50, least_chars: int = 20) -> DataFrame:
    """key, should_process, reason, detail: size of the file (``size`` in bytes), pages, text layer, target language, in this
    order. A document passes if any page (``body``) shows the target language; one aggregation sees all pages at once."""
    g = pages.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.length(t.strip(F.col("body")))).alias("chars"), F.bool_or(has_target_signal(F.col("body"))).alias("signal"))
    d = sizes.select(key, "size").join(g, key, "left")
    kb, n, chars = F.col("size") / 1024, F.coalesce("n", F.lit(0)), F.coalesce("chars", F.lit(0))
    reason = first_reason((F.col("size").isNull() | (n == 0) & (kb >= least_kb), "corrupt_or_unreadable"), (kb < least_kb, "file_too_small"), (chars < least_chars, "scanned_no_text_layer"), (~F.col("signal"), "no_albanian_detected"))
    pages_of = F.concat(n.cast("string"), F.lit(" pages"))
    said = {"file_too_small": F.concat(F.bround(kb).cast("long").cast("string"), F.lit(f" KB < {least_kb} KB")), "corrupt_or_unreadable": pages_of, "scanned_no_text_layer": F.concat(F.lit("Only "), chars.cast("string"), F.lit(" chars across "), pages_of), "no_albanian_detected": F.concat(F.lit("No Albanian signals in "), pages_of)}
    d = d.withColumn("reason", F.when(reason == "", "none").otherwise(reason))
    detail = F.coalesce(*[F.when(F.col("reason") == k, v) for k, v in said.items()], F.lit(""))
    return d.select(key, (F.col("reason") == "none").alias("should_process"), "reason", detail.alias("detail"))


def confident(c: Column, least: float = 0.25) -> Column:
    """At least the least confidence; a bound of zero or less lets all pass, unknown ones too."""
    return F.lit(True) if least <= 0 else F.coalesce(c >= least, F.lit(False))


def pair_reason(a: Column, b: Column, source_part: str = t.CYRILLIC, target_part: str = "A-Za-z", lo: int = 5, hi: int = 200) -> Column:
    """The pair filter: words per side, ratio of word counts, digits, scripts."""
    x, y = t.word_count(a), t.word_count(b)
    ratio = x / F.greatest(y, F.lit(1))
    da, db = t.digit_fraction(a), t.digit_fraction(b)
    ra, rb = t.script_ratio(a, source_part), t.script_ratio(b, target_part)
    said = lambda name, v: F.concat(F.lit(f"{name}_"), F.format_string("%.2f", v))
    return first_reason(
        (x < lo, F.concat(F.lit("mk_too_short_"), x.cast("string"))), (y < lo, F.concat(F.lit("sq_too_short_"), y.cast("string"))),
        (x > hi, F.concat(F.lit("mk_too_long_"), x.cast("string"))), (y > hi, F.concat(F.lit("sq_too_long_"), y.cast("string"))),
        ((ratio < 0.4) | (ratio > 2.5), said("ratio", ratio)), (da > 0.30, said("mk_digits", da)), (db > 0.30, said("sq_digits", db)),
        ((F.length(a) > 20) & (ra < 0.5), said("mk_script", ra)), ((F.length(b) > 20) & (rb < 0.5), said("sq_script", rb)),
    )


def early_pair_reason(a: Column, b: Column) -> Column:
    """The first generation's pair filter without its stateful duplicate test."""
    x, y = t.word_count(a), t.word_count(b)
    ratio = x / y
    return first_reason(
        ((t.strip(a) == "") | (t.strip(b) == ""), "empty"), ((x < 5) | (y < 5), "too_short"), ((x > 200) | (y > 200), "too_long"), ((ratio < 0.4) | (ratio > 2.5), "ratio"),
        ((t.number_word_fraction(a, "[0-9.,]+") > 0.3) | (t.number_word_fraction(b, "[0-9.,]+") > 0.3), "numbers"), (t.upper_run(a) | t.upper_run(b), "uppercase"),
    )


def flags(a: Column, b: Column, confidence: Column, repeated: Column, source_part: str = t.CYRILLIC, target_part: str = "A-Za-zëçËÇ") -> Column:
    """The flag cascade of the cleaning report; a null confidence passes."""
    x, y = t.word_count(a), t.word_count(b)
    ratio = x / y
    return first_reason(
        (confidence < 0.6, "low_confidence"), ((x < 3) | (y < 3), "too_short"), ((x > 250) | (y > 250), "too_long"), ((ratio < 0.3) | (ratio > 3), "bad_ratio"),
        (t.script_ratio(a, source_part) < 0.5, "mk_not_cyrillic"), (t.script_ratio(b, target_part) < 0.5, "sq_not_latin"), (a.rlike("[A-F0-9]{32}") | b.rlike("[A-F0-9]{32}"), "hex_hash"),
        ((t.number_word_fraction(a) > 0.5) | (t.number_word_fraction(b) > 0.5), "mostly_numbers"), (repeated, "duplicate"),
    )
