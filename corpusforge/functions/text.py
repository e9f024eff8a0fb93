"""Text functions: Column expressions that stay in the JVM, but for Unicode normalisation, which Spark lacks.

Every function keeps null: a null text gives a null result unless it says otherwise. ``\\w`` and ``\\s`` are Unicode.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Line and word patterns of gazette pages.
HEADER_FOOTER = r"(СЛУЖБЕН\s*ВЕСНИК|GAZETTE\s*ZYRTARE|Стр\.\s*\d+\s*-\s*Бр\.\s*\d+|Faqe\s*\d+)"
MONTHS_MK = "јануари|февруари|март|април|мај|јуни|јули|август|септември|октомври|ноември|декември"
MONTHS_SQ = "janar|shkurt|mars|prill|maj|qershor|korrik|gusht|shtator|tetor|nëntor|dhjetor"
DATE_HEADER = rf"\d{{1,2}}\s*({MONTHS_MK}|{MONTHS_SQ})\s*\d{{4}}"
PAGE_NUMBER = r"^\s*\d{1,4}\s*$"
LONG_LINE = 150
BUILDER_NOISE = (
    r"СЛУЖБЕН\s+ВЕСНИК\s+НА", r"РЕПУБЛИКА\s+(СЕВЕРНА\s+)?МАКЕДОНИЈА", r"Gazeta\s+Zyrtare", r"Gaceta\s+Zyrtare", r"^Стр\.\s*\d+\s*-\s*Бр\.\s*\d+", r"^Бр\.\s*\d+\s*-\s*Стр\.\s*\d+",
    rf"^\d{{1,2}}\s+({MONTHS_MK})\s+\d{{4}}", rf"^\d{{1,2}}\s+({MONTHS_SQ})\s+\d{{4}}", r"^www\.slvesnik\.com\.mk", r"^contact@slvesnik\.com\.mk", r"^\d{1,4}$",
)
CLEAN_MK = (r"(?i:Службен\s+весник\s+на\s+Р[СC]?М?.*)", r"(?i:Службен\s+весник\s+на\s+Република\s+(Северна\s+)?Македонија.*)", r"бр\.\s*\d+.*", r"стр\.\s*\d+.*", r"\d+\s*", r"[-–—]+\s*\d*\s*[-–—]*")
CLEAN_SQ = (r"Gazeta\s+Zyrtare\s+e\s+R[SM]?.*", r"Gazeta\s+Zyrtare\s+nr\.?\s*\d*.*", r"Gaceta\s+Zyrtare.*", r"nr\.\s*\d+.*", r"fq\.\s*\d+.*", r"\d+\s*", r"[-–—]+\s*\d*\s*[-–—]*")
ARTICLE_MK, ARTICLE_SQ = r"Член\s+(\d+)", r"Neni\s+(\d+)"
ITEM = r"(?m)^\s*(\d{3,4})\.\s*$"

CYRILLIC = r"\x{0400}-\x{04FF}"
DIGITS = r"\p{Nd}²³¹⁰-⁹₀-₉"


def bound(c: Column, f) -> Column:
    """``f`` of the value of ``c``, which is computed once even where ``f`` uses it inside a lambda."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends. Only texts that have some there are searched through."""
    at_end = lambda x: F.concat(F.substring(x, 1, 1), F.substring(x, -1, 1)).rlike(r"(?U)\s")
    return bound(c, lambda x: F.when(at_end(x), F.regexp_replace(x, r"(?U)^\s++|(?<!\s)\s++$", "")).otherwise(x))


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def kept(c: Column, cls: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(F.regexp_replace(c, f"[^{cls}]+", ""))


def script_ratio(c: Column, part: str, whole: str = r"\p{L}") -> Column:
    """Characters of ``part`` to those of ``whole``; 0.0 where there are none of these."""
    n = kept(c, whole)
    return F.when(n > 0, kept(c, part) / n).otherwise(F.when(c.isNotNull(), F.lit(0.0)))


#: The white space of (?U)\\s.
SPACE = r"\x09-\x0D\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
TABLES: dict[tuple[str, ...], np.ndarray] = {}


def class_table(classes: tuple[str, ...]) -> np.ndarray:
    """For every code point the bits of the classes (as inside brackets of a pattern) that hold it."""
    if classes not in TABLES:
        kinds = np.array([unicodedata.category(chr(i)) for i in range(0x110000)])
        table = np.zeros(0x110000, np.uint32)
        for bit, cls in enumerate(classes):
            single = r"\\x\{([0-9A-Fa-f]+)\}|\\x([0-9A-Fa-f]{2})|([^\\])"
            for m in re.finditer(rf"\\p\{{(\w+)\}}|(?:{single})(?:-(?:{single}))?", cls):
                kind, *ends = m.groups()
                if kind:
                    table[np.char.startswith(kinds, kind)] |= 1 << bit
                else:
                    code = [int(h or x, 16) if h or x else ord(c) for h, x, c in (ends[:3], ends[3:]) if h or x or c]
                    table[code[0] : code[-1] + 1] |= 1 << bit
        TABLES[classes] = table
    return TABLES[classes]


def counted(texts: list[str], classes: tuple[str, ...], whole: str) -> np.ndarray:
    """A row per text: the characters of every class, all words, and words of ``whole`` alone."""
    table = class_table((*classes, whole, SPACE))
    # a space behind every text ends its last word
    code = table[np.frombuffer("".join(f"{s} " for s in texts).encode("utf-32-le"), np.uint32)]
    size = np.array([len(s) + 1 for s in texts])
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    space = (code >> (len(classes) + 1)) & 1
    first = np.flatnonzero(space[1:] < space[:-1]) + 1 if len(space) else np.zeros(0, int)
    first = np.concatenate([[0], first]) if len(space) and not space[0] else first
    of = np.searchsorted(begin, first, "right") - 1
    # a word is of the class alone if all its characters are; the spaces behind it count as such
    alone = np.bitwise_and.reduceat(np.where(space == 1, 1, (code >> len(classes)) & 1), first) if len(first) else np.zeros(0, int)
    chars = [np.add.reduceat((code >> bit) & 1, begin) for bit in range(len(classes))]
    return np.stack([*chars, np.bincount(of, minlength=len(texts)), np.bincount(of, weights=alone, minlength=len(texts))], axis=1).astype(np.int32)


def counts(c: Column, classes: tuple[str, ...], whole: str) -> Column:
    """An array: how many characters of each class a text has, how many words, and how many of them are of ``whole`` alone. One
    pass over the text for all of them."""

    @F.arrow_udf("array<int>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done, texts, full = [], [], 0
            for s in batch:
                texts.append(s.as_py() or "")
                full += len(texts[-1])
                if full > 1_000_000:
                    done.append(counted(texts, classes, whole))
                    texts, full = [], 0
            done += [counted(texts, classes, whole)] if texts else []
            rows = np.concatenate(done) if done else np.zeros((0, len(classes) + 2), np.int32)
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, len(classes) + 2), pa.int32()), pa.array(rows.reshape(-1)), mask=batch.is_null() if batch.null_count else None)

    return count(c)


def cyrillic_ratio(c: Column) -> Column:
    return script_ratio(c, CYRILLIC)


def latin_ratio(c: Column) -> Column:
    return script_ratio(c, "A-Za-z")


def fix_encoding(c: Column) -> Column:
    return F.translate(c, "`", "ë")


def join_hyphens(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)(\w)\s*[-–]\s*([a-zа-ш])", "$1$2")


def join_spaced_hyphens(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)(\w) - ([а-яё])", "$1$2"), r"(?U)(\w) - ([a-zëç])", "$1$2")


def join_broken_words(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)(\w)\s*-\s+(\w)", "$1$2")


def remove_hex(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?iU)\b[0-9a-f]{32,}\b", ""))


def remove_hex_anywhere(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?i)[0-9a-f]{32,}", ""))


def squeeze_lines(c: Column) -> Column:
    """White space runs within lines to one space, lines stripped, newlines kept."""
    return strip(F.array_join(F.transform(F.split(c, "\n"), lambda s: strip(F.regexp_replace(s, r"(?U)[^\S\n]+", " "))), "\n"))


def squeeze_tabs(c: Column) -> Column:
    """Spaces and tabs to one space; blank lines dropped."""
    return F.array_join(F.filter(F.transform(F.split(F.regexp_replace(c, r"[ \t]+", " "), "\n"), strip), lambda s: s != ""), "\n")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


#: Characters that neither change under NFC nor combine with the one before.
NFC_SAFE = r"\x{0000}-\x{02FF}\x{0400}-\x{0482}\x{048A}-\x{04FF}\x{2010}-\x{2027}"


@F.arrow_udf(T.StringType())
def normalised(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for x in texts:
        yield pa.array((s and unicodedata.normalize("NFC", s) for s in (v.as_py() for v in x)), pa.string(), size=len(x))


def nfc(c: Column) -> Column:
    """Only texts that NFC may change go through Python."""
    return F.coalesce(normalised(F.when(c.rlike(f"[^{NFC_SAFE}]"), c)), c)


def is_noise_line(line: Column) -> Column:
    s = strip(line)
    short = s.rlike(PAGE_NUMBER) | s.rlike(f"(?iu){HEADER_FOOTER}") | s.rlike(f"(?iu){DATE_HEADER}")
    return (s == "") | ((F.length(s) <= LONG_LINE) & short)


def strip_noise(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "\n"), lambda s: ~is_noise_line(s)), "\n")


def clean_side(c: Column, ratio: Column) -> Column:
    """Noise lines dropped; empty where the script's share of a longer rest is below a half."""
    s = strip(strip_noise(c))
    return F.when((ratio < 0.5) & (F.length(s) > 20), "").otherwise(s)


def is_content_line(line: Column) -> Column:
    return (F.length(strip(line)) >= 3) & (digit_fraction(line) <= 0.30) & ~is_noise_line(line)


def is_low_quality(c: Column) -> Column:
    return (strip(c) == "") | (kept(c, r"\p{L}") / F.length(c) < 0.3)


def clean_pages(c: Column) -> Column:
    """Lines that hold a page header or footer are dropped, and blank ones."""
    noise = "(?iu)" + "|".join(BUILDER_NOISE)
    lines = F.transform(F.split(c, "\n"), strip)
    return strip(F.array_join(F.filter(lines, lambda s: (s != "") & ~s.rlike(noise)), "\n"))


def clean_macedonian(c: Column) -> Column:
    noise = f"(?u)^(?:{'|'.join(CLEAN_MK)})$"
    return squeeze_tabs(F.array_join(F.filter(F.split(F.translate(nfc(c), "ёй", "еи"), "\n"), lambda s: ~strip(s).rlike(noise)), "\n"))


def clean_albanian(c: Column) -> Column:
    noise = f"(?iu)^(?:{'|'.join(CLEAN_SQ)})$"
    return squeeze_tabs(F.array_join(F.filter(F.split(nfc(c), "\n"), lambda s: ~strip(s).rlike(noise)), "\n"))


def clean_text(c: Column, albanian: bool = False) -> Column:
    c = nfc(c)
    return remove_hex(join_hyphens(fix_encoding(c) if albanian else c))


def digit_fraction(c: Column) -> Column:
    """Digits (superscripts too) to characters; 0.0 for the empty text."""
    return F.when(F.length(c) > 0, kept(c, DIGITS) / F.length(c)).otherwise(F.when(c.isNotNull(), F.lit(0.0)))


def number_word_fraction(c: Column, digits: str = r"[0-9.,/%]+") -> Column:
    """Words of digits and marks to all words; 1.0 without words."""
    w = words(c)
    return F.when(F.size(w) > 0, F.size(F.filter(w, lambda x: x.rlike(f"^{digits}$"))) / F.size(w)).otherwise(F.when(c.isNotNull(), F.lit(1.0)))


def has_albanian_markers(c: Column) -> Column:
    return c.rlike("[ëËçÇ]")


def sentences(c: Column, ends: str = ".!?") -> Column:
    """Cut behind an end mark and white space; stripped, none empty."""
    return F.filter(F.transform(F.split(c, rf"(?U)(?<=[{ends}])\s+"), strip), lambda s: s != "")


def long_sentences(c: Column, least: int = 5) -> Column:
    return F.filter(sentences(c), lambda s: word_count(s) >= least)


def paragraph_sentences(c: Column, least: int = 15) -> Column:
    """Cut where a capital (or any letter from U+0400 to U+2C7F) follows, then at blank lines; at least 15 characters."""
    first = F.split(c, r"(?U)(?<=[.!?])\s+(?=[A-ZА-ЯЀ-Ɀ])")
    parts = F.transform(F.flatten(F.transform(first, lambda s: F.split(s, "\n\n"))), squeeze)
    return F.filter(parts, lambda s: F.length(s) >= least)


def shingles(c: Column, n: int = 3) -> Column:
    """Character n-grams in order; none for shorter texts."""
    return bound(c, lambda x: F.when(F.length(x) >= n, F.transform(F.sequence(F.lit(1), F.length(x) - n + 1), lambda i: F.substring(x, i, F.lit(n)))).otherwise(F.array().cast("array<string>")))


def pair_hash(a: Column, b: Column) -> Column:
    return F.sha2(F.concat(F.lower(strip(a)), F.lit(" ||| "), F.lower(strip(b))).cast("binary"), 256)


def length_ratio_score(a: Column, b: Column) -> Column:
    """1 at equal word counts, falling to 0 at a ratio off by 1.5; 0 outside 0.4 to 2.5 or where a side is empty."""
    r = a / b
    inside = (a > 0) & (b > 0) & (r >= 0.4) & (r <= 2.5)
    return F.when(inside, F.greatest(F.lit(0.0), 1 - F.abs(1 - r) / 1.5)).otherwise(F.lit(0.0))


def char_ratio(a: Column, b: Column) -> Column:
    return F.when(F.length(b) > 0, F.length(a) / F.length(b)).otherwise(F.lit(999.0))


def normal_confidence(c: Column) -> Column:
    return F.coalesce(F.least(F.greatest(F.when(c > 1, c / 1000).otherwise(c), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))


def cost_confidence(cost: Column, whole_text: bool = False) -> Column:
    c = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - cost / 10)), 3)
    return F.round(c * 0.7, 3) if whole_text else c


def year_of(source: Column) -> Column:
    return F.coalesce(F.try_element_at(F.filter(F.split(source, "_"), lambda x: x.rlike(r"^\d{4}$")), F.lit(1)), F.lit("unknown"))


def method_category(m: Column) -> Column:
    gc, structural = F.contains(m, F.lit("gc")), F.contains(m, F.lit("structural"))
    return F.when(structural & gc, "Structural + Gale-Church").when(structural, "Structural Only").when(F.contains(m, F.lit("gale_church")) | gc, "Gale-Church Only").otherwise("Other")


def article_order(c: Column) -> tuple[Column, Column]:
    """Sort columns of article ids: leading number (999999 without), and the rest."""
    n = F.regexp_extract(c, r"^(\d+)", 1)
    return F.when(n != "", n.cast("int")).otherwise(F.lit(999999)), F.when(n != "", F.regexp_extract(c, r"^\d+(.*)$", 1)).otherwise(c)


def middle(c: Column, size: int = 1500) -> Column:
    begin = F.floor((F.length(c) - size) / 2).cast("int")
    return F.when(F.length(c) > size, F.substring(c, begin + 1, F.lit(size))).otherwise(c)


def upper_run(c: Column, least: int = 6) -> Column:
    """Whether so many words in a row, each longer than one character, are upper case."""
    flags = F.transform(words(c), lambda w: F.when((F.length(w) > 1) & (F.upper(w) == w) & w.rlike(r"\p{Lu}"), "U").otherwise("L"))
    return F.array_join(flags, "").rlike(f"U{{{least}}}")


# Month names of dates, by number, and Roman numerals.
MONTH_NAMES_MK = {"јануари": 1, "јануар": 1, "февруари": 2, "фебруар": 2, "март": 3, "април": 4, "мај": 5, "јуни": 6, "јун": 6, "јули": 7, "јул": 7, "август": 8, "септември": 9, "септембар": 9, "октомври": 10, "октобар": 10, "ноември": 11, "новембар": 11, "декември": 12, "децембар": 12}
MONTH_NAMES_SR = {"januar": 1, "januara": 1, "februar": 2, "februara": 2, "mart": 3, "marta": 3, "april": 4, "aprila": 4, "maj": 5, "maja": 5, "jun": 6, "juna": 6, "juni": 6, "jul": 7, "jula": 7, "juli": 7, "avgust": 8, "avgusta": 8, "septembar": 9, "septembra": 9, "oktobar": 10, "oktobra": 10, "novembar": 11, "novembra": 11, "decembar": 12, "decembra": 12}
ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII")


def month_of(c: Column, year: Column) -> Column:
    """The month of the first date form that names the expected year: day, month name and year (two languages), Roman
    month, numeric date, month name and year; null without one. A name counts by its first match in the text; a text is
    lowered once, and searched by a pattern only for names that it contains."""
    number = year.cast("string")

    def named(names: dict[str, int], day: bool) -> Column:
        head = r"\b\d{1,2}\s*\.?\s*" if day else r"\b"
        return bound(F.lower(c), lambda low: F.coalesce(*[F.when(F.contains(low, F.lit(n)) & (F.regexp_extract(low, rf"(?U){head}{n}\s*\.?\s*(\d{{4}})", 1) == number), F.lit(m)) for n, m in names.items()]))

    roman = [F.when(F.regexp_extract(c, rf"(?U)\b\d{{1,2}}\s*\.?\s*{r}\s*\.?\s*(\d{{4}})", 1) == number, F.lit(ROMAN.index(r) + 1)) for r in sorted(ROMAN, key=len, reverse=True)]
    any_roman = F.when(c.rlike(r"(?U)\d\s*\.?\s*[IVX]+\s*\.?\s*\d{4}"), F.coalesce(*roman))
    dates = F.filter(F.regexp_extract_all(c, F.lit(r"\b\d{1,2}[./]\d{1,2}[./]\d{4}\b"), F.lit(0)), lambda d: F.right(d, F.lit(4)) == number)
    month = F.regexp_extract(F.coalesce(F.try_element_at(dates, F.lit(1)), F.lit("")), r"[./](\d{1,2})[./]", 1)
    numeric = F.when(month.rlike("^0?[1-9]$|^1[0-2]$"), month.cast("int"))
    return F.coalesce(named(MONTH_NAMES_MK, True), named(MONTH_NAMES_SR, True), any_roman, numeric, named({**MONTH_NAMES_MK, **MONTH_NAMES_SR}, False))
