"""SimHash near-duplicates by a grid range join of segment bit counts.

A fingerprint has 64 bits over word shingles: bit b is 1 if it is set in over half of the shingles' XXH64 hashes. Its
embedding counts the bits of each segment of two bits (32 counts of 0 to 2). The Manhattan distance of two embeddings
never exceeds the Hamming distance of the fingerprints, so fingerprints within ``radius`` have embeddings within it. The
counts are cut into ``radius // 2 + 1`` groups, in one of which the embeddings are within 1: the range join. A group's
counts name a cell of its grid; every fingerprint is in its own cell of each group and visits the cells above, those in
which one count is one more, so that two fingerprints within 1 meet in the upper one's cell. There, the Manhattan
distance of all counts is taken first, as the lower bound, and pairs within the radius are verified by their exact
Hamming distance.

A cell holds at most about 1/1,000 of uniform fingerprints, visitors included. Equal fingerprints are one vertex. A cell
of more than ``TILE`` rows is split into tiles whose pairs are separate groups, so no cell is held as a whole, and what
comes out is a spanning forest of links rather than pairs. Nothing is capped: every pair of fingerprints within the
radius is compared.

Null and empty texts have fingerprint zero. Very long texts are folded in parts of ``PART`` bytes. Repeated rows have
equal fingerprints, equal ids keep all their rows; an empty table gives an empty table. Columns of the input other than
id and text are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import components, forest, portions, stored, width

SEED = 42
TILE = 32_768
SMALL = 64  # rows of a cell up to which cells are compared together, shifted against themselves
FIELDS = 32
LOW = 0x5555555555555555
PART = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def digests_of(text: bytes, shingle: int):
    """The hashes of a text's shingles, in parts."""
    from xxhash import xxh64_digest

    at, before, any_ = 0, [], False
    while at < len(text):
        end = min(len(text), at + PART)
        if end < len(text):
            m = SPACE.search(text, end)
            end = m.start() if m else len(text)
        words = before + text[at:end].lower().split()  # bytes: A-Z only, and splits at space and bytes 9 to 13 only
        n, at = len(words), end
        if n >= shingle:
            joined = b" ".join(words)
            starts = np.cumsum([0, *map(len, words)]) + np.arange(n + 1)
            ends = (starts[shingle:] - 1).tolist()
            yield b"".join([xxh64_digest(joined[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), ends, strict=True)])
            any_ = True
        before = words[max(0, n - shingle + 1) :] if shingle > 1 else []
    if before and not any_:
        yield xxh64_digest(b" ".join(before), SEED)


def fingerprints_of(texts: list[bytes], shingle: int) -> np.ndarray:
    ones, total, held, full = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64), [], 0

    def fold() -> None:
        bits = np.unpackbits(np.frombuffer(b"".join([d for _, d in held]), np.uint8).reshape(-1, 8), axis=1)
        n = np.array([len(d) // 8 for _, d in held])
        np.add.at(ones, [k for k, _ in held], np.add.reduceat(bits, np.cumsum(n) - n, axis=0, dtype=np.int64))
        np.add.at(total, [k for k, _ in held], n)
        held.clear()

    for k, t in enumerate(texts):
        for d in digests_of(t, shingle):
            held.append((k, d))
            full += len(d)
            if full >= PART:
                fold()
                full = 0
    if held:
        fold()
    return np.packbits(2 * ones > total[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, extra columns and ``fp``, the fingerprint as a signed long."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), *extra, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for whole in batches:
            for b in portions(whole, whole.num_columns - 1):
                fp = fingerprints_of(b.column(b.num_columns - 1).to_pylist(), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp)], names=["doc_id", *extra, "fp"])

    return rows.mapInArrow(run, rows.select("doc_id", *extra, F.lit(0).cast("long").alias("fp")).schema)


def counted(x: np.ndarray) -> np.ndarray:
    """The counts of a fingerprint's segments, each in the place of its two bits."""
    low = np.uint64(LOW)
    return (x & low) + ((x >> np.uint64(1)) & low)


def within(x: np.ndarray, y: np.ndarray, c: np.ndarray, e: np.ndarray, radius: int) -> np.ndarray:
    """Whether fingerprints with counts c and e are within the radius: the Manhattan distance first, then the Hamming distance."""
    z, low = c ^ e, np.uint64(LOW)
    far = np.bitwise_count(z & low).astype(np.int16) + 2 * np.bitwise_count((z >> np.uint64(1)) & ~z & low).astype(np.int16)
    near = far <= radius
    at = np.nonzero(near)
    if len(at[0]):
        x, y = np.broadcast_arrays(x, y)
        near[at] = np.bitwise_count(x[at] ^ y[at]) <= radius
    return near


def linked(x: np.ndarray, side: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints within ``radius``; with ``side``, of one side with the other only."""
    total = np.bitwise_count(x).astype(np.int64)
    order = np.argsort(total, kind="stable")
    s, t, c = x[order], total[order], counted(x[order])
    stop = np.searchsorted(t, t + radius, side="right")
    ii, jj = [], []
    for a in range(0, len(s), 256):
        b = min(a + 256, len(s))
        end = stop[b - 1]
        p, q = np.nonzero(np.triu(within(s[a:b, None], s[None, a:end], c[a:b, None], c[None, a:end], radius), 1))
        ii.append(order[p + a])
        jj.append(order[q + a])
    i, j = (np.concatenate(ii), np.concatenate(jj)) if ii else (np.empty(0, int), np.empty(0, int))
    if side is not None:
        ok = side[i] != side[j]
        i, j = i[ok], j[ok]
    return i, j


def edges_of(x: np.ndarray, cut: np.ndarray, two: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of a spanning forest of the links within the groups that begin at ``cut``."""
    size = np.diff(np.append(cut, len(x)))
    group, ii, jj = np.repeat(np.arange(len(cut)), size), [], []
    few = np.flatnonzero(size[group] <= SMALL)
    s, g = x[few], group[few]
    c = counted(s)
    for k in range(1, SMALL):
        at = np.flatnonzero(g[:-k] == g[k:]) if k < len(g) else np.empty(0, int)
        if not len(at):
            break
        ok = at[within(s[at], s[at + k], c[at], c[at + k], radius)]
        ii.append(few[ok])
        jj.append(few[ok + k])
    for k in np.flatnonzero(size > SMALL).tolist():
        a, b = cut[k], cut[k] + size[k]
        i, j = linked(x[a:b], side[a:b] if two[a] else None, radius)
        label = forest(i, j, b - a)
        at = np.flatnonzero(label != np.arange(b - a))
        ii.append(at + a)
        jj.append(label[at] + a)
    i, j = (np.concatenate(ii), np.concatenate(jj)) if ii else (np.empty(0, int), np.empty(0, int))
    if not len(i):
        return x[i], x[j]
    # rows of one fingerprint are one vertex
    names, at = np.unique(np.concatenate([x[i], x[j]]), return_inverse=True)
    label = forest(at[: len(i)], at[len(i) :], len(names))
    at = np.flatnonzero(label != np.arange(len(names)))
    return names[at], names[label[at]]


def visits(counts: Column, radius: int) -> Column:
    """Array of (part, cell, own): the cells of every group of counts, and those one above it if the radius asks for them."""
    groups = radius // 2 + 1
    cuts = [FIELDS * k // groups for k in range(groups + 1)]
    signed = lambda m: F.lit(m - 2**64 if m >= 2**63 else m).cast("long")
    out = []
    for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        cell = counts.bitwiseAND(signed(sum(3 << 2 * f for f in range(a, b))))
        out.append(F.array(F.struct(F.lit(part).alias("part"), cell.alias("cell"), F.lit(True).alias("own"))))
        if radius:
            # a count is one more if its place goes from 00 to 01 or from 01 to 10
            more = lambda f, cell=cell: cell.bitwiseXOR(F.when(counts.bitwiseAND(signed(1 << 2 * f)) == 0, signed(1 << 2 * f)).otherwise(signed(3 << 2 * f)))
            above = [F.when(counts.bitwiseAND(signed(2 << 2 * f)) == 0, F.struct(F.lit(part).alias("part"), more(f).alias("cell"), F.lit(False).alias("own"))) for f in range(a, b)]
            out.append(F.array_compact(F.array(*above)))
    return F.concat(*out)


def links(fps: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints that links within ``radius`` connect; ``fps`` are distinct."""
    spark = fps.sparkSession
    x, low = F.col("fp"), F.lit(LOW)
    y = F.shiftrightunsigned("fp", 1)
    counts = x.bitwiseXOR(y).bitwiseAND(low).bitwiseOR(F.shiftleft(x.bitwiseAND(y).bitwiseAND(low), 1))
    cells = fps.select("fp", F.explode(visits(counts, radius)).alias("v")).select("fp", "v.*")
    # nobody meets in cells without an owner or with one row
    sizes = cells.groupBy("part", "cell").agg(F.count("*").alias("n"), F.bool_or("own").alias("owned")).filter("n > 1 and owned")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    rows = cells.join(sizes.select("part", "cell", tiles.alias("tiles")), ["part", "cell"]).withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    rows = rows.withColumn("other", other).select("part", "cell", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "fp")
    dealt = rows.repartition(width(spark), "part", "cell", "lo", "hi").sortWithinPartitions("part", "cell", "lo", "hi")

    def run(batches):
        held = None

        def edges(k: np.ndarray):
            cut = np.flatnonzero(np.concatenate([[True], (k[:4, 1:] != k[:4, :-1]).any(axis=0)]))
            a, b = edges_of(k[5].view(np.uint64), cut, k[2] != k[3], k[4], radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for b in batches:
            k = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
            held = k if held is None else np.concatenate([held, k], axis=1)
            last = np.flatnonzero((held[:4] != held[:4, -1:]).any(axis=0))
            if len(last):  # the last group may go on
                yield from edges(held[:, : last[-1] + 1])
                held = held[:, last[-1] + 1 :]
        if held is not None and held.shape[1]:
            yield from edges(held)

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 5, radius: int = 4, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, extra columns, fp, component (a fingerprint of it) and component_id (the smallest id reachable over links): one row per document."""
    fp = stored(fingerprints(docs, text, doc_id, shingle, extra))
    classes = stored(fp.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = components(links(classes.select("fp"), radius))
    named = classes.join(comp, classes.fp == comp.id, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = stored(named)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("fp", "component", "component_id")
    return fp.join(named, "fp").select("doc_id", *extra, "fp", "component", "component_id")
