"""Embedding near-duplicates by an epsilon grid order join.

Vectors are scaled to length 1, where a cosine of at least ``cosine`` is a distance of at most epsilon, and projected on the
``LEADING`` principal dimensions. They are sorted by their grid cells there (cells of width epsilon, compared dimension by
dimension) into one sequence, cut into intervals. Two intervals, or runs of them, are joined recursively: a pair of runs
whose bounding boxes are further apart than epsilon is skipped, since projection shortens distances; others are halved.
A pair of intervals that remains is one group, in which halving goes on down to blocks, which are compared by a matrix
product. Products within 1e-4 of the threshold are decided again in double precision.

An interval has a quarter of the vectors, but at least ``LEAST`` and at most ``INTERVAL_BYTES`` of them, so that a vector
goes to as few groups as memory allows. A box takes 256 bytes for the 16 MB of an interval; boxes are what the driver
sends to the tasks that look for each interval's partners, and the pairs of intervals stay in a table.

Equal vectors are one class (by two 64-bit hashes), so copies aren't compared with each other; a group returns numbers of
links and a spanning forest instead of pairs. Nothing is capped. Vectors that are null, zero, or hold null or non-finite
components link with nothing; vectors of different lengths don't link. Ties do not occur: every pair is decided by its
cosine alone. Repeated ids keep their rows, each counted as a vector; their component is found as one vertex. A vector
without an id has no links. Very long vectors make shorter intervals. An empty table gives an empty table. Columns
other than id and vector are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import components, forest, shared_dir, stored, width

LEADING = 16
LEAST = 1024
INTERVAL_BYTES = 16_000_000
BLOCK = 1024
NEAR = 1e-4


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length 1."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # scaled first, so that squares neither vanish nor overflow
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal(classes: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal dimensions, from sums over all classes: dim * (dim + 1) + 1 numbers."""

    def run(batches):
        n, s, o = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            x = matrix(b.column(0))
            n, s, o = n + len(x), s + x.sum(axis=0), o + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim + dim + 1)), pa.array(np.concatenate([[n], s, o.ravel()]))], names=["i", "v"])

    got = classes.select("vec").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    v = np.zeros(dim * dim + dim + 1)
    for r in got:
        v[r.i] = r.v
    mean = v[1 : dim + 1] / max(1, v[0])
    cov = v[dim + 1 :].reshape(dim, dim) / max(1, v[0]) - np.outer(mean, mean)
    _, vectors = np.linalg.eigh(cov)
    return mean, vectors[:, ::-1][:, :LEADING]


def apart(lo: np.ndarray, hi: np.ndarray, lo2: np.ndarray, hi2: np.ndarray) -> float:
    """The distance of two boxes."""
    return float(np.sqrt((np.maximum(0, np.maximum(lo - hi2, lo2 - hi)) ** 2).sum()))


def partners(i: int, lo: np.ndarray, hi: np.ndarray, epsilon: float) -> list[int]:
    """The intervals from ``i`` on that may hold vectors within epsilon of its own, by halving runs of the sequence."""
    out, todo = [], [(i, len(lo))]
    while todo:
        a, b = todo.pop()
        if apart(lo[i], hi[i], lo[a:b].min(axis=0), hi[a:b].max(axis=0)) > epsilon + 1e-9:
            continue
        if b - a == 1:
            out.append(a)
        else:
            todo += [((a + b) // 2, b), (a, (a + b) // 2)]
    return out


def join_blocks(x: np.ndarray, p: np.ndarray, first: slice, second: slice, cosine: float, epsilon: float):
    """Index pairs of the rows of two runs within the threshold, block by block."""
    small = x.astype(np.float32)
    todo = [(first, second)]
    while todo:
        s, t = todo.pop()
        if not (s.stop - s.start and t.stop - t.start) or apart(p[s].min(axis=0), p[s].max(axis=0), p[t].min(axis=0), p[t].max(axis=0)) > epsilon + 1e-9:
            continue
        if max(s.stop - s.start, t.stop - t.start) > BLOCK:
            if s == t:
                m = (s.start + s.stop) // 2
                u, v = slice(s.start, m), slice(m, s.stop)
                todo += [(u, u), (u, v), (v, v)]
            elif s.stop - s.start >= t.stop - t.start:
                m = (s.start + s.stop) // 2
                todo += [(slice(s.start, m), t), (slice(m, s.stop), t)]
            else:
                m = (t.start + t.stop) // 2
                todo += [(s, slice(t.start, m)), (s, slice(m, t.stop))]
            continue
        dot = small[s] @ small[t].T
        i, j = np.nonzero(dot >= cosine - NEAR)
        if s == t:
            i, j = i[i < j], j[i < j]
        close = np.flatnonzero(dot[i, j] < cosine + NEAR)
        good = np.ones(len(i), bool)
        for k in range(0, len(close), 65_536):
            c = close[k : k + 65_536]
            good[c] = np.einsum("ij,ij->i", x[s][i[c]], x[t][j[c]]) >= cosine
        if good.any():
            yield i[good] + s.start, j[good] + t.start


def links(classes: DataFrame, dim: int, cosine: float, folder: str) -> DataFrame:
    """rep, links (vectors of other classes linked, by groups), root (a linked class in the same group's forest)."""
    spark = classes.sparkSession
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine))
    mean, axes = principal(classes, dim)
    cells = [f"c{k}" for k in range(axes.shape[1])]
    places = [f"p{k}" for k in range(axes.shape[1])]

    def project(batches):
        for b in batches:
            p = (matrix(b.column(2)) - mean) @ axes
            cell = np.floor(p / max(epsilon, 1e-6)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(cell[:, k]) for k in range(len(cells))], *[pa.array(p[:, k]) for k in range(len(places))]], names=["rep", "n", "vec", *cells, *places])

    kind = classes.schema["vec"].dataType.simpleString()
    schema = f"rep long, n long, vec {kind}, " + ", ".join([f"{c} int" for c in cells] + [f"{p} double" for p in places])
    given = classes.select("rep", "n", "vec").mapInArrow(project, schema)
    order = [*cells, "rep"]
    given = stored(given.repartitionByRange(width(spark), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), f"{folder}/sequence")
    # a row per partition of the sorted rows: where it begins in the sequence
    sizes = {r.part: r.n for r in given.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).collect()}
    begin, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        begin.append(total)
        total += sizes.get(k, 0)
    if not total:
        return spark.createDataFrame([], "rep long, links long, root long")
    at = F.get(F.array(*[F.lit(b).cast("long") for b in begin]), F.shiftright("at", 33).cast("int")) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    interval = max(LEAST, min(math.ceil(total / 4), INTERVAL_BYTES // (8 * dim)))
    given = given.withColumn("at", at).withColumn("interval", F.floor(F.col("at") / interval).cast("int"))
    boxes = given.groupBy("interval").agg(F.array(*map(F.min, places)).alias("lo"), F.array(*map(F.max, places)).alias("hi")).orderBy("interval").collect()
    held = spark.sparkContext.broadcast((np.array([r.lo for r in boxes]), np.array([r.hi for r in boxes])))

    def meet(batches):
        lo, hi = held.value
        for b in batches:
            for i in b.column(0).to_pylist():
                j = partners(i, lo, hi, epsilon)
                yield pa.RecordBatch.from_pydict({"i": [i] * len(j), "j": j}, schema=pa.schema([("i", pa.int32()), ("j", pa.int32())]))

    pairs = spark.range(len(boxes)).mapInArrow(meet, "i int, j int")
    table = pairs.select(F.explode(F.array_distinct(F.array("i", "j"))).alias("interval"), "i", "j")
    rows = given.select("interval", "at", "rep", "n", "vec").join(stored(table, f"{folder}/pairs"), "interval")

    def compare(group: pa.Table) -> pa.Table:
        g = group.combine_chunks().sort_by("at")
        x = matrix(g.column("vec").combine_chunks())
        p = (x - mean) @ axes
        n, rep, side = g.column("n").to_numpy().astype(np.float64), g.column("rep").to_numpy(), g.column("interval").to_numpy()
        cut = int((side == side[0]).sum())
        runs = (slice(0, cut), slice(0, cut)) if cut == len(side) else (slice(0, cut), slice(cut, len(side)))
        count, ends = np.zeros(len(x)), []
        for i, j in join_blocks(x, p, *runs, cosine, epsilon):
            np.add.at(count, i, n[j])
            np.add.at(count, j, n[i])
            seen, where = np.unique(np.concatenate([i, j]), return_inverse=True)
            label = forest(where[: len(i)], where[len(i) :], len(seen))
            keep = label != np.arange(len(seen))
            ends.append((seen[keep], seen[label[keep]]))
        at = np.flatnonzero(count)
        label = np.arange(len(x))
        if ends:
            label = forest(np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends]), len(x))
        return pa.table({"rep": rep[at], "links": count[at].astype(np.int64), "root": rep[label[at]]})

    return rows.groupBy("i", "j").applyInArrow(compare, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    spark = vectors.sparkSession
    folder = shared_dir(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vec"))
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    fine = F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", number) & F.exists("vec", lambda v: v != 0)
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    good = rows.filter("fine").withColumn("key", F.struct(F.xxhash64("vec").alias("a"), F.xxhash64(F.lit(1), "vec").alias("b")))
    classes = good.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")).withColumn("dim", F.size("vec"))
    classes = stored(classes, f"{folder}/classes")
    dims = sorted(r.dim for r in classes.select("dim").distinct().collect())
    found = None
    for d in dims:
        some = links(classes.filter(F.col("dim") == d), d, cosine, f"{folder}/dim{d}")
        found = some if found is None else found.unionByName(some)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found, f"{folder}/found")
    comp = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    other = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = classes.select("key", "rep", "n").join(other, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = good.drop("vec").join(named, "key").select("vec_id", "n_links", "component_id")
    rest = rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
