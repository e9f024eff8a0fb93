"""Token ids in compressed shards with an index, so that single short documents can be read.

``write`` encodes every text with a tokenizers file, appends the end id and writes shards in ascending order of the
document id: rows are dealt by ranges of the id, sorted within a task, and each task streams its documents into one
shard below ``folder`` (a temporary name is renamed when complete, so that a repeated task replaces its shard).
A shard is: magic, width of an id in bytes, SHA-256 of the dictionary; one zstandard frame for each document, all with
the shared dictionary; an index of ids, offsets and token counts; its place, CRC-32 and magic. The dictionary, trained
on the serialized ids of at most ``SAMPLE`` documents and ``SAMPLE_BYTES`` (those of the least hash of the id; a documented bound), is stored
beside the shards. ``write`` returns the manifest: shard, path, n_docs, n_tokens, dict_sha256, start (ids before it).
``read`` reads shards back; ``read_document`` one document by its id, without the rest of the shard.

Words between white space are encoded once and remembered, up to ``CACHE`` a worker: the tokenizer's patterns cross no
ASCII white space. A text that contains one of the tokenizer's added tokens is encoded as a whole.

Null text: as empty (the end id only). A null document id is written as the least; equal ids keep all their rows, in
order of the text's hash. Very long texts are encoded in parts of ``PART`` bytes. An empty table: no shard. Extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import math
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusforge.llm.common import portions, shared_dir, stored, width

MAGIC = b"FIDS0001"
TAIL = "<QQI8s"
SAMPLE = 1_000
DICT_BYTES = 64 * 1024
SAMPLE_BYTES = 32_000_000
CACHE = 900_000
PART = 4_000_000
SHARD = 32_000_000  # bytes of text a shard
#: A pattern under which a word's ids are those of its letters and of the marks after them.
APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
TAILS = b".,!;:?#$%&*|"
SPACE = re.compile(rb"[\x20\x09-\x0D]")
NO_ID = -(2**63)


def open_fs(uri: str):
    """A file system and path for a folder that Spark names: any scheme that pyarrow knows, or a plain path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class Encoder:
    """A tokenizers file with its remembered words.

    Where the file lowers all letters, words are looked up with A-Z lowered. Where its pattern takes letters, single digits
    and runs of the rest apart, a word that ends in marks is the word before them and the marks.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        n = self.tok.get_vocab_size()
        self.kind = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        with open(path, "rb") as f:
            said = json.load(f)
        self.lowers = '"type": "Lowercase"' in json.dumps(said.get("normalizer"))
        self.apart = json.dumps(APART) in json.dumps(said.get("pre_tokenizer"))
        self.marks = [a.encode() for a in self.added]
        self.words: dict[bytes, bytes] = {}

    def pack(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.kind.itemsize == 2 else 'I'}", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialized ids, without an end id."""
        split = []
        for t in texts:
            raw = t.encode()
            low = raw.lower() if self.lowers else raw
            split.append(None if any(a in low or a in raw for a in self.marks) else low)
        out = []
        for t, raw in zip(texts, split, strict=True):
            if raw is None:
                out.append(self.pack(self.tok.encode(t, add_special_tokens=False).ids))
                continue
            out.append(b"".join([self.join(raw[a:b].split()) for a, b in parts(raw)]))
        return out

    def join(self, words: list[bytes]) -> bytes:
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            self.learn(set(words))
        return b"".join(map(self.words.__getitem__, words))

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.words)
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = words
        known, todo = self.words, []
        for w in new:
            stem = w.rstrip(TAILS) if self.apart else w
            if len(stem) < len(w) and stem[-1:].isalnum() and (x := known.get(stem)) is not None and (y := known.get(w[len(stem) :])) is not None:
                known[w] = x + y
            else:
                todo.append(w)
        known.update(zip(todo, self.apart_ids([w.decode() for w in todo]), strict=True))

    def apart_ids(self, words: list[str]) -> list[bytes]:
        """The ids of words, which one of the added tokens, always a token of its own, keeps apart in fewer texts."""
        out: list[bytes] = []
        if self.added:
            sep, size = self.tok.token_to_id(self.added[0]), self.kind.itemsize
            texts = [self.added[0].join(words[k : k + 200]) for k in range(0, len(words), 200)]
            for e in self.tok.encode_batch_fast(texts, add_special_tokens=False):
                ids, raw, s = e.ids, self.pack(e.ids), 0
                for at in [i for i, x in enumerate(ids) if x == sep]:
                    out.append(raw[s * size : at * size])
                    s = at + 1
                out.append(raw[s * size :])
        if len(out) != len(words):
            out = [self.pack(e.ids) for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]
        return out


def parts(text: bytes):
    """Places of parts of at most about ``PART`` bytes, cut at white space."""
    a = 0
    while a < len(text):
        m = SPACE.search(text, a + PART) if a + PART < len(text) else None
        b = m.start() if m else len(text)
        yield a, b
        a = b


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def train(samples: list[bytes]) -> bytes:
    """A dictionary of serialized id arrays; the arrays themselves where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICT_BYTES]


def _dict(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, text: str = "text", doc_id: str = "doc_id", level: int = 3) -> DataFrame:
    spark = docs.sparkSession
    folder = folder or shared_dir(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    count = rows.count()
    # a hash bound leaves about twice the sample, so that tasks don't each send as many texts as the sample has
    share = min(1.0, 2 * SAMPLE / max(1, count))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    near = stored(rows.filter(place <= int(share * (1 << 30))).orderBy(place, "text").limit(SAMPLE).withColumn("n", F.octet_length("text")), f"{folder}/sample")
    sizes = near.groupBy(place.alias("place")).agg(F.sum("n").alias("n"), F.count("*").alias("rows")).orderBy("place").collect()
    size = count * (sum(r.n for r in sizes) / max(1, sum(r.rows for r in sizes)) + 16)  # as the sample is
    upto = np.cumsum([r.n for r in sizes]) <= SAMPLE_BYTES
    last = sizes[int(upto.sum()) - 1].place if upto.any() else -1
    some = [r.text for r in near.filter(place <= last).orderBy(place, "text").collect()]
    enc = encoder(tokenizer)
    end = enc.pack([end_id])
    raw = train([x + end for x in enc.encode(some)])
    enc.words.clear()
    key = hashlib.sha256(raw).digest()
    fs, at = open_fs(f"{folder}/shards")
    fs.create_dir(at, recursive=True)
    with fs.open_output_stream(f"{at}/dict-{key.hex()}.zdict") as f:
        f.write(raw)

    def run(batches):
        import zstandard

        gc.disable()
        e, fs, path = encoder(tokenizer), None, ""
        pack = zstandard.ZstdCompressor(level=level, dict_data=_dict(raw))
        ids, offsets, counts, out = [], [0], [], None
        task = TaskContext.get()
        for whole in batches:
            for b in portions(whole, 1):
                if out is None:
                    fs, path = open_fs(f"{folder}/shards/shard-{task.partitionId():08d}")
                    out = fs.open_output_stream(temp := f"{path}.{task.taskAttemptId()}.tmp")
                    out.write(MAGIC + bytes([e.kind.itemsize]) + key)
                for i, x in zip(b.column(0).to_pylist(), e.encode(b.column(1).to_pylist()), strict=True):
                    frame = pack.compress(x + end)
                    out.write(frame)
                    ids.append(NO_ID if i is None else i)
                    offsets.append(offsets[-1] + len(frame))
                    counts.append(len(x) // e.kind.itemsize + 1)
        if out is None:
            return
        index = zlib.compress(np.array(ids, "<i8").tobytes() + np.array(offsets, "<i8").tobytes() + np.array(counts, "<i8").tobytes(), 1)
        head = len(MAGIC) + 1 + len(key)
        out.write(index + struct.pack(TAIL, head + offsets[-1], len(ids), zlib.crc32(index), MAGIC))
        out.close()
        fs.move(temp, path)
        yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "path": [f"{folder}/shards/shard-{task.partitionId():08d}"], "n_docs": [len(ids)], "n_tokens": [sum(counts)], "dict_sha256": [key.hex()]}, schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("dict_sha256", pa.string())]))

    # rows of one id (or none) are dealt by their text's hash as well
    order = ("doc_id", "hash", "text")
    dealt = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(max(1, math.ceil(size / SHARD)), *order[:2]).sortWithinPartitions(*order).select("doc_id", "text")
    manifest = stored(dealt.mapInArrow(run, "shard int, path string, n_docs long, n_tokens long, dict_sha256 string"), f"{folder}/manifest")
    # one row a shard
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


class Shard:
    """A shard's index, and its documents one at a time or all in order."""

    def __init__(self, uri: str):
        import zstandard

        self.fs, self.path = open_fs(uri)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        place, n, crc, magic = struct.unpack(TAIL, self.file.read_at(struct.calcsize(TAIL), size - struct.calcsize(TAIL)))
        index = self.file.read_at(size - struct.calcsize(TAIL) - place, place)
        self.head = len(MAGIC) + 33
        first = self.file.read_at(self.head, 0)
        if magic != MAGIC or first[: len(MAGIC)] != MAGIC or zlib.crc32(index) != crc:
            raise ValueError(f"{uri} is damaged")
        self.kind = np.dtype(f"<u{first[len(MAGIC)]}")
        with self.fs.open_input_stream(f"{self.path.rpartition('/')[0]}/dict-{first[len(MAGIC) + 1 :].hex()}.zdict") as f:
            raw = f.read()
        if hashlib.sha256(raw).digest() != first[len(MAGIC) + 1 :]:
            raise ValueError(f"the dictionary of {uri} is another one")
        self.unpack = zstandard.ZstdDecompressor(dict_data=_dict(raw))
        all_ = np.frombuffer(zlib.decompress(index), "<i8")
        self.ids, self.offsets, self.counts = all_[:n], all_[n : 2 * n + 1], all_[2 * n + 1 :]

    def get(self, k: int) -> np.ndarray:
        frame = self.file.read_at(int(self.offsets[k + 1] - self.offsets[k]), self.head + int(self.offsets[k]))
        return np.frombuffer(self.unpack.decompress(frame), self.kind)


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids array<int>: every document of the shards of a manifest."""
    spark = manifest.sparkSession

    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = Shard(path)
                starts = start + np.cumsum(s.counts) - s.counts
                # parts of at most 256 documents and about 4 million ids
                cut, full = [0], 0
                for k, n in enumerate(s.counts.tolist()):
                    if k > cut[-1] and (k - cut[-1] == 256 or full + n > 4_000_000):
                        cut.append(k)
                        full = 0
                    full += n
                for k, e in zip(cut, [*cut[1:], len(s.ids)], strict=True):
                    part = [s.get(i) for i in range(k, e)]
                    if (lengths := [len(x) for x in part]) != s.counts[k:e].tolist():
                        raise ValueError(f"{path}: the index and the frames differ")
                    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(part).astype(np.int32)))
                    names = s.ids[k:e]
                    yield pa.RecordBatch.from_arrays([pa.array(names, mask=names == NO_ID), pa.array(starts[k:e]), ids], names=["doc_id", "start", "ids"])

    return manifest.select("path", "start", "shard").repartition(width(spark), "shard").mapInArrow(run, "doc_id long, start long, ids array<int>")


def digests(back: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for b in batches:
            ids = b.column(2)
            flat, cut = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            cut = cut - cut[0]
            crc = [zlib.crc32(flat[s:e]) for s, e in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(cut).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return back.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(path: str, doc_id: int) -> list[int] | None:
    """One document's ids from a shard: its index and one frame are read."""
    s = Shard(path)
    k = int(np.searchsorted(s.ids, doc_id))
    return s.get(k).tolist() if k < len(s.ids) and s.ids[k] == doc_id else None
