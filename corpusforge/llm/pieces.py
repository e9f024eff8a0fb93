"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Every text is encoded by this module's own agenda of adjacent symbol pairs, taken in order of score (the leftmost
first among equals), and each Arrow batch's new chunks are compared with the sentencepiece library, which also does
the decoding. A text is cut where no merge can cross: before a run of word-boundary marks and around line feeds. That no
piece of the vocabulary crosses these places is tested when the model is loaded; otherwise whole texts are chunks.
Distinct chunks are encoded once and remembered, up to ``CACHE`` chunks per worker.

Short chunks of equal length go through the agenda together as rows of an array: each step merges every row's best
pair, so that all rows stay equally long. Longer ones use a heap.

Null text: encoded as the empty text (no ids, decoded to ''). Very long texts are slices of their own. Pairs of equal
score are merged from the left. Other columns pass through unless they are named
``ids`` or ``decoded``, which are replaced. Repeated rows stay repeated; an empty table gives an empty table.
"""

from __future__ import annotations

import gc
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.llm.common import portions

CACHE = 500_000
SHORT = 48  # characters up to which chunks share an array
MARK = "▁"


def packed(ids) -> bytes:
    return np.fromiter(ids, "<i4").tobytes()


_loaded: dict[str, "Pieces"] = {}


class Pieces:
    """The vocabulary of a merge-type model, its pair table and the remembered chunks."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.piece = {sp.id_to_piece(i): i for i in normal}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(sp.is_unused(i) for i in range(n)) or sp.encode("a  b ") == sp.encode("a b"):
            raise ValueError("only models without unused pieces that keep white space are handled")
        single = sorted({c for p in self.piece for c in p})
        self.symbol = dict(self.piece)
        for c in single:  # characters that occur in pieces only
            self.symbol.setdefault(c, n + len(self.symbol))
        self.score = {i: sp.get_score(i) for i in normal}
        keys, merged = [], []
        for p, i in self.piece.items():
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is not None and b is not None:
                    keys.append((a << 20) | b)
                    merged.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        self.pairs = dict(zip(self.keys.tolist(), self.merged.tolist(), strict=True))
        self.scores = np.full(n + 1, -np.inf)
        for i in normal:
            self.scores[i] = self.score[i]
        code = np.array([ord(c) for c in single], np.int64)
        self.code, self.of_code = code, np.array([self.symbol[c] for c in single], np.int64)
        cuts = not any(MARK in p.lstrip(MARK) or "\n" in p for p in self.piece)
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if cuts else "(?s).+")
        self.cuts = cuts
        self.words: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ids that pairs merge to; the id past the last where there is none."""
        k = (a << 20) | b
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where((self.keys[at] == k) & (a >= 0) & (b >= 0), self.merged[at], len(self.scores) - 1)

    def by_heap(self, chunk: str) -> list[int]:
        """One chunk, its pairs on a heap by falling score and rising place."""
        s = [self.symbol.get(c, -1) for c in chunk]
        left, right, alive = list(range(-1, len(s) - 1)), list(range(1, len(s) + 1)), [True] * len(s)
        heap: list[tuple[float, int, int, int, int]] = []

        def add(i: int, j: int) -> None:
            if i >= 0 and j < len(s) and s[i] >= 0 and s[j] >= 0 and (m := self.pairs.get((s[i] << 20) | s[j])) is not None:
                heapq.heappush(heap, (-self.score[m], i, s[i], s[j], m))

        for i in range(len(s) - 1):
            add(i, i + 1)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or s[i] != a or j >= len(s) or s[j] != b:
                continue
            s[i], alive[j], right[i] = m, False, right[j]
            if right[j] < len(s):
                left[right[j]] = i
            add(left[i], i)
            add(i, right[i])
        return self._bytes([s[i] for i in range(len(s)) if alive[i]], [chunk[i] for i in range(len(s)) if alive[i]])

    def _bytes(self, symbols: list[int], chars: list[str]) -> list[int]:
        """Symbols that are no pieces become their bytes; a merged symbol is always a piece."""
        out: list[int] = []
        for i, c in zip(symbols, chars, strict=True):
            if 0 <= i < len(self.scores) - 1:
                out.append(i)
            else:
                out.extend(self.byte[b] for b in c.encode())
        return out

    def together(self, chunks: list[str]) -> list[bytes]:
        """Chunks of one length, each step merging the best pair of every row."""
        length = len(chunks[0])
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, length)
        at = np.minimum(np.searchsorted(self.code, codes), len(self.code) - 1)
        sym = np.where(self.code[at] == codes, self.of_code[at], -1 - codes)  # below zero: no piece has this character
        rows = np.arange(len(chunks))
        pair = self._merged(sym[:, :-1], sym[:, 1:])
        out = [b""] * len(chunks)
        none = len(self.scores) - 1

        def put(which: np.ndarray) -> None:
            done, at = sym[which], rows[which]
            raw, k = done.astype("<i4").tobytes(), 4 * sym.shape[1]
            for i, r in enumerate(at.tolist()):
                out[r] = raw[i * k : i * k + k]
            for i in np.flatnonzero(((done < 0) | (done >= none)).any(axis=1)).tolist():
                s = done[i].tolist()
                back = {v: c for c, v in self.symbol.items() if v >= none} if max(s) >= none else {}
                out[at[i]] = packed(self._bytes(s, [chr(-1 - x) if x < 0 else back.get(x, "") for x in s]))

        while sym.shape[1] > 1:
            score = self.scores[pair]
            j = score.argmax(axis=1)
            going = score[np.arange(len(j)), j] > -np.inf
            if not going.all():
                put(np.flatnonzero(~going))
                sym, pair, rows, j = sym[going], pair[going], rows[going], j[going]
                if not len(rows):
                    return out
            n, k = sym.shape
            r = np.arange(n)
            sym[r, j] = pair[r, j]
            keep = np.arange(k - 1)[None, :]
            sym = np.take_along_axis(sym, keep + (keep > j[:, None]), axis=1)
            keep = keep[:, :-1]
            pair = np.take_along_axis(pair, keep + (keep >= j[:, None]), axis=1)
            if k > 2:
                for here in (j - 1, j):
                    ok = np.flatnonzero((here >= 0) & (here < k - 2))
                    pair[ok, here[ok]] = self._merged(sym[ok, here[ok]], sym[ok, here[ok] + 1])
        put(np.arange(len(rows)))
        return out

    def by_library(self, chunks: list[str]) -> list[list[int]]:
        """The library's ids of chunks: those that begin with a mark lose it, for the library adds one; the others
        are put behind a line feed, whose ids and the added mark are then cut."""
        begin = self.sp.encode("\n", num_threads=1)
        given = [c[1:].replace(MARK, " ") if c[0] == MARK and len(c) > 1 else "\n" + c.replace(MARK, " ") for c in chunks]
        ids = self.sp.encode(given, num_threads=1)
        return [x if c[0] == MARK and len(c) > 1 else x[len(begin) :] for c, x in zip(chunks, ids, strict=True)]

    def agenda(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks, compared with the library's."""
        by_length: dict[int, list[int]] = {}
        for i, c in enumerate(chunks):
            by_length.setdefault(min(len(c), SHORT + 1), []).append(i)
        out = [b""] * len(chunks)
        for length, group in by_length.items():
            for k in range(0, len(group), 20_000):
                at = group[k : k + 20_000]
                part = [chunks[i] for i in at]
                ids = [packed(self.by_heap(c)) for c in part] if length > SHORT else self.together(part)
                theirs = self.by_library(part)
                if list(map(len, ids)) != [4 * len(x) for x in theirs] or b"".join(ids) != packed(chain.from_iterable(theirs)):
                    raise AssertionError("the agenda and the library differ: " + repr(next((c, y) for c, x, y in zip(part, ids, theirs, strict=True) if x != packed(y))))
                for i, x in zip(at, ids, strict=True):
                    out[i] = x
        return out

    def _learn(self, words: list[str]) -> None:
        """Remembers words: a word stands for a mark and itself, one behind a line feed for that and itself."""
        feed = packed([self.byte[10]])
        lines = [w for w in words if w[0] == "\n"]
        plain = [w for w in words if w[0] != "\n"]
        self.words.update(zip(plain, self.agenda([MARK + w for w in plain]), strict=True))
        alone = [w for w in lines if len(w) > 1]
        self.words.update((w, feed + x) for w, x in zip(alone, self.agenda([w[1:] for w in alone]), strict=True))
        self.words["\n"] = feed

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Texts whose words stand between single spaces are looked up word by word."""
        split: list[list[str] | None] = []
        wanted: set[str] = set()
        for t in texts:
            x = None
            if t and self.cuts and MARK not in t and t[0] not in " \n" and t[-1] != " " and "  " not in (u := t.replace("\n", " \n")):
                x = u.split(" ")
                wanted.update(x)
            split.append(x)
        missing = wanted.difference(self.words)
        if len(self.words) + len(missing) > CACHE:
            self.words.clear()
            missing = wanted
        if missing:
            self._learn(list(missing))
        get, out = self.words.__getitem__, []
        for t, x in zip(texts, split, strict=True):
            if x is None:
                cut = self.chunks(t)
                known = list(set(cut))
                raw = b"".join(map(dict(zip(known, self.agenda(known), strict=True)).__getitem__, cut))
            else:
                raw = b"".join(map(get, x))
            out.append(np.frombuffer(raw, "<i4"))
        return out


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` array<int> and ``decoded`` string (the library's decode of these ids)."""
    keep = [c for c in docs.columns if c not in ("ids", "decoded", "_piece_text")]
    given = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_piece_text"))
    schema = given.drop("_piece_text").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    def run(batches):
        p = pieces(model)
        gc.disable()  # millions of small lists without cycles
        for whole in batches:
            for b in portions(whole, whole.num_columns - 1):
                ids = p.encode(b.column(b.num_columns - 1).to_pylist())
                decoded = [p.sp.decode(x.tolist()) if len(x) else "" for x in ids]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)
                cols = [*b.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "ids", "decoded"])

    return given.mapInArrow(run, schema)
