"""MPEG audio as a media column: lossless carriage of bytes in Layer III frames, and a reader of any MPEG audio stream.

``store`` writes a stream for each row: an ID3v2.4 tag, a Xing table (frames, bytes, 100 seek points) and frames of
MPEG-1 Layer III, 48 kHz, mono, each with its CRC-16. The side information says that no granule has coded samples, so
a decoder plays silence and the rest of a frame is ancillary data, which carries the payload: the text's UTF-8 bytes and
zeros up to a positive multiple of 64. All frames have the highest bit rate but the last, which has the lowest that
holds the rest, so the stream's rate varies.

``read`` finds frames in any stream: it parses ID3v2 and ID3v1 tags and Xing, Info and VBRI tables, follows frame
lengths, searches for the next header that a second one confirms when a header is wrong, verifies the CRC of frames
that have one (Layer III; the CRC of Layers I and II covers bit allocation that is not decoded here and isn't checked),
and returns exact numbers of samples, the duration as samples over rate, and the offset of every frame.

Null text or stream: as empty (a payload of 64 zeros; no frames). Other columns pass through; columns of the names
that an operator adds are replaced. Equal texts give equal streams.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by (version 1, layer) or (version 2, layer), Hz by version.
KBPS = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HZ = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}
UNIT = 64
SIDE = 17  # bytes of side information, MPEG-1 mono
HEAD = 4 + 2 + SIDE


def crc16(data: bytes) -> int:
    """CRC-16 with polynomial 0x8005, start 0xFFFF, high bit first."""
    c = 0xFFFF
    for b in data:
        c ^= b << 8
        for _ in range(8):
            c = ((c << 1) ^ 0x8005 if c & 0x8000 else c << 1) & 0xFFFF
    return c


crc16_known = lru_cache(4096)(crc16)


@lru_cache(8192)
def header(h: bytes) -> tuple[int, int, int, float, int, bool, int] | None:
    """Length, samples, rate, version, layer, whether a CRC follows, channels; None if these bytes begin no frame."""
    if len(h) < 4 or h[0] != 0xFF or h[1] & 0xE0 != 0xE0:
        return None
    version, layer = {0: 2.5, 2: 2, 3: 1}.get(h[1] >> 3 & 3), 4 - (h[1] >> 1 & 3)
    rate, hz = h[2] >> 4, h[2] >> 2 & 3
    if version is None or layer == 4 or rate in (0, 15) or hz == 3 or h[3] & 3 == 2:
        return None
    bits, hz = KBPS[min(2, int(version)), layer][rate - 1] * 1000, HZ[version][hz]
    samples = 384 if layer == 1 else 576 if layer == 3 and version != 1 else 1152
    pad = h[2] >> 1 & 1
    length = (12 * bits // hz + pad) * 4 if layer == 1 else samples // 8 * bits // hz + pad
    return length, samples, hz, version, layer, not h[1] & 1, 1 if h[3] >> 6 == 3 else 2


def tag(fields: dict[str, str]) -> bytes:
    """An ID3v2.4 tag of user-defined text frames."""
    seven = lambda n: bytes(n >> s & 127 for s in (21, 14, 7, 0))
    frames = b""
    for k, v in fields.items():
        body = b"\3" + k.encode() + b"\0" + v.encode()
        frames += b"TXXX" + seven(len(body)) + b"\0\0" + body
    return b"ID3\4\0\0" + seven(len(frames)) + frames


@lru_cache(16)
def _start(kbps: int) -> bytes:
    h = bytes([0xFF, 0xFA, (KBPS[1, 3].index(kbps) + 1) << 4 | 1 << 2, 0xC0])
    return h + struct.pack(">H", crc16(h[2:] + bytes(SIDE))) + bytes(SIDE)


def stream(data: bytes) -> bytes:
    """The MPEG stream that carries ``data``, padded."""
    payload = data + bytes(-len(data) % UNIT or (0 if data else UNIT))
    full = 3 * 320 - HEAD
    frames = [_start(320) + payload[i : i + full] for i in range(0, len(payload) - full + 1, full)]
    if rest := len(payload) % full:
        kbps = next(k for k in KBPS[1, 3] if 3 * k - HEAD >= rest)
        frames.append(_start(kbps) + payload[len(payload) - rest :] + bytes(3 * kbps - HEAD - rest))
    first = 3 * 64
    ends, total = [], first
    for f in frames:
        ends.append(total)
        total += len(f)
    toc = bytes(min(255, 256 * ends[len(frames) * i // 100] // total) for i in range(100))
    xing = bytes([0xFF, 0xFB, 5 << 4 | 1 << 2, 0xC0]) + bytes(SIDE) + b"Xing" + struct.pack(">III", 7, len(frames), total) + toc
    return tag({"bytes": str(len(data)), "payload": str(len(payload))}) + xing + bytes(first - len(xing)) + b"".join(frames)


_sync = re.compile(rb"\xff[\xe2-\xff]")


def parse(s: bytes) -> dict:
    """Tags, tables, frames and the ancillary payload of a stream."""
    out: dict = {"tags": {}, "vbr": "", "skipped": 0, "crc_checked": 0, "crc_bad": 0, "samples": 0, "rate": 0, "seek": [], "kinds": set()}
    at, end, body = 0, len(s), []
    while s[at : at + 3] == b"ID3" and at + 10 <= end:
        size = s[at + 6] << 21 | s[at + 7] << 14 | s[at + 8] << 7 | s[at + 9]
        i, stop = at + 10, min(end, at + 10 + size)
        while i + 10 <= stop and s[i : i + 4].isalnum():
            n = s[i + 4] << 21 | s[i + 5] << 14 | s[i + 6] << 7 | s[i + 7] if s[at + 3] == 4 else int.from_bytes(s[i + 4 : i + 8], "big")
            name, _, value = s[i + 11 : i + 10 + n].partition(b"\0")
            if s[i : i + 4] == b"TXXX":
                out["tags"][name.decode("utf-8", "replace")] = value.decode("utf-8", "replace")
            i += 10 + n
        at += 10 + size + 10 * bool(s[at + 5] & 16)
    if end - at >= 128 and s[end - 128 : end - 125] == b"TAG":
        out["tags"]["title"] = s[end - 125 : end - 95].rstrip(b"\0 ").decode("latin-1")
        end -= 128
    first = True
    while at + 4 <= end:
        h = header(s[at : at + 4])
        if h is None or at + h[0] > end:
            nxt = at + 1
            while (m := _sync.search(s, nxt, end)) is not None:
                nxt = m.start()
                g = header(s[nxt : nxt + 4])
                if g and nxt + g[0] <= end and (nxt + g[0] == end or header(s[nxt + g[0] : nxt + g[0] + 4])):
                    break
                nxt += 1
            out["skipped"] += (nxt if m else end) - at
            if m is None:
                at = end
                break
            at = nxt
            continue
        length, samples, hz, version, layer, crc, channels = h
        side = (17 if channels == 1 else 32) if version == 1 else (9 if channels == 1 else 17)
        if first and layer == 3:
            first = False
            x = at + 4 + side
            if s[x : x + 4] in (b"Xing", b"Info"):
                flags, i = int.from_bytes(s[x + 4 : x + 8], "big"), x + 8
                counts = []
                for bit in (1, 2):
                    counts.append(int.from_bytes(s[i : i + 4], "big") if flags & bit else -1)
                    i += 4 * bool(flags & bit)
                toc = s[i : i + 100] if flags & 4 else b""
                out["vbr"] = f"{s[x : x + 4].decode().lower()}:{counts[0]}:{counts[1]}:{len(toc)}"
                at += length
                continue
            x = at + 4 + 32
            if s[x : x + 4] == b"VBRI":
                out["vbr"] = f"vbri:{int.from_bytes(s[x + 14 : x + 18], 'big')}:{int.from_bytes(s[x + 10 : x + 14], 'big')}:{int.from_bytes(s[x + 18 : x + 20], 'big')}"
                at += length
                continue
        out["seek"].append(at)
        out["samples"] += samples
        out["rate"] = out["rate"] or hz
        out["kinds"].add((version, layer))
        if layer == 3:
            b = at + 4 + 2 * crc
            if crc:
                out["crc_checked"] += 1
                out["crc_bad"] += crc16_known(s[at + 2 : at + 4] + s[b : b + side]) != int.from_bytes(s[at + 4 : at + 6], "big")
            body.append(s[b + side : at + length])
        at += length
    out["skipped"] += max(0, end - at)
    data = b"".join(body)
    out["payload"] = data[: int(out["tags"]["payload"])] if out["tags"].get("payload", "").isdigit() else data
    return out


def _with(df: DataFrame, column, schema: list[T.StructField], make, batch: int) -> DataFrame:
    names = {f.name for f in schema}
    keep = [c for c in df.columns if c not in names]
    given = df.select(*keep, column.alias("_bytes"))
    out = T.StructType([*given.schema.fields[:-1], *schema])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                b = whole.slice(at, batch)
                cols = make(b.column(b.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names=[*keep, *[f.name for f in schema]])

    return given.mapInArrow(run, out)


def store(docs: DataFrame, text: str = "text", batch: int = 256) -> DataFrame:
    """``docs`` with the binary column ``media``."""
    return _with(docs, F.coalesce(F.col(text).cast("binary"), F.lit(b"")), [T.StructField("media", T.BinaryType())], lambda x: [pa.array(list(map(stream, x)), pa.binary())], batch)


READ = [
    T.StructField("payload", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_frames", T.LongType()), T.StructField("samples", T.LongType()),
    T.StructField("rate", T.IntegerType()), T.StructField("duration_s", T.DoubleType()), T.StructField("seek", T.ArrayType(T.LongType())), T.StructField("vbr", T.StringType()),
    T.StructField("crc_checked", T.LongType()), T.StructField("crc_bad", T.LongType()), T.StructField("skipped", T.LongType()), T.StructField("kinds", T.StringType()),
]


def _columns(streams: list[bytes]) -> list[pa.Array]:
    got = [parse(s) for s in streams]
    size = [int(x["tags"]["bytes"]) if x["tags"].get("bytes", "").isdigit() else len(x["payload"]) for x in got]
    kinds = [",".join(f"mpeg{v:g}-layer{k}" for v, k in sorted(x["kinds"])) for x in got]
    return [
        pa.array([x["payload"] for x in got], pa.binary()), pa.array(size, pa.int64()), pa.array([len(x["seek"]) for x in got], pa.int64()), pa.array([x["samples"] for x in got], pa.int64()),
        pa.array([x["rate"] for x in got], pa.int32()), pa.array([x["samples"] / x["rate"] if x["rate"] else 0.0 for x in got], pa.float64()), pa.array([x["seek"] for x in got], pa.list_(pa.int64())), pa.array([x["vbr"] for x in got], pa.string()),
        pa.array([x["crc_checked"] for x in got], pa.int64()), pa.array([x["crc_bad"] for x in got], pa.int64()), pa.array([x["skipped"] for x in got], pa.int64()), pa.array(kinds, pa.string()),
    ]


def read(df: DataFrame, media: str = "media", batch: int = 256) -> DataFrame:
    """``df`` with what its streams hold: payload, unpadded size, frames, samples, rate, duration, frame offsets, ..."""
    return _with(df, F.coalesce(F.col(media), F.lit(b"")), READ, _columns, batch)
