"""Motion-JPEG in AVI as a media column.

Bytes become 8-bit grey samples of 24 x 24 intra frames, each a lossless JPEG (SOF3, predictor 1) in a
``00dc`` chunk of an AVI with an ``idx1`` index. Reading goes by the RIFF structure and its index, decodes the entropy-coded data of many
frames in step, and detects shots: a frame begins one where its grey histogram's distance from that of the frame before
stands out from the distances around it. Shots are rows of clips with times.

Nulls and the like: a null or empty text is one frame of padding; equal texts give equal files; repeated rows come
out as often as they came in; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import as_bytes, record_batch, tune

SIDE, PIXELS, RATE = 24, 576, 25
#: Frames coded at a time.
FRAMES = 2048
# Code lengths of the difference categories 0 to 8.
CODE_LENGTHS = {4: 2, 7: 2, 3: 3, 5: 3, 0: 4, 1: 4, 2: 4, 6: 5, 8: 6}


def canonical(symbols: list[int], lengths: list[int]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length), in the order of a JPEG table."""
    out, code, size = {}, 0, lengths[0] if lengths else 0
    for s, n in zip(symbols, lengths, strict=True):
        code <<= n - size
        out[s], size = (code, n), n
        code += 1
    return out


_ORDER = sorted(CODE_LENGTHS, key=lambda s: (CODE_LENGTHS[s], s))
_CODES = canonical(_ORDER, [CODE_LENGTHS[s] for s in _ORDER])
_DHT = bytes([0, *(sum(n == k for n in CODE_LENGTHS.values()) for k in range(1, 17)), *_ORDER])
HEADER = (
    b"\xff\xd8"
    + b"\xff\xc3" + struct.pack(">HBHHBBBB", 11, 8, SIDE, SIDE, 1, 1, 0x11, 0)
    + b"\xff\xc4" + struct.pack(">H", 2 + len(_DHT)) + _DHT
    + b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0, 1, 0, 0)
)
_DIFF = np.arange(-255, 256)
_CATEGORY = np.array([int(abs(d)).bit_length() for d in _DIFF])
_WIDTH = np.array([_CODES[c][1] + c for c in _CATEGORY.tolist()], np.int64)
_VALUE = np.array([_CODES[c][0] << c | (d if d >= 0 else d + (1 << c) - 1) for d, c in zip(_DIFF.tolist(), _CATEGORY.tolist(), strict=True)], np.uint32)


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """samples (n, 576) uint8 to JPEG files."""
    n = len(samples)
    x = samples.reshape(n, SIDE, SIDE).astype(np.int16)
    d = x.copy()
    d[:, :, 1:] -= x[:, :, :-1]
    d[:, 1:, 0] -= x[:, :-1, 0]
    d[:, 0, 0] -= 128
    d = d.reshape(n, PIXELS) + 255
    width, value = _WIDTH[d], _VALUE[d]
    ends = np.cumsum(width, 1)
    size = (ends[:, -1] + 7) // 8
    base = np.concatenate([[0], np.cumsum(size)])
    at = (ends - width + base[:-1, None] * 8).ravel()
    word = value.ravel().astype(np.uint64) << (24 - width.ravel() - (at & 7)).astype(np.uint64)
    byte = at >> 3
    out = np.zeros(base[-1] + 3)
    for k in range(3):
        out[: base[-1] + k] += np.bincount(byte + k, weights=(word >> np.uint64(16 - 8 * k) & np.uint64(255)).astype(np.float64), minlength=base[-1] + k)[: base[-1] + k]
    raw = out[: base[-1]].astype(np.uint8)
    spare = size * 8 - ends[:, -1]
    raw[base[1:] - 1] |= ((1 << spare) - 1).astype(np.uint8)  # the last byte is filled with ones
    full = np.flatnonzero(raw == 255)
    raw = np.insert(raw, full + 1, 0)
    cut = base + np.searchsorted(full, base, "left")
    data = raw.tobytes()
    return [b"".join((HEADER, data[a:b], b"\xff\xd9")) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def parse_header(frame: bytes) -> tuple[int, int, int, dict[int, tuple[int, int]]]:
    """Of a lossless grey JPEG: where the entropy-coded data begin, height, width, Huffman codes."""
    if frame[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, height, width, codes = 2, 0, 0, {}
    while True:
        marker, size = struct.unpack_from(">HH", frame, at)
        body = frame[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFFC3:
            precision, height, width, components = struct.unpack_from(">BHHB", body)
            if precision != 8 or components != 1:
                raise ValueError("only 8-bit grey frames are read")
        elif marker == 0xFFC4:
            counts = body[1:17]
            codes = canonical(list(body[17 : 17 + sum(counts)]), [n for n, k in enumerate(counts, 1) for _ in range(k)])
        elif marker == 0xFFDA:
            if body[-3] != 1:
                raise ValueError("only predictor 1 is read")
            return at, height, width, codes
        elif not 0xFFE0 <= marker <= 0xFFFE:
            raise ValueError(f"marker {marker:x}")


_tables: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}


def _table(codes: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """By the next 16 bits: difference, and bits taken."""
    key = tuple(sorted(codes.items()))
    if key not in _tables:
        diff, took = np.zeros(1 << 16, np.int16), np.ones(1 << 16, np.int64)
        for c, (code, n) in codes.items():
            if n + c > 16:
                raise ValueError("codes too long")
            extra = np.arange(1 << c)
            d = np.where(extra >> (c - 1) & 1, extra, extra - (1 << c) + 1) if c else np.zeros(1, int)
            spare = 16 - n - c
            for e, v in zip(extra.tolist(), d.tolist(), strict=True):
                a = (code << c | e) << spare
                diff[a : a + (1 << spare)], took[a : a + (1 << spare)] = v, n + c
        _tables[key] = diff, took
    return _tables[key]


def decode_frames(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Frames at places in data, all with the first one's header, to samples (n, pixels) uint8."""
    head, height, width, codes = parse_header(data[start[0] : start[0] + size[0]].tobytes())
    if (data[start[:, None] + np.arange(head)] != data[start[0] : start[0] + head]).any():
        raise ValueError("frames of one file have one header")
    diff, took = _table(codes)
    a, n = start + head, size - head - 2
    ends = np.cumsum(n)
    flat = data[np.repeat(a - (ends - n), n) + np.arange(ends[-1])]
    stuffed = np.zeros(len(flat), bool)
    stuffed[1:] = (flat[1:] == 0) & (flat[:-1] == 255)
    gone = np.concatenate([[0], np.cumsum(stuffed)])
    begin = (ends - n) - gone[ends - n]
    flat = np.concatenate([flat[~stuffed], np.zeros(4, np.uint8)]).astype(np.uint32)
    word = flat[:-3] << 16 | flat[1:-2] << 8 | flat[2:-1]
    at = begin * 8
    last = len(word) - 1
    d = np.empty((height * width, len(start)), np.int16)
    for k in range(height * width):
        peek = word[np.minimum(at >> 3, last)] >> (8 - (at & 7)).astype(np.uint32) & 0xFFFF
        d[k] = diff[peek]
        at += took[peek]
    x = d.T.reshape(len(start), height, width).astype(np.int16)
    x[:, 0, 0] += 128
    x[:, :, 0] = np.cumsum(x[:, :, 0], 1)
    return (np.cumsum(x, 2) & 255).astype(np.uint8).reshape(len(start), height * width)


def write_avi(frames: list[bytes]) -> bytes:
    def chunk(name: bytes, body: bytes) -> bytes:
        return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)

    n, most = len(frames), max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // RATE, most * RATE, 0, 0x10, n, 0, 1, most, SIDE, SIDE, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, RATE, 0, n, most, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", PIXELS, 0, 0, 0, 0)
    hdrl = chunk(b"LIST", b"hdrl" + chunk(b"avih", avih) + chunk(b"LIST", b"strl" + chunk(b"strh", strh) + chunk(b"strf", strf)))
    sizes = np.array([len(f) for f in frames], np.int64)
    places = 4 + np.concatenate([[0], np.cumsum(sizes + (sizes & 1) + 8)[:-1]])
    index = np.zeros(n, [("id", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")])
    index["id"], index["flags"], index["at"], index["size"] = b"00dc", 0x10, places, sizes
    movi = b"movi" + b"".join(b"00dc" + struct.pack("<I", len(f)) + f + b"\0" * (len(f) & 1) for f in frames)
    body = b"AVI " + hdrl + chunk(b"LIST", movi) + chunk(b"idx1", index.tobytes())
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_index(media: bytes) -> tuple[np.ndarray, np.ndarray, float]:
    """Of an AVI: the video frames' places and sizes by its index, and frames a second."""
    if media[:4] != b"RIFF" or media[8:12] != b"AVI ":
        raise ValueError("not an AVI")
    at, movi, index, rate = 12, 0, None, float(RATE)
    end = min(len(media), 8 + struct.unpack_from("<I", media, 4)[0])
    while at + 8 <= end:
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"LIST" and media[at + 8 : at + 12] == b"movi":
            movi = at + 8
        elif name == b"LIST" and media[at + 8 : at + 12] == b"hdrl":
            rate = 1_000_000 / max(1, struct.unpack_from("<I", media, at + 20)[0])
        elif name == b"idx1":
            index = np.frombuffer(media, [("id", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")], size // 16, at + 8)
        at += 8 + size + (size & 1)
    if index is None or not movi:
        raise ValueError("no index")
    video = index[(index["id"] == b"00dc") & (index["size"] > 0)]
    return video["at"].astype(np.int64) + movi + 8, video["size"].astype(np.int64), rate


def histogram_distances(samples: np.ndarray) -> np.ndarray:
    """Of each frame from the one before, 0 to 1; the first has 0."""
    n, pixels = samples.shape
    h = np.bincount((np.arange(n)[:, None] * 16 + (samples >> 4)).ravel(), minlength=16 * n).reshape(n, 16)
    out = np.zeros(n)
    out[1:] = np.abs(np.diff(h, axis=0)).sum(1) / (2 * pixels)
    return out


def shots(distance: np.ndarray, reach: int = 12, factor: float = 2.5, least: float = 0.08) -> list[tuple[int, int]]:
    """First and last frame of each shot: a cut is where the distance exceeds least and the mean of its neighbours within reach
    by factor deviations."""
    n = len(distance)
    s, q = np.concatenate([[0], np.cumsum(distance)]), np.concatenate([[0], np.cumsum(distance**2)])
    a, b = np.maximum(1, np.arange(n) - reach), np.minimum(n, np.arange(n) + reach + 1)
    m = np.maximum(1, b - a - 1)
    mean = (s[b] - s[a] - distance) / m
    deviation = np.sqrt(np.maximum(0, (q[b] - q[a] - distance**2) / m - mean**2))
    cut = (distance > least) & (distance > mean + factor * deviation + 1e-12)
    cut[0] = True
    first = np.flatnonzero(cut)
    return list(zip(first.tolist(), np.append(first[1:] - 1, n - 1).tolist(), strict=True))


def store(text: bytes) -> bytes:
    size = max(PIXELS, -(-len(text) // PIXELS) * PIXELS)
    samples = np.full(size, 255, np.uint8)
    samples[: len(text)] = np.frombuffer(text, np.uint8)
    samples = samples.reshape(-1, PIXELS)
    frames: list[bytes] = []
    for i in range(0, len(samples), FRAMES):
        frames += encode_frames(samples[i : i + FRAMES])
    return write_avi(frames)


def _stores(texts: list[bytes]) -> list[bytes]:
    """As store(), frames of many texts coded together."""
    counts = [max(1, -(-len(t) // PIXELS)) for t in texts]
    samples = np.full(sum(counts) * PIXELS, 255, np.uint8)
    at = 0
    for t, n in zip(texts, counts, strict=True):
        samples[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += n * PIXELS
    samples = samples.reshape(-1, PIXELS)
    frames: list[bytes] = []
    for i in range(0, len(samples), FRAMES):
        frames += encode_frames(samples[i : i + FRAMES])
    out, at = [], 0
    for n in counts:
        out.append(write_avi(frames[at : at + n]))
        at += n
    return out


def decode(media: list[bytes]) -> list[tuple[np.ndarray, float]]:
    """Samples (frames, pixels) and frames a second of AVI files whose frames share their header."""
    found = [read_index(m) for m in media]
    base = np.concatenate([[0], np.cumsum([len(m) for m in media])])
    data = np.frombuffer(b"".join(media), np.uint8)
    start = np.concatenate([p + b for (p, _, _), b in zip(found, base.tolist(), strict=False)])
    size = np.concatenate([s for _, s, _ in found])
    parts = [decode_frames(data, start[i : i + FRAMES], size[i : i + FRAMES]) for i in range(0, len(start), FRAMES)]
    samples = np.concatenate(parts)
    out, at = [], 0
    for p, _, rate in found:
        out.append((samples[at : at + len(p)], rate))
        at += len(p)
    return out


def _groups(texts: list[bytes], limit: int = 2 << 20):
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t) + PIXELS
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def to_media(docs: DataFrame) -> DataFrame:
    """docs(key, text, more...) -> key, n_bytes, media; more is left out."""
    tune(docs.sparkSession)
    key, text = docs.columns[:2]
    docs = docs.select(key, F.col(text).cast("binary").alias(text))

    def run(batches):
        for b in batches:
            at = 0
            for texts in _groups(as_bytes(b.column(1))):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array([len(t) for t in texts], pa.int64()), pa.array(_stores(texts), pa.binary())], names=[key, "n_bytes", "media"])
                at += len(texts)

    return docs.mapInArrow(run, docs.select(key, F.lit(0).cast("long").alias("n_bytes"), F.lit(b"").cast("binary").alias("media")).schema)


def clips(media: DataFrame) -> DataFrame:
    """(key, media, more...) -> key, clip, first_frame, last_frame, start_s, end_s."""
    key, column = media.columns[:2]
    media = media.select(key, column)
    schema = media.select(key, *(F.lit(0).cast(t).alias(n) for n, t in (("clip", "int"), ("first_frame", "long"), ("last_frame", "long"), ("start_s", "double"), ("end_s", "double")))).schema

    def run(batches):
        for b in batches:
            for i, m in enumerate(b.column(1).to_pylist()):
                if not m:
                    continue
                ((samples, rate),) = decode([m])
                rows = shots(histogram_distances(samples))
                x = np.array(rows, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([i] * len(rows))), pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(x[:, 0] / rate), pa.array((x[:, 1] + 1) / rate)], names=schema.names
                )

    return media.mapInArrow(run, schema)


def features(media: DataFrame) -> DataFrame:
    """(key, n_bytes, media) -> the digest of what the stored files hold. feature: frames, shots, their first frames' times and mean
    grey levels."""
    key = media.columns[0]
    names = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
    out = pa.schema(names)

    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for files in _groups(b.column(2).to_pylist()):
                for m, (samples, rate) in zip(files, decode(files), strict=True):
                    payload = samples.tobytes()
                    cuts = shots(histogram_distances(samples))
                    said = ";".join(f"{i / rate:.2f}-{(j + 1) / rate:.2f}:{samples[i : j + 1].mean():.1f}" for i, j in cuts)
                    rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), f"frames={len(samples)};shots={len(cuts)};{said}"))
            if rows:
                made = record_batch(out, *(list(c) for c in zip(*rows, strict=True)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made.columns], names=[key, "n_bytes", *out.names])

    return media.mapInArrow(run, media.select(key, "n_bytes", *(F.lit(0).cast("string" if t == pa.string() else "long").alias(n) for n, t in names)).schema)
