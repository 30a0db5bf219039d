"""Removal of repeated byte strings by a distributed merge of sorted suffix runs.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id. Every window of that length has
an anchor: of its k-grams the one with the least hash, the leftmost of equals. Equal windows have equal anchors at equal places, so suffixes need
sorting only from anchors, about one byte in eighteen.

1. A task compares the reaches of its own anchors, the bytes that all windows with an anchor cover. Where a reach repeats, byte by byte, one of a smaller document,
   every window of it is repeated; only the first document of each reach, its head, is sent on, so a passage in every document is sent once by each task.
   Heads travel as hashes of their k-grams, which say no more than whose suffixes have to be sorted: those whose k-gram heads several documents' reaches.
2. The suffixes of these are taken from the texts, sorted and front-coded into runs, exchanged, and merged by loser trees that compare from known common
   prefixes on only. From the common prefixes to the right, and of the mirrored text to the left, follows which windows are equal, and the smallest
   document of each.
3. Documents meet the spans that are to go.

Documents and what concerns them meet in blocks, dealt by a hash of id and text; anchors in buckets, dealt by the k-gram's hash. Their numbers
follow the bytes of the corpus alone, and a task sends what it has for one block or bucket together, so rows never outnumber the spans and anchors in them. The
suffixes of a k-gram with more than HOT heads are dealt by more than the k-gram: windows that begin in the near half before their anchor by the bytes after the
k-gram too, the others by the bytes before it.

Nulls and the like: a null text is empty; documents shorter than the window lose nothing; a row without an id neither takes nor loses
anything; rows that repeat an id don't take from each other, and come out as often as they came in. Columns of docs beside the first two may have
any names; ids are read as long integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import groups, joined, pack, record_batch, shuffle_partitions, staged, trim, tune, unpack

K = 16
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_DOWN = pow(_BASE, -1, 1 << 64)
#: Bytes of text worked on at a time, anchors that a task holds before it sends them, bytes of text to a block and to a bucket.
CHUNK, HELD, BLOCK, BUCKET = 1 << 19, 1 << 18, 8 << 20, 4 << 20
#: Heads of a k-gram beyond which its suffixes are dealt by more than the k-gram.
HOT = 1 << 14
#: What travels of a hash: 48 bits of a k-gram's.
_KEPT = _U(0xFFFFFFFFFFFF0000)
_ENTRY = np.dtype([("gram", "<u8"), ("doc", "<i8"), ("row", "<i8"), ("pos", "<u4"), ("left", "u1"), ("right", "u1")])
_SPAN = np.dtype([("doc", "<i8"), ("row", "<i8"), ("start", "<u4"), ("end", "<u4")])
_NEED = np.dtype([("doc", "<i8"), ("row", "<i8"), ("pos", "<u4"), ("left", "u1"), ("right", "u1"), ("hot", "u1")])
_ROUTED = pa.schema([("route", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
_ROUTED_DDL = "route long, kind int, payload binary"
ENTRIES, SPANS, NEEDS, RUNS = range(4)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> _U(33)) * _U(0xFF51AFD7ED558CCD)
    return x ^ x >> _U(29)


def anchors(data: np.ndarray, at: np.ndarray, length: int, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts on end: document, anchor, first and last window start of each run of windows with one anchor, hashes of its k-gram and its reach."""
    n, w = len(data), length - K + 1
    words = np.ndarray((n - 7,), "<u8", data, strides=(1,))
    h = _mix(words[: n - K + 1] * _U(0x9FB21C651E98DF25)) + words[8 : n - K + 9] * _U(0xC2B2AE3D27D4EB4F)
    h = _mix(h)
    least = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= w:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(least) - (w - size)], least[w - size :])
    pick = (least & _U(0xFFFFFFFF)).astype(np.int64)
    # Window starts that lie whole in a document.
    good = np.zeros(len(pick) + 1, np.int32)
    a, b = at[:-1], at[1:] - length + 1
    some = b > a
    np.add.at(good, a[some], 1)
    np.add.at(good, b[some], -1)
    s = np.flatnonzero(np.cumsum(good[:-1]) > 0)
    p = pick[s]
    new = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)]))
    first, last, p = s[new], s[np.append(new[1:], len(s)) - 1], p[new]
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    reach = (sums[last + w] - sums[first]) * down[first]
    reach = _mix(reach + ((p - first) << 8 | (last - first)).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    # An anchor's hash is the least of many, so it is mixed once more before it deals out buckets.
    gram = _mix(h[p] * _U(0xD6E8FEB86659FD93))
    return np.searchsorted(at, first, "right") - 1, p, first, last, gram & _KEPT, reach


def _runs(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Where groups of equal keys begin in an order."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        x = k[order]
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _settle(e: np.ndarray, reach: np.ndarray, at: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose k-grams lie in data at places at: those that head their reach, and the spans that the others lose."""
    order = np.lexsort((e["doc"], reach, e["gram"]))
    e, reach, at = e[order], reach[order], at[order]
    start = _runs(np.arange(len(e)), e["gram"], reach)
    first = np.repeat(start, np.diff(np.append(start, len(e))))
    lost = np.flatnonzero(e["doc"] != e["doc"][first])
    steps, same = np.arange(2 * length - K), []
    for i in range(0, len(lost), 1 << 15):
        x = lost[i : i + (1 << 15)]
        size = e["left"][x].astype(np.int64) - e["right"][x] + length
        inside = steps < size[:, None]
        mine, other = (np.where(inside, data[np.minimum((at[y] - e["left"][y])[:, None] + steps, len(data) - 1)], 0) for y in (x, first[x]))
        same.append((mine == other).all(1) & (e["left"][x] == e["left"][first[x]]) & (e["right"][x] == e["right"][first[x]]))
    if same:
        lost = lost[np.concatenate(same)]
    head = np.ones(len(e), bool)
    head[lost] = False
    lost = e[lost]
    spans = np.empty(len(lost), _SPAN)
    spans["doc"], spans["row"] = lost["doc"], lost["row"]
    spans["start"], spans["end"] = lost["pos"] - lost["left"], lost["pos"] - lost["right"] + np.uint32(length)
    return e[head], spans


def _block(doc: np.ndarray, row: np.ndarray, blocks: int) -> np.ndarray:
    return ((_mix(doc.view(np.uint64) * _U(_BASE) + row.view(np.uint64)) >> _U(32)) * _U(blocks) >> _U(32)).astype(np.int64)


def _by_route(x: np.ndarray, route: np.ndarray, kind: int) -> Iterator[tuple[int, int, bytes]]:
    if len(x):
        order = np.argsort(route, kind="stable")
        start = _runs(order, route)
        for a, b in zip(start.tolist(), np.append(start[1:], len(x)).tolist(), strict=True):
            yield int(route[order[a]]), kind, pack(x[order[a:b]])


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return record_batch(_ROUTED, *(list(c) for c in zip(*rows, strict=True)))


def _send_anchors(length: int, buckets: int, blocks: int):
    def run(batches):
        up, down = np.full(CHUNK + 1, _BASE, np.uint64), np.full(CHUNK + 1, _DOWN, np.uint64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up), np.cumprod(down)
        held: list[tuple] = []

        def send():
            base = np.cumsum([0, *(len(h[3]) for h in held)])
            e, spans = _settle(*(np.concatenate([h[k] + base[i] if k == 2 else h[k] for i, h in enumerate(held)]) for k in range(4)), length)
            held.clear()
            rows = list(_by_route(e, ((e["gram"] >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64), ENTRIES))
            # Settled spans go the same way; the bucket's task hands them on to their block.
            block = _block(spans["doc"], spans["row"], blocks)
            rows += [(r % buckets, k, r.to_bytes(8, "little") + b) for r, k, b in _by_route(spans, block, SPANS)]
            del e, spans
            for i in range(0, len(rows), 500):
                yield _batch(rows[i : i + 500])
            rows.clear()
            trim()

        for b in batches:
            if not b.num_rows:
                continue
            data, at = joined(b.column(2))
            doc, row = b.column(0).to_numpy(), b.column(1).to_numpy()
            first = 0
            while first < len(doc):
                last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1)
                part, offsets = data[at[first] : at[last]], at[first : last + 1] - at[first]
                if (np.diff(offsets) >= length).any():
                    if len(part) > len(up) - 1:
                        up, down = np.full(len(part) + 1, _BASE, np.uint64), np.full(len(part) + 1, _DOWN, np.uint64)
                        up[0] = down[0] = 1
                        up, down = np.cumprod(up), np.cumprod(down)
                    part = np.array(part)
                    d, p, s, t, gram, reach = anchors(part, offsets, length, up, down)
                    e = np.empty(len(d), _ENTRY)
                    e["doc"], e["row"], e["gram"] = doc[first + d], row[first + d], gram
                    e["pos"], e["left"], e["right"] = p - offsets[d], p - s, p - t
                    held.append((e, reach, p, part))
                first = last
                if sum(len(h[0]) for h in held) >= HELD:
                    yield from send()
        if held:
            yield from send()

    return run


def _sent(held: list[np.ndarray], blocks: int, kind: int):
    """What a task holds for blocks, as batches."""
    x = np.concatenate(held)
    held.clear()
    rows = list(_by_route(x, _block(x["doc"], x["row"], blocks), kind))
    for i in range(0, len(rows), 500):
        yield _batch(rows[i : i + 500])


def _find_needs(blocks: int):
    def run(batches):
        held: list[np.ndarray] = []
        for _, rows in groups(batches):
            spans = [(int.from_bytes(x[:8], "little"), SPANS, x[8:]) for k, x in rows if k == SPANS]
            for i in range(0, len(spans), 500):
                yield _batch(spans[i : i + 500])
            parts = [unpack(x, _ENTRY) for k, x in rows if k == ENTRIES]
            if parts:
                e = np.concatenate(parts)
                e = e[np.argsort(e["gram"], kind="stable")]
                # k-grams whose heads are of several documents
                start = _runs(np.arange(len(e)), e["gram"])
                size = np.diff(np.append(start, len(e)))
                e = e[np.repeat(np.maximum.reduceat(e["doc"], start) != np.minimum.reduceat(e["doc"], start), size)]
                start = _runs(np.arange(len(e)), e["gram"])
                needs = np.empty(len(e), _NEED)
                for f in _NEED.names[:-1]:
                    needs[f] = e[f]
                size = np.diff(np.append(start, len(e)))
                needs["hot"] = np.repeat(size > HOT, size)
                held.append(needs)
                if sum(map(len, held)) >= HELD:
                    yield from _sent(held, blocks, NEEDS)
        if held:
            yield from _sent(held, blocks, NEEDS)
        trim()

    return run


def front_code(suffixes: list[bytes]) -> tuple[bytes, bytes]:
    """Of a sorted run: the length of each prefix shared with the one before, and the rests on end."""
    shared, rests, before = bytearray(), [], b""
    for s in suffixes:
        n, most = 0, min(len(s), len(before))
        if s[:most] == before[:most]:
            n = most
        else:
            while s[n] == before[n]:
                n += 1
        shared.append(n)
        rests.append(s[n:])
        before = s
    return bytes(shared), b"".join(rests)


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Of sorted runs, each with the prefixes its strings share with those before: (run, place) in order, and the prefix each shares with
    the one before it. A loser tree: players carry the prefix they share with the last winner; the longer shared prefix is the smaller
    string, and equal ones are compared from there on only."""
    k = 1
    while k < len(runs):
        k *= 2
    strings = [r[1] for r in runs] + [[]] * (k - len(runs))
    shared = [r[0] for r in runs] + [[]] * (k - len(runs))
    sizes = [len(s) for s in strings]
    at, now, known = [0] * k, [s[0] if s else None for s in strings], [0] * k
    losers = [0] * k

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix becomes that with the winner."""
        sx, sy = now[x], now[y]
        if sx is None:
            return y, x
        if sy is None:
            return x, y
        hx, hy = known[x], known[y]
        if hx != hy:
            return (x, y) if hx > hy else (y, x)
        most = min(len(sx), len(sy))
        n = hx
        if sx[n:most] == sy[n:most]:
            n = most
            first = len(sx) < len(sy) or len(sx) == len(sy) and x < y
        else:
            while sx[n] == sy[n]:
                n += 1
            first = sx[n] < sy[n]
        if first:
            known[y] = n
            return x, y
        known[x] = n
        return y, x

    def build(node: int) -> int:
        if node >= k:
            return node - k
        won, lost = play(build(2 * node), build(2 * node + 1))
        losers[node] = lost
        return won

    winner = build(1) if k > 1 else 0
    order, prefixes = [], []
    while now[winner] is not None:
        order.append((winner, at[winner]))
        prefixes.append(known[winner])
        i = at[winner] = at[winner] + 1
        if i < sizes[winner]:
            now[winner], known[winner] = strings[winner][i], shared[winner][i]
        else:
            now[winner], known[winner] = None, 0
        node = (winner + k) >> 1
        while node:
            won, lost = play(winner, losers[node])
            losers[node], winner = lost, won
            node >>= 1
    return order, prefixes


def _meet_documents(begin):
    """Rows (route, kind, payload, doc, row) sorted by route and kind, documents last: gives what begin() makes for the task the payloads
    of each block and then the documents' batches."""

    def run(batches):
        now, held, met, work = None, [], False, begin()
        for b in batches:
            if not b.num_rows:
                continue
            route, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            mark = route * 2 + (kind == 9)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(mark)) + 1, [len(mark)]])
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = b.slice(i, j - i)
                if route[i] != now:
                    now, held, met = int(route[i]), [], False
                if kind[i] == 9:
                    if not met:
                        work.block(held)
                        met = True
                    yield from work.documents(part)
                else:
                    held += list(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True))
        yield from work.end()
        trim()

    return run


def _table(parts: list[np.ndarray], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Rows by document: sorted, and where each document's begin as structured keys."""
    x = np.concatenate(parts) if parts else np.empty(0, kind)
    x = x[np.lexsort((x["row"], x["doc"]))]
    return x, _runs(np.arange(len(x)), x["doc"], x["row"])


class _Contexts:
    """Takes the needed suffixes out of the documents; sends them as front-coded runs, one for each bucket of those it holds."""

    def __init__(self, length: int, buckets: int):
        self.length, self.buckets = length, buckets
        self.half = (length - K + 1) // 2
        self.rows: list[tuple] = []

    def block(self, held):
        x, start = _table([unpack(p, _NEED) for k, p in held if k == NEEDS], _NEED)
        ends = np.append(start[1:], len(x))[: len(start)]
        self.of = {(d, r): x[a:b] for d, r, a, b in zip(x["doc"][start].tolist(), x["row"][start].tolist(), start.tolist(), ends.tolist(), strict=True)}

    def documents(self, b):
        for doc, row, packed in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(2).to_pylist(), strict=True):
            got = self.of.pop((doc, row), None)  # of rows alike in id and text one is enough
            if got is not None:
                text = zstandard.decompress(packed)
                for p, a, c, hot in zip(got["pos"].tolist(), got["left"].tolist(), got["right"].tolist(), got["hot"].tolist(), strict=True):
                    if hot:
                        # Windows that begin near the anchor have the bytes after the k-gram in common, the others those before it.
                        near = min(a, self.half - 1)
                        if c <= near:
                            self.rows.append((text[p : p + self.length - c], text[p - near : p], doc, row, p, near, c, text[p : p + self.length - self.half + 1]))
                        if a >= self.half:
                            far = max(c, self.half)
                            self.rows.append((text[p : p + self.length - far], text[p - a : p], doc, row, p, a, far, text[p - self.half : p + K]))
                    else:
                        self.rows.append((text[p : p + self.length - c], text[p - a : p], doc, row, p, a, c, None))
                if len(self.rows) >= HELD // 4:
                    yield from self.end()

    def end(self):
        if not self.rows:
            return
        rows = sorted(self.rows, key=lambda r: r[0])
        self.rows.clear()
        grams = np.frombuffer(b"".join(r[0][:K] for r in rows), "<u8").reshape(-1, 2)
        key = _mix(grams[:, 0] * _U(_BASE) + grams[:, 1])
        for i, r in enumerate(rows):
            if r[7] is not None:
                key[i] = xxhash.xxh64_intdigest(r[7])
        bucket = ((key >> _U(32)) * _U(self.buckets) >> _U(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        start = _runs(order, bucket)
        out = []
        for i, j in zip(start.tolist(), np.append(start[1:], len(rows)).tolist(), strict=True):
            mine = [rows[k] for k in order[i:j].tolist()]
            needs = np.zeros(len(mine), _NEED)
            for f, k in (("doc", 2), ("row", 3), ("pos", 4), ("left", 5), ("right", 6)):
                needs[f] = [r[k] for r in mine]
            shared, rests = front_code([r[0] for r in mine])
            left = b"".join(r[1] for r in mine)
            body = b"".join(len(x).to_bytes(8, "little") + x for x in (pack(needs), zstandard.compress(shared, 1), zstandard.compress(rests, 1), zstandard.compress(left, 1)))
            out.append((int(bucket[order[i]]), RUNS, body))
        for i in range(0, len(out), 200):
            yield _batch(out[i : i + 200])
        trim()


def _read_run(body: bytes, length: int):
    parts, at = [], 0
    for _ in range(4):
        n = int.from_bytes(body[at : at + 8], "little")
        parts.append(body[at + 8 : at + 8 + n])
        at += 8 + n
    needs = unpack(parts[0], _NEED)
    shared, rests, lefts = (zstandard.decompress(p) for p in parts[1:])
    suffixes, before, at = [], b"", 0
    for n, right in zip(shared, needs["right"].tolist(), strict=True):
        m = length - right - n
        before = before[:n] + rests[at : at + m]
        at += m
        suffixes.append(before)
    return needs, list(shared), suffixes, lefts


def _common(rows: np.ndarray) -> np.ndarray:
    """Equal leading bytes of each row and the one before."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differs = rows[1:] != rows[:-1]
        out[1:] = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
    return out


def _merge_bucket(length: int, blocks: int):
    width = length - K + 1

    def run(batches):
        held: list[np.ndarray] = []
        for _, rows in groups(batches):
            read = [_read_run(x, length) for _, x in rows]
            order, prefixes = merge_runs([(r[1], r[2]) for r in read])
            base = np.concatenate([[0], np.cumsum([len(r[0]) for r in read])])
            places = np.array([base[i] + j for i, j in order])
            e = np.concatenate([r[0] for r in read])
            # Left contexts, mirrored, as rows of bytes.
            flat = np.frombuffer(b"".join(r[3] for r in read) or b"\0", np.uint8)
            n = e["left"].astype(np.int64)
            ends = np.cumsum(n)
            steps = np.arange(width)
            mirrored = np.where(steps < n[:, None], flat[np.maximum(ends[:, None] - 1 - steps, 0)], 0).astype(np.uint8)
            kinds, inverse = np.unique(np.ascontiguousarray(mirrored).view(f"V{width}").ravel(), return_inverse=True)
            left_common = _common(kinds.view(np.uint8).reshape(len(kinds), width))
            e, inverse = e[places], inverse[places]
            right_common = np.array(prefixes)
            found: list[np.ndarray] = []
            for r in range(width):
                mine = np.flatnonzero((e["right"] <= r) & (e["left"] >= r))
                if len(mine) < 2:
                    continue
                right = np.cumsum(right_common < length - r)[mine]
                left = np.cumsum(left_common < r)[inverse[mine]] if r else np.zeros(len(mine), np.int64)
                key = right << 32 | left
                by = np.argsort(key, kind="stable")
                start = _runs(by, key)
                doc = e["doc"][mine][by]
                least = np.repeat(np.minimum.reduceat(doc, start), np.diff(np.append(start, len(by))))
                hit = mine[by[doc > least]]
                if len(hit):
                    found.append(np.stack([hit, np.full(len(hit), r)], 1))
            if found:
                hits = np.concatenate(found)
                hits = hits[np.lexsort((-hits[:, 1], hits[:, 0]))]
                # Windows next to each other make one span.
                new = np.flatnonzero(np.concatenate([[True], (hits[1:, 0] != hits[:-1, 0]) | (hits[1:, 1] != hits[:-1, 1] - 1)]))
                last = np.append(new[1:], len(hits)) - 1
                x = e[hits[new, 0]]
                spans = np.empty(len(x), _SPAN)
                spans["doc"], spans["row"] = x["doc"], x["row"]
                spans["start"], spans["end"] = x["pos"] - hits[new, 1], x["pos"] - hits[last, 1] + length
                held.append(spans)
                if sum(map(len, held)) >= HELD:
                    yield from _sent(held, blocks, SPANS)
        if held:
            yield from _sent(held, blocks, SPANS)
        trim()

    return run


class _Cut:
    """Gives each document the spans that it loses. as_text: what stays as text, without characters cut apart."""

    def __init__(self, as_text: bool):
        self.as_text = as_text

    def block(self, held):
        x, start = _table([unpack(p, _SPAN) for k, p in held if k == SPANS], _SPAN)
        ends = np.append(start[1:], len(x))[: len(start)]
        self.of = {(d, r): x[a:b] for d, r, a, b in zip(x["doc"][start].tolist(), x["row"][start].tolist(), start.tolist(), ends.tolist(), strict=True)}

    def documents(self, b):
        kept, sizes, removed, runs = [], [], [], []
        for doc, row, packed in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(2).to_pylist(), strict=True):
            text = zstandard.decompress(packed)
            sizes.append(len(text))
            spans = self.of.get((doc, row)) if doc is not None else None
            if spans is None:
                kept.append(text)
                removed.append(0)
                runs.append([])
                continue
            by = np.argsort(spans["start"], kind="stable")
            a, e = spans["start"][by].astype(np.int64), np.maximum.accumulate(spans["end"][by].astype(np.int64))
            new = np.flatnonzero(np.concatenate([[True], a[1:] > e[:-1]]))
            a, e = a[new].tolist(), e[np.append(new[1:], len(e)) - 1].tolist()
            kept.append(b"".join(text[i:j] for i, j in zip([0, *e], [*a, len(text)], strict=True)))
            removed.append(len(text) - len(kept[-1]))
            runs.append([{"a": i, "b": j} for i, j in zip(a, e, strict=True)])
        spans_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        yield pa.RecordBatch.from_arrays([*b.columns[3:], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, spans_type), pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if self.as_text else pa.array(kept, pa.binary())], names=[*b.schema.names[3:], "n_bytes", "n_removed", "spans", "kept"])

    def end(self):
        return ()


_RESULT = ("n_bytes", "n_removed", "spans", "kept")


def repeats(docs: DataFrame, length: int = 50, as_text: bool = False) -> DataFrame:
    """docs(doc_id, text, more...) -> doc_id, more..., n_bytes, n_removed, spans (array of removed [a, b)), kept (binary; as_text: a string, without characters
    cut apart). Columns of docs that have the name of one of the result's are left out."""
    if not K < length <= 200:
        raise ValueError("windows of 17 to 200 bytes")
    spark = docs.sparkSession
    tune(spark)
    key, text, *more = docs.columns
    more = [c for c in more if c not in _RESULT]
    rest = F.struct(*[F.col(f"`{c}`") for c in more]) if more else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("binary").alias("text"), rest.alias("more"))
    # Rows are told apart by their id; only those that share one by a hash of their text too.
    again = staged(rows.groupBy("doc").count().where("count > 1 and doc is not null").select(F.col("doc").alias("again")))
    if again.limit(1).count():
        rows = rows.join(again, F.col("doc") == F.col("again"), "left").withColumn("row", F.when(F.col("again").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("text")))
    else:
        rows = rows.withColumn("row", F.lit(0).cast("long"))
    rows = rows.select("doc", "row", "text", "more")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = shuffle_partitions(spark)
    blocks, buckets = max(1, -(-total // BLOCK)), max(1, -(-total // BUCKET))

    def dealt(df):
        return df.repartition(parts, "route").sortWithinPartitions("route", "kind")

    sent = rows.where("doc is not null").select("doc", "row", "text").mapInArrow(_send_anchors(length, buckets, blocks), _ROUTED_DDL)
    settled = staged(dealt(sent).mapInArrow(_find_needs(blocks), _ROUTED_DDL))

    numbered = rows.mapInArrow(_numbered(blocks), rows.withColumn("block", F.lit(0).cast("long")).schema)
    papers = numbered.select(F.col("block").alias("route"), F.lit(9).alias("kind"), F.col("text").alias("payload"), "doc", "row", "more")
    blank = [F.lit(None).cast(papers.schema[c].dataType).alias(c) for c in papers.columns[3:]]

    def with_documents(routed, papers):
        return dealt(routed.select("route", "kind", "payload", *blank[: len(papers.columns) - 3]).union(papers))

    plain = papers.where("doc is not null").select("route", "kind", "payload", "doc", "row")
    contexts = with_documents(settled.where(F.col("kind") == NEEDS), plain).mapInArrow(_meet_documents(lambda: _Contexts(length, buckets)), _ROUTED_DDL)
    merged = staged(dealt(contexts).mapInArrow(_merge_bucket(length, blocks), _ROUTED_DDL))
    spans = settled.where(F.col("kind") == SPANS).union(merged)
    made = {"n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "spans": F.expr("cast(array() as array<struct<a:long,b:long>>)"), "kept": F.lit("" if as_text else b"")}
    out = with_documents(spans, papers).mapInArrow(_meet_documents(lambda: _Cut(as_text)), papers.select("doc", "row", "more").withColumns(made).schema)
    return out.select(F.col("doc").alias(key), *[F.col(f"more.`{c}`").alias(c) for c in more], *_RESULT)


def _numbered(blocks: int):
    """Adds each document's block, and packs its text for the way there."""

    def run(batches):
        pack_text = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            doc = b.column(0).fill_null(0).to_numpy()
            packed = pa.array([pack_text(t or b"") for t in b.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:2], packed, *b.columns[3:], pa.array(_block(np.ascontiguousarray(doc), b.column(1).to_numpy(), blocks))], names=[*b.schema.names, "block"])

    return run


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.select(key, "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """Documents without their repeated bytes, columns as they came; of characters cut apart nothing stays. Null texts stay null, and what loses
    nothing stays as it is."""
    names = docs.columns
    whole = docs.select(F.col(f"`{key}`").cast("long").alias("__key"), F.col(f"`{text}`").alias("__text"), F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("__rest"), F.col(f"`{text}`").isNull().alias("__null"))
    found = repeats(whole, length, as_text=True)
    return found.select(*[F.when(~F.col("__null"), F.col("kept")).alias(c) if c == text else F.col(f"__rest.`{c}`").alias(c) for c in names])


def brute_force(texts: list[tuple[int | None, str | None]], length: int = 50) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, kept_sha256 of each, by a table of all windows; for tests."""
    first: dict[bytes, int] = {}
    raw = [(i, (t or "").encode()) for i, t in texts]
    for i, t in raw:
        if i is not None:
            for s in range(len(t) - length + 1):
                w = t[s : s + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        if i is not None:
            for s in range(len(t) - length + 1):
                if first[t[s : s + length]] < i:
                    gone[s : s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), sum(b > a for a, b in zip(b"\0" + bytes(gone), gone, strict=False)), hashlib.sha256(kept).hexdigest()))
    return out
