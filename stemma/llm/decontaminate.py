"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

Words: A-Z lower-cased, maximal runs of letters a-z, digits and bytes from 128 up, in the text's UTF-8.
Training words stream through the automaton, which tracks the longest match that ends at each word; a match
as long as the window (or a whole item shorter than it) is a hit.

Nulls and the like: a null or wordless text has no words and no hits; items without id or words are left out; repeated
items count once; several texts under one item id count as that item; an empty benchmark hits nothing.
Rows of documents are kept as they come, repeated ids and null ids included. Equal hashes of windows only let a document through to the automata.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import as_bytes, bitmap, record_batch, shuffle_partitions, staged, tune

#: Lower-cases A-Z and turns whatever parts words into a blank.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Item words in one automaton; a larger benchmark is dealt over several.
AUTOMATON_WORDS = 100_000
#: Documents that one task reads with an automaton of several.
SHARE = 2000


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class WindowAutomaton:
    """Suffix automaton of several word sequences, with the items below each window's state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        sequences = []
        for item, seq in items:
            if seq:
                sequences.append((item, [self.ids.setdefault(w, len(self.ids)) for w in seq]))
        for _, seq in sequences:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        #: Shortest length that can be a hit.
        self.least = min((min(window, len(s)) for _, s in sequences), default=0)
        #: State of a window or a whole short item -> items; lengths of the latter by state.
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for item, seq in sequences:
            if len(seq) < window:
                s = 0
                for w in seq:
                    s = self.next[s][w]
                self.short.setdefault(s, {}).setdefault(len(seq), set()).add(item)
            else:
                s = size = 0
                for w in seq:
                    s, size = self.step(s, size, w)
                    if size >= window:
                        while self.longest[self.link[s]] >= window:
                            s = self.link[s]
                        size = window
                        self.items.setdefault(s, set()).add(item)
        pairs = {a * len(self.ids) + b for _, s in sequences for a, b in zip(s, s[1:], strict=False)}
        #: Which pairs of neighbours the items have, as a hashed bitmap: a filter before the automaton.
        self.pairs = np.zeros(1 << 20, bool)
        if pairs:
            self.pairs[self._slot(np.array(list(pairs), np.int64))] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.int64(0x9E3779B97F4A7C15 - (1 << 64)) >> np.int64(40)) & np.int64((1 << 20) - 1)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, longest = self.next, self.link, self.longest
        if w in nxt[last]:
            q = nxt[last][w]
            return q if longest[q] == longest[last] + 1 else self._clone(last, w, q)
        new = len(nxt)
        nxt.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if longest[q] == longest[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.longest.append(self.longest[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def step(self, state: int, size: int, w: int) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        while w not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            size = self.longest[state]
        return self.next[state][w], size + 1

    def hits(self, seq: list[int], base: int, spans: list[tuple[int, int]], found: set[str]) -> None:
        """Adds the spans of hit words, and the items, of a run of known words that begins at word base."""
        state = size = 0
        for i, w in enumerate(seq, base + 1):
            state, size = self.step(state, size, w)
            hit = 0
            s = state
            if size >= self.window:
                while self.longest[self.link[s]] >= self.window:
                    s = self.link[s]
                found |= self.items[s]
                hit = self.window
            if self.short:
                s, room = state, size
                while s > 0:
                    for n, ids in self.short.get(s, {}).items():
                        if n <= room:
                            found |= ids
                            hit = max(hit, n)
                    s = self.link[s]
                    room = self.longest[s]
            if hit:
                a = i - hit
                if spans and spans[-1][1] >= a:
                    # an earlier span can begin later than a: short items within a longer match
                    while spans and spans[-1][0] >= a:
                        spans.pop()
                    if spans and spans[-1][1] >= a:
                        spans[-1] = (spans[-1][0], i)
                    else:
                        spans.append((a, i))
                else:
                    spans.append((a, i))

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Per text: words, spans of hit words, items."""
        flat: list[int] = []
        starts = []
        get = self.ids.get
        for t in texts:
            starts.append(len(flat))
            flat += map(get, words(t), repeat(-1))
            flat.append(-1)
        starts.append(len(flat))
        out = [(b - a - 1, [], set()) for a, b in zip(starts, starts[1:], strict=False)]
        if not self.least:
            return out
        ids = np.array(flat, np.int64)
        known = ids >= 0
        if self.least == 1:
            good, size = known, 1
        else:
            good = known[:-1] & known[1:]
            at = np.flatnonzero(good)
            good[at] = self.pairs[self._slot(ids[at] * len(self.ids) + ids[at + 1])]
            size = self.least - 1
        edges = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]])))
        a, b = edges[::2], edges[1::2]
        keep = b - a >= size
        a, b = a[keep], b[keep] + (self.least > 1)
        doc = np.searchsorted(starts, a, "right") - 1
        for k, i, j in zip(doc.tolist(), a.tolist(), b.tolist(), strict=True):
            self.hits(flat[i:j], i - starts[k], out[k][1], out[k][2])
        return out


def _pieces(window: int, most: int):
    """Items as (id, words on end), long ones in overlapping parts that keep every window whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("seq", pa.binary()), ("n", pa.int64())])
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                seq = words(text)
                for i in range(0, max(1, len(seq) - window + 1), most):
                    part = seq[i : i + most + window - 1]
                    if part:
                        rows.append((item, b" ".join(part), len(part)))
            yield record_batch(schema, *(list(c) for c in zip(*rows, strict=True))) if rows else record_batch(schema, [], [], [])

    return run


_SPANS = "array<struct<a:int,b:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _window_hashes(seq: list[bytes], size: int) -> list[int]:
    """Of every run of size words."""
    if len(seq) < size:
        return []
    flat, ends = b" ".join(seq), np.cumsum([len(w) + 1 for w in seq])
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh64_intdigest
    return [digest(flat[i:j]) for i, j in zip(starts.tolist(), (ends[size - 1 :] - 1).tolist(), strict=False)]


def _marks(window: int, bits: int):
    """Places of the items' windows in a bitmap."""

    def run(batches):
        for b in batches:
            split = [seq.split() for seq in as_bytes(b.column(0))]
            at = [h >> (64 - bits) for seq in split for h in _window_hashes(seq, min(window, len(seq)))]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.array(at, np.int64)))], names=["place"])

    return run


_NEW = ("n_words", "spans", "items")


def _meet(docs: DataFrame, parts: DataFrame, window: int, sizes: list[int], sent, bits: int) -> DataFrame:
    """docs(r, text), parts(id, seq, n, shard) -> (r, spans, items): each document meets the automata of those shards with which it shares a window's hash, each in one of
    as many tasks as have SHARE documents of the shard; a task makes the automaton from the shard's items and then reads the documents."""

    def item_windows(batches):
        for b in batches:
            seqs = [seq.split() for seq in as_bytes(b.column(0))]
            each = [_window_hashes(seq, min(window, len(seq))) for seq in seqs]
            shard = np.repeat(b.column(1).to_numpy(), [len(x) for x in each])
            yield pa.RecordBatch.from_arrays([pa.array(np.array([h for x in each for h in x], np.uint64).view(np.int64)), pa.array(shard)], names=["h", "shard"])

    def doc_windows(batches):
        marked = np.frombuffer(sent.value, np.uint8)
        for b in batches:
            rows, found = [], []
            for r, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                seq = words(t)
                h = np.unique(np.array([x for size in sizes for x in _window_hashes(seq, size)], np.uint64))
                at = (h >> np.uint64(64 - bits)).astype(np.int64)
                h = h[marked[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]
                rows += [r] * len(h)
                found.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64))], names=["r", "h"])

    items = parts.select("seq", "shard").mapInArrow(item_windows, "h long, shard int").distinct()
    pairs = staged(docs.mapInArrow(doc_windows, "r long, h long").join(items, "h").select("r", "shard").distinct())
    shares = pairs.groupBy("shard").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("r"), F.col("shares")).cast("int")
    blank = lambda kind: F.lit(None).cast(kind)
    texts = docs.join(pairs.join(shares, "shard").select("r", "shard", share.alias("share")), "r").select("shard", "share", "r", blank("string").alias("id"), "text")
    owned = parts.join(shares, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), blank("long").alias("r"), "id", F.col("seq").alias("text"))
    rows = owned.union(texts).repartition(shuffle_partitions(docs.sparkSession), "shard", "share").sortWithinPartitions("shard", "share", F.col("r").asc_nulls_first())

    def scan(batches):
        now, held, automaton = None, [], None
        for b in batches:
            out = []
            for shard, part, r, name, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (shard, part) != now:
                    now, held, automaton = (shard, part), [], None
                if r is None:
                    held.append((name, text.split()))
                    continue
                automaton = automaton or WindowAutomaton(sorted(held), window)
                ((_, spans, ids),) = automaton.scan([text or b""])
                if spans:
                    out.append((r, [{"a": x, "b": y} for x, y in _merge(spans)], sorted(ids)))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], _SPAN_TYPE), pa.array([o[2] for o in out], pa.list_(pa.string()))], names=["r", "spans", "items"])

    found = rows.mapInArrow(scan, f"r long, spans {_SPANS}, items array<string>")
    return found.groupBy("r").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, automaton_words: int = AUTOMATON_WORDS, cut_over: int | None = None) -> DataFrame:
    """docs(key..., text) and items(id, text), the text last in both. Adds to docs: n_words, spans (of hit words, [a, b)), items (ids as sorted
    strings); columns of docs that have these names are left out. cut_over: cut spans of more words than that out of the text, and tell of these alone.

    Items of up to automaton_words words make one automaton, which is broadcast. More are dealt by a hash over as many as it takes: one pass over the documents
    finds those that hold any window at all, by a bitmap of the windows' hashes of at most 2^31 bits, and these alone go to the automata with which they share a window.
    """
    spark = docs.sparkSession
    tune(spark)
    *keys, text = docs.columns
    keys = [c for c in keys if c not in _NEW]
    item, content = items.columns
    parts = staged(
        items.where(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("id"), F.col(content).cast("binary").alias("seq")).mapInArrow(_pieces(window, max(window, automaton_words // 4)), "id string, seq binary, n long").dropDuplicates(["id", "seq"])
    )
    total = parts.agg(F.sum("n")).first()[0] or 0
    shards = 1 if total <= automaton_words else -(-2 * total // automaton_words)
    row = F.struct(*[F.col(f"`{c}`") for c in keys]) if keys else F.struct(F.lit(0).alias("none"))
    done = docs.select(row.alias("row"), F.col(f"`{text}`").cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"), F.expr(f"cast(array() as {_SPANS})").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))
    schema = done.schema

    def scanned(done: DataFrame) -> DataFrame:
        found = [(r.id, bytes(r.seq).split()) for r in parts.select("id", "seq").collect()]
        sent = spark.sparkContext.broadcast(WindowAutomaton(sorted(found), window))

        def run(batches):
            automaton = sent.value
            for b in batches:
                if not b.num_rows:
                    continue
                n, spans, ids, texts = [], [], [], b.column(1).to_pylist()
                for (count, new, got), old, before in zip(automaton.scan(as_bytes(b.column(1))), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                    n.append(count)
                    spans.append(_merge(new + [(o["a"], o["b"]) for o in old]))
                    ids.append(sorted(got.union(before)))
                if cut_over is not None:
                    spans = [[x for x in some if x[1] - x[0] > cut_over] for some in spans]
                    texts = [cut_spans(t or b"", some) if some else t for t, some in zip(texts, spans, strict=True)]
                spans = [[{"a": x, "b": y} for x, y in some] for some in spans]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()), pa.array(n, pa.int64()), pa.array(spans, _SPAN_TYPE), pa.array(ids, pa.list_(pa.string()))], names=b.schema.names)

        return done.mapInArrow(run, schema)

    if shards == 1:
        done = scanned(done)
    else:
        bits = min(31, max(20, (32 * total).bit_length()))
        marked = bitmap(parts.select("seq").mapInArrow(_marks(window, bits), "place long"), 1 << bits)
        sizes = sorted(r.size for r in parts.select(F.least("n", F.lit(window)).alias("size")).distinct().collect())
        sent = spark.sparkContext.broadcast(marked)

        def look(batches):
            marked = np.frombuffer(sent.value, np.uint8)
            for b in batches:
                n, maybe = [], []
                for t in as_bytes(b.column(1)):
                    seq = words(t)
                    n.append(len(seq))
                    at = np.array([h >> (64 - bits) for size in sizes for h in _window_hashes(seq, size)], np.int64)
                    maybe.append(bool((marked[at >> 3] >> (at & 7).astype(np.uint8) & 1).any()))
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(n, pa.int64()), *b.columns[3:], pa.array(maybe, pa.bool_())], names=[*b.schema.names, "maybe"])

        looked = done.mapInArrow(look, done.withColumn("maybe", F.lit(False)).schema)
        met = staged(looked.where("maybe").drop("maybe").withColumn("r", F.monotonically_increasing_id()))
        told = _meet(met.select("r", "text"), parts.withColumn("shard", F.pmod(F.xxhash64("id", "seq"), F.lit(shards)).cast("int")), window, sizes, sent, bits)
        both = met.drop("spans", "items").join(told, "r", "left").select("row", "text", "n_words", F.coalesce("spans", F.array()).cast(_SPANS).alias("spans"), F.coalesce("items", F.array()).cast("array<string>").alias("items"))

        def finish(batches):
            for b in batches:
                texts = b.column(1).to_pylist()
                spans = [_merge([(o["a"], o["b"]) for o in some]) for some in b.column(3).to_pylist()]
                if cut_over is not None:
                    spans = [[x for x in some if x[1] - x[0] > cut_over] for some in spans]
                    texts = [cut_spans(t or b"", some) if some else t for t, some in zip(texts, spans, strict=True)]
                spans = [[{"a": x, "b": y} for x, y in some] for some in spans]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()), b.column(2), pa.array(spans, _SPAN_TYPE), b.column(4)], names=b.schema.names)

        done = looked.where("not maybe").drop("maybe").union(both.mapInArrow(finish, schema))
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in keys], F.col("text").alias(text), *_NEW)


def digest(found: DataFrame, key: str) -> DataFrame:
    """The counts by document, from contamination()."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return found.select(
        F.col(key), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without its words in spans, nor what parts them; one blank stays where text was cut out within."""
    low = text.translate(_WORDS)
    inside = np.frombuffer(low, np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    a, b = edges[::2], edges[1::2]
    out, at = [], 0
    for i, j in spans:
        out.append(text[at : a[i]].rstrip())
        at = int(b[j - 1])
    out.append(text[at:].lstrip() if at else text)
    return b" ".join(x for x in out if x)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", window: int = 10, max_span: int = 0, max_coverage: float = 0.8) -> DataFrame:
    """Documents without the spans of benchmark words longer than max_span; documents of whose words such spans cover more
    than max_coverage go. Documents without a hit come out as they went in. The columns of docs, in their order.

    items: (id, text). Null texts stay null.
    """
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    found = contamination(docs.select(whole, F.col(f"`{text}`").alias("text")), items, window, cut_over=max_span)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    out = found.where((hit == 0) | (hit <= F.lit(max_coverage) * F.col("n_words")))
    return out.select(*[F.col("text").cast("string").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in names])


def brute_force(text: str | None, items: list[tuple[int, str | None]], window: int = 10) -> tuple[int, int, int, str]:
    """n_words, n_hit, n_items, items_sha256 by trying every place; for tests."""
    doc = words((text or "").encode())
    hit, ids = set(), set()
    for item, content in items:
        seq = words((content or "").encode())
        n = min(window, len(seq))
        if item is None or not n:
            continue
        wins = {tuple(seq[i : i + n]) for i in range(len(seq) - n + 1)}
        for i in range(len(doc) - n + 1):
            if tuple(doc[i : i + n]) in wins:
                hit.update(range(i, i + n))
                ids.add(str(item))
    return len(doc), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
