"""SimHash near-duplicates by covering anchors.

Two fingerprints that differ in at most 3 of 64 bits differ in at most 1 bit of one half. The words of a covering
code on 32 bits, a product of [7,4] Hamming codes (each word lies within 1 of a codeword) and of free bits, are the anchors.
A fingerprint x is at home at its nearest anchor, no farther than the code's covering radius; any y within 1 bit of x in that half is
within the radius plus 1 of that anchor. So each half visits every anchor that near, and visitors meet those at home there; the
whole fingerprints are then compared. The number of Hamming blocks follows the number of fingerprints: fewer blocks, more anchors.

Nulls and the like: null, empty and blank texts have fingerprint zero and link like others; a null id never is a component's id unless
all of its members' are null; repeated rows come out as often as they came in; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import LOWER, as_bytes, record_batch, shuffle_partitions, staged, trim, tune
from stemma.llm.components import connected_components

#: Homes, or visitors, at one anchor beyond which they are dealt over several tasks: each share of the homes meets each share of the visitors.
HOT = 20_000


def fingerprint(text: bytes, size: int = 3) -> int:
    words = text.translate(LOWER).split()
    n = len(words) - size + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), 42) if words else 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], 42) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=False)], "<u8")
    set_bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """docs(key..., text) -> (key..., fp long)."""
    tune(docs.sparkSession)
    *keys, text = docs.columns
    docs = docs.select(*keys, F.col(text).cast("binary").alias(text))

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, size) for t in as_bytes(b.column(len(keys)))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps)], names=[*keys, "fp"])

    return docs.mapInArrow(run, docs.drop(text).withColumn("fp", F.lit(0).cast("long")).schema)


class AnchorCode:
    """Product of blocks Hamming codes and 32 - 7 * blocks free bits."""

    def __init__(self, blocks: int):
        self.blocks, self.free = blocks, 32 - 7 * blocks
        syndrome = np.array([np.bitwise_xor.reduce([i + 1 for i in range(7) if w >> i & 1] or [0]) for w in range(128)])
        code = np.flatnonzero(syndrome == 0)
        distance = np.bitwise_count(np.arange(128)[:, None] ^ code[None, :]).astype(int)
        self.nearest = distance.min(1)
        self.home = code[distance.argmin(1)]
        extra = distance - self.nearest[:, None]
        # By word and slack: which codewords, and how much of the slack each takes.
        self.reach = [[[(int(code[k]), int(extra[w, k])) for k in np.flatnonzero(extra[w] <= s)] for s in range(3)] for w in range(128)]
        self.flat, self.cost, self.at, self.many = [], [], np.zeros((128, 3), np.int64), np.zeros((128, 3), np.int64)
        for w in range(128):
            for s in range(3):
                self.at[w, s], self.many[w, s] = len(self.flat), len(self.reach[w][s])
                self.flat += [c for c, _ in self.reach[w][s]]
                self.cost += [e for _, e in self.reach[w][s]]
        self.flat, self.cost = np.array(self.flat, np.int64), np.array(self.cost, np.int64)
        one = [1 << i for i in range(self.free)]
        two = [a | b for i, a in enumerate(one) for b in one[:i]]
        self.flips = np.array([0, *one, *two], np.int64)
        self.upto = np.array([1, 1 + len(one), len(self.flips)])

    def words(self, half: np.ndarray) -> list[np.ndarray]:
        return [half >> (7 * i) & 127 for i in range(self.blocks)]

    def homes(self, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest anchor and its distance."""
        anchor = half >> (7 * self.blocks) << (7 * self.blocks)
        far = np.zeros(len(half), np.int64)
        for i, w in enumerate(self.words(half)):
            anchor = anchor | self.home[w] << (7 * i)
            far += self.nearest[w]
        return anchor, far

    def visits(self, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) for every anchor near enough. A neighbour's home is no farther from it than the radius, nor than this
        row's nearest anchor is from this row plus 1."""
        _, far = self.homes(half)
        slack = np.minimum(self.blocks, far + 1) + 1 - far
        row, anchor = np.arange(len(half)), np.zeros(len(half), np.int64)
        for i, w in enumerate(self.words(half)):
            word = w[row]
            n = self.many[word, slack]
            k = np.repeat(self.at[word, slack] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row, anchor, slack = np.repeat(row, n), np.repeat(anchor, n) | self.flat[k] << (7 * i), np.repeat(slack, n) - self.cost[k]
        n = self.upto[slack]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row, anchor = np.repeat(row, n), np.repeat(anchor, n)
        free = half[row] >> (7 * self.blocks) ^ self.flips[k]
        return row, anchor | free << (7 * self.blocks)


def blocks_for(n: int) -> int:
    """So many Hamming blocks that an anchor has some tens of visitors."""
    return max(0, min(4, (32 - math.ceil(math.log2(max(1, n)))) // 3))


def _meetings(blocks: int):
    def run(batches):
        code = AnchorCode(blocks)
        schema = pa.schema([("anchor", pa.int64()), ("home", pa.bool_()), ("fp", pa.int64())])
        for b in batches:
            all_fps = b.column(0).to_numpy()
            for i in range(0, len(all_fps), 5000):
                fps = all_fps[i : i + 5000]
                for side in range(2):
                    half = (fps.view(np.uint64) >> np.uint64(32 * side) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                    mark = np.int64(side) << np.int64(32)
                    row, anchor = code.visits(half)
                    home, _ = code.homes(half)
                    yield record_batch(schema, np.concatenate([home, anchor]) | mark, np.arange(len(home) + len(row)) < len(home), np.concatenate([fps, fps[row]]))

    return run


def _linked(anchor: np.ndarray, home: np.ndarray, fp: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges within whole groups of rows, sorted by anchor."""
    cuts = np.flatnonzero(np.diff(anchor)) + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(anchor)]])
    homes = np.add.reduceat(home.astype(np.int64), starts)
    sizes = ends - starts
    out = []
    small = (homes > 0) & (sizes > homes) & (homes * (sizes - homes) <= 4096)
    # Small groups: every home against every row of its group, many groups at a time.
    group = np.repeat(np.arange(len(starts)), sizes)
    h = np.flatnonzero(home & small[group])
    for i in range(0, len(h), 20000):
        x = h[i : i + 20000]
        n = sizes[group[x]]
        y = np.repeat(starts[group[x]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        x = np.repeat(x, n)
        near = (np.bitwise_count((fp[x] ^ fp[y]).view(np.uint64)) <= most) & (fp[x] != fp[y])
        out.append((fp[x[near]], fp[y[near]]))
    # Large ones: a home at a time, and only the edges that join what is not yet joined.
    for g in np.flatnonzero((homes > 0) & (sizes > homes) & ~small):
        at = np.arange(starts[g], ends[g])
        mine, own = np.unique(fp[at]), np.unique(fp[at[home[at]]])
        label = np.arange(len(mine))
        a, b = [], []
        for x in own:
            near = np.flatnonzero(np.bitwise_count((mine ^ x).view(np.uint64)) <= most)
            labels, one = np.unique(label[near], return_index=True)
            if len(labels) > 1:
                a += [x] * len(labels)
                b += mine[near[one]].tolist()
                label[np.isin(label, labels)] = labels[0]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        # x itself may stand for its label; join the others to one of x's own label through x
        out.append((a[a != b], b[a != b]))
    return out


def _compare(most: int):
    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held: list[list[np.ndarray]] = []

        def linked(columns):
            for a, b in _linked(*columns, most):
                if len(a):
                    e = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0)
                    yield record_batch(schema, e[:, 0], e[:, 1])

        for b in batches:
            if not b.num_rows:
                continue
            anchor, home, fp = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy()
            last = int(np.searchsorted(anchor, anchor[-1], "left"))
            if last:
                held.append([anchor[:last], home[:last], fp[:last]])
                yield from linked([np.concatenate(c) for c in zip(*held, strict=True)])
                held = []
            elif held and held[0][0][0] != anchor[0]:
                yield from linked([np.concatenate(c) for c in zip(*held, strict=True)])
                held = []
            held.append([anchor[last:], home[last:], fp[last:]])
        if held:
            yield from linked([np.concatenate(c) for c in zip(*held, strict=True)])
        trim()

    return run


def links(distinct: DataFrame, most: int = 3) -> DataFrame:
    """distinct(fp) -> edges (a, b) that connect all fingerprints within most bits, through others at least. most: 2 or 3."""
    if not 2 <= most <= 3:
        raise ValueError("the anchors are laid out for 2 or 3 differing bits")
    blocks = blocks_for(distinct.count())
    rows = distinct.select("fp").mapInArrow(_meetings(blocks), "anchor long, home boolean, fp long")
    sizes = rows.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("visitors"))
    shares = [F.ceil(F.col(c) / HOT).cast("int").alias(c) for c in ("homes", "visitors")]
    hot = staged(sizes.where(f"homes > {HOT} or homes > 0 and visitors > {HOT}").select("anchor", *shares))
    if hot.limit(1).count():
        # Each row goes to its own share of its kind, with all shares of the other kind.
        mine = F.pmod(F.xxhash64("fp"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visitors")))
        others = F.when(F.col("homes").isNull(), F.array(F.lit(0).cast("long"))).when(F.col("home"), F.transform(F.sequence(F.lit(0), F.col("visitors") - 1), lambda k: mine * F.col("visitors") + k)).otherwise(F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda k: k * F.col("visitors") + mine))
        rows = rows.join(hot, "anchor", "left").withColumn("share", F.explode(others))
        rows = rows.select((F.col("anchor") + F.col("share") * F.lit(1 << 33)).alias("anchor"), "home", "fp")
    rows = rows.repartition(shuffle_partitions(distinct.sparkSession), "anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(_compare(most), "a long, b long")


def near_duplicates(docs: DataFrame, most: int = 3, size: int = 3) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, fp long, component_id): the least id reachable over links of at most most bits."""
    key = docs.columns[0]
    fps = staged(fingerprints(docs, size))
    distinct = staged(fps.groupBy("fp").agg(F.min(key).alias("least")))
    roots = connected_components(links(distinct, most))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lead = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lead, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(key, "fp", "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, least: float = 0.8) -> DataFrame:
    """One document of each group of near copies stays, that with the least id; of rows that repeat that id, one. Near copies are texts whose
    shingles of size words have a Jaccard similarity of least or more. Documents without words stay. Rows without an id stay only where no member of their group has one."""
    from stemma.llm.shingles import similar_groups

    names = docs.columns
    found = similar_groups(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).where(F.col("text").rlike("[^\\x20\\x09-\\x0D]")), size, least)
    lost = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__lost")).distinct()
    kept = docs.join(lost, docs[f"`{key}`"].eqNullSafe(lost["__lost"]), "left_anti")
    again = staged(docs.groupBy(F.col(f"`{key}`").alias("__again")).count().where("count > 1 and __again is not null").select("__again"))
    if again.limit(1).count():
        same = kept[f"`{key}`"] == again["__again"]
        kept = kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates([key]))
    return kept.select(*[F.col(f"`{c}`") for c in names])


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def brute_force(texts: dict[int, str | None], most: int = 3) -> dict[int, tuple[str, int]]:
    """doc_id -> (fingerprint, component id) over all pairs; for tests."""
    fps = {}
    for i, t in texts.items():
        words = (t or "").encode().translate(LOWER).split()
        shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        fps[i] = sum(1 << k for k in range(64) if sum(x >> k & 1 for x in h) * 2 > len(h))
    parent = {i: i for i in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in fps:
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (f"{fps[i]:016x}", root(i)) for i in fps}
