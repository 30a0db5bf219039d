"""Exact Jaccard join of word n-grams by grouped prefixes, and the components of its links.

All shingles have one order: those of rarely met cells of a table of counts first, then by hash. Two sets as similar as asked share one of their first
n - ceil(n p / 100) + 1 shingles, their prefixes, in any order that all sets share; the counts, which cover every document, only keep
common shingles out of prefixes. Sets that are equal are one node; nodes of one prefix and one size are one group. Groups post their prefixes:

* shingles that at most SMALL groups post give pairs of groups, judged by sizes and by how much of both sets can follow the shared place;
* of longer lists the groups that are not joined yet meet one group of the list, in LEADERS rounds, another one each round; then those of a list's
  members that are apart from most of it meet each of its members, dealt over a grid of shares: once by sizes, places and parities, which leaves the members that may have a link,
  and these with their sets, where only links that join something are written. A large family of near copies so needs no pairs of all, and no pair that a list holds goes unseen;
* members of one group are a list of their own.

Texts that nothing equals, and groups of one member, are told by bitmaps of those that are not alone, so that their prefixes are exchanged once, as postings.

Pairs of groups are expanded into pairs of nodes, first judged by parities: a bit for each residue of the hashes, by whether a set holds an odd number of it.
Two sets differ in at least as many shingles as bits, so no similar pair is lost. What is left is counted on whole sets. Thresholds are compared in whole numbers.

Nulls and the like: texts without words have no shingles and link to nothing, not to each other; a text of fewer words than a shingle is one shingle; copies
and repeated rows of one id are one node; a null id is never a component's id unless all of its members' are null. Equality of 64-bit hashes stands in for that of sets
and for that of shingles within a text, of 48 bits for that of a pair's shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import LOWER, bitmap, dropped, mix64, record_batch, shuffle_partitions, staged, trim, tune
from stemma.llm.components import connected_components
from stemma.llm.shingles import shingle_sets

#: Cells of the table of counts, and of one block of it.
CELLS, BLOCK = 1 << 22, 1 << 16
#: Groups of a list whose pairs are formed at once; rounds of leaders of longer ones; members that one task compares with a leader, or holds of those that are apart.
SMALL, LEADERS, SHARE = 4, 2, 1000
#: Level of a shingle (eight to a doubling of its count) from which its list is taken to be long, and never lies in one task.
LONG = 8 * 16
_LOW = np.uint64((1 << 48) - 1)
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _counted(size: int):
    """Of all texts of a task how many hold a shingle of each cell, block by block."""

    def run(batches):
        counts = np.zeros(CELLS, np.uint32)
        for b in batches:
            sets = shingle_sets(b.column(0), size)
            if sets:
                counts += np.bincount((np.concatenate(sets) >> np.uint64(42)).astype(np.int64), minlength=CELLS).astype(np.uint32)
        parts = [(k, counts[k * BLOCK : (k + 1) * BLOCK]) for k in range(CELLS // BLOCK)]
        some = [(k, zstandard.compress(c.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)) for k, c in parts if c.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int32()), pa.array([c for _, c in some], pa.binary())], names=["block", "counts"])
        trim()

    return run


def _added(batches):
    """Rows (block, counts) by block: the levels of each block, eight to a doubling."""
    now, total = None, None

    def level():
        return now, np.minimum(255, 8 * np.log2(total + 1.0)).astype(np.uint8).tobytes()

    for b in batches:
        done = []
        for block, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if block != now:
                if now is not None:
                    done.append(level())
                now, total = block, np.zeros(BLOCK, np.int64)
            total += np.frombuffer(zstandard.decompress(body), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.binary())], names=["block", "levels"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([level()[1]], pa.binary())], names=["block", "levels"])


def levels(texts: DataFrame, size: int) -> np.ndarray:
    """How often shingles of each cell are met in all texts, in a byte a cell: 4 MB, whatever the input."""
    blocks = texts.mapInArrow(_counted(size), "block int, counts binary").repartition("block").sortWithinPartitions("block")
    out = np.zeros(CELLS, np.uint8)
    for r in blocks.mapInArrow(_added, "block int, levels binary").collect():
        out[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.levels, np.uint8)
    return out


def _node(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) if len(shingles) else 0


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _placed(size: int, percent: int, order):
    """Of each text its node, number of shingles, group, prefix and parities."""

    def run(batches):
        level = order.value
        for b in batches:
            nodes, sizes, groups, tokens, bits = [], [], [], [], []
            for s in shingle_sets(b.column(1), size):
                n = len(s)
                nodes.append(_node(s))
                sizes.append(n)
                first = np.zeros(0, np.uint64)
                if n:
                    p = prefix_length(n, percent)
                    first = np.sort(np.partition(level[(s >> np.uint64(42)).astype(np.int64)].astype(np.uint64) << np.uint64(48) | (s & _LOW), p - 1)[:p])
                groups.append(xxhash.xxh64_intdigest(first.tobytes(), n & 0xFFFFFFFF))
                tokens.append(first)  # level and 48 bits
                wide = max(64, 1 << (n - 1).bit_length()) if n else 0
                bits.append(np.packbits(np.bincount((s & np.uint64(wide - 1)).astype(np.int64), minlength=wide).astype(np.uint8) & 1, bitorder="little").tobytes() if n else b"")
            at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
            flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, groups)]
            columns = [b.column(0), longs[0], pa.array(np.array(sizes, np.int32)), longs[1], pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "gid", "tokens", "bits"])
        trim()

    return run


def _place(keys: pa.Array, bits: int) -> np.ndarray:
    """Places of 64-bit hashes in a bitmap of 2 ^ k bits."""
    return (mix64(keys.to_numpy().view(np.uint64)) >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def _bits_for(n: int) -> int:
    """At least sixteen bits each, and no more than 2 ^ 30."""
    return min(1 << 30, max(1 << 20, 1 << (16 * n).bit_length()))


def told_apart(df: DataFrame, several: DataFrame, bits: int) -> DataFrame:
    """several(key): adds alone to df(key, ...), false for all rows whose key is one of them, and for few of the others."""
    (key,) = several.columns

    def places(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place(b.column(0), bits))], names=["place"])

    told = df.sparkSession.sparkContext.broadcast(bitmap(several.mapInArrow(places, "place long"), bits))

    def run(batches):
        marked = np.frombuffer(told.value, np.uint8)
        for b in batches:
            h = _place(b.column(0), bits)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(marked[h >> 3] >> (h & 7) & 1 == 0)], names=[*b.schema.names, "alone"])

    return df.select(key, *[c for c in df.columns if c != key]).mapInArrow(run, df.select(key, *[c for c in df.columns if c != key]).withColumn("alone", F.lit(True)).schema)


def only(df: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """Rows of df(key, ...) whose key may be one of keys(key): what a join would drop goes before it is exchanged."""
    return told_apart(df, keys.withColumnRenamed(keys.columns[0], df.columns[0]), bits).where("not alone").drop("alone")


def _ends(pairs: DataFrame, *sides: str) -> DataFrame:
    return pairs.select(F.explode(F.array(*sides)).alias("node"))


def _listed(percent: int):
    """Rows (token, gid, n, pos) by token: of tokens of two to SMALL groups the pairs (gid, other) that can be similar, of those of more the rows, with other null. Of a
    long list no more than SMALL rows are held."""

    def listed(x: list[np.ndarray], start: np.ndarray, size: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        token, gid, n, pos = x
        # Rows of a short list that stand behind each row in it.
        behind = np.repeat(np.where(many, 0, start + size), size) - np.arange(len(token))
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in range(1, SMALL):
            i = np.flatnonzero(behind > d)
            j = i + d
            fits = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & ((100 + percent) * np.minimum(n[i] - pos[i], n[j] - pos[j]) >= percent * (n[i] + n[j]))
            first.append(np.minimum(gid[i[fits]], gid[j[fits]]))
            second.append(np.maximum(gid[i[fits]], gid[j[fits]]))
        few = np.unique(np.stack([np.concatenate(first), np.concatenate(second)], 1), axis=0)
        rows = np.flatnonzero(np.repeat(many, size))
        blank = lambda kind: pa.nulls(len(few), kind)
        columns = [
            pa.concat_arrays([blank(pa.int64()), pa.array(token[rows])]), pa.array(np.concatenate([few[:, 0], gid[rows]])), pa.concat_arrays([blank(pa.int32()), pa.array(n[rows].astype(np.int32))]),
            pa.concat_arrays([blank(pa.int32()), pa.array(pos[rows].astype(np.int32))]), pa.concat_arrays([pa.array(few[:, 1].copy()), pa.nulls(len(rows), pa.int64())]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["token", "gid", "n", "pos", "other"])

    def run(batches):
        held, going = None, None
        for b in batches:
            if not b.num_rows:
                continue
            x = [c.to_numpy().astype(np.int64) for c in b.columns]
            if held is not None:
                x = [np.concatenate(p) for p in zip(held, x, strict=True)]
            start = np.flatnonzero(np.concatenate([[True], x[0][1:] != x[0][:-1]]))
            size = np.diff(np.append(start, len(x[0])))
            many = size > SMALL
            many[0] |= x[0][0] == going  # a long list that goes on
            going, held = x[0][-1] if many[-1] else None, None
            if going is None:
                held, x = [c[start[-1] :] for c in x], [c[: start[-1]] for c in x]
                start, size, many = start[:-1], size[:-1], many[:-1]
            if len(x[0]):
                yield listed(x, start, size, many)
        if held is not None:
            yield listed(held, np.zeros(1, np.int64), np.array([len(held[0])]), np.zeros(1, bool))
        trim()

    return run


def _sets(size: int, wanted):
    """Of texts whose id's hash is among the wanted bits: node and shingles, 48 bits of each."""

    def run(batches):
        bits = np.frombuffer(wanted.value, np.uint8)
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(bits[h >> 3] >> (h & 7) & 1 == 1))
            sets = shingle_sets(b.column(1), size)
            nodes = np.array([_node(s) for s in sets], np.uint64).view(np.int64)
            whole = [np.unique(s & _LOW) for s in sets]
            bodies = [(s & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (s >> np.uint64(32)).astype("<u2").tobytes() for s in whole]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(bodies, pa.binary())], names=["node", "shingles"])
        trim()

    return run


def _unpacked(body: bytes) -> np.ndarray:
    n = len(body) // 6
    return np.frombuffer(body, "<u4", n).astype(np.uint64) | np.frombuffer(body, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32)


def _fold(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[-1] // 2
    return bits[..., :half] ^ bits[..., half:]


def _may_link(percent: int, n, m, differ):
    """Whether sets of n and m shingles that differ in this many at least can be as similar as asked."""
    return 100 * (n + m - differ) >= percent * (n + m + differ)


def _near(percent: int):
    """Rows (a, b, n, m, x, y): pairs (a, b) that parities x and y don't tell apart."""

    def run(batches):
        for b in batches:
            keep = []
            for n, m, x, y in zip(*(b.column(i).to_pylist() for i in range(2, 6)), strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                while len(x) > len(y):
                    x = _fold(x)
                while len(y) > len(x):
                    y = _fold(y)
                keep.append(bool(_may_link(percent, n, m, int(np.bitwise_count(x ^ y).sum()))))
            good = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(good), b.column(1).filter(good)], schema=_PAIR)

    return run


class _Strangers:
    """Of one cell of a list the members that are apart from most: which of them another member may be linked to, by sizes, places and parities."""

    def __init__(self, percent: int, held: list[tuple]):
        self.percent, self.held, self.of = percent, held, {}
        for wide in {len(x[4]) for x in held}:
            at = [i for i, x in enumerate(held) if len(x[4]) == wide]
            self.of[wide] = [np.array(at)] + [np.array([held[i][k] for i in at]) for k in (1, 2, 3, 4)]

    def near(self, label: int, n: int, pos: int, bits: np.ndarray) -> list[int]:
        out: list[int] = []
        for places, labels, sizes, starts, parities in self.of.values():
            fits = (100 * np.minimum(sizes, n) >= self.percent * np.maximum(sizes, n)) & (labels != label)
            at = np.flatnonzero(fits & ((100 + self.percent) * np.minimum(sizes - starts, n - pos) >= self.percent * (sizes + n)))
            if not at.size:
                continue
            x, y = parities[at], bits
            while x.shape[1] > len(y):
                x = _fold(x)
            while len(y) > x.shape[1]:
                y = _fold(y)
            out += places[at[_may_link(self.percent, sizes[at], n, np.bitwise_count(x ^ y).sum(1).astype(np.int64))]].tolist()
        return out


def _cells(batches):
    """Rows (token, cell, apart, ...) by token and cell, those apart first: each row that is not apart, with the cell's and those apart of it."""
    now, held, strangers = None, [], None
    for b in batches:
        for token, cell, apart, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (token, cell) != now:
                now, held, strangers = (token, cell), [], None
            if apart:
                held.append(row)
            elif held:
                if strangers is None:
                    strangers = {"cell": now, "held": held}
                yield strangers, row
        yield None, None  # the batch has ended


_VIABLE = pa.schema([("token", pa.int64()), ("cell", pa.int32()), ("apart", pa.bool_()), ("node", pa.int64())])


def _viable(percent: int):
    """Rows (token, cell, apart, node, label, n, pos, bits): those that may have a link to one on the other side."""

    def run(batches):
        out, seen, now = [], set(), None
        for s, row in _cells(batches):
            if s is None:
                yield record_batch(_VIABLE, *([x[k] for x in out] for k in range(4)))
                out = []
                continue
            if s["cell"] != now:
                now, seen = s["cell"], set()
                s["strangers"] = _Strangers(percent, [(h[0], h[1], h[2], h[3], np.frombuffer(h[4], np.uint8)) for h in s["held"]])
            node, label, n, pos, body = row
            near = s["strangers"].near(label, n, pos, np.frombuffer(body, np.uint8))
            if near:
                out.append((*now, False, node))
                out += [(*now, True, s["held"][i][0]) for i in near if i not in seen]
                seen.update(near)

    return run


def _joining(percent: int):
    """Rows (token, cell, apart, node, label, n, pos, bits, shingles): links (a, b) between rows of different labels, as far as they join what the cell has not joined yet."""

    def run(batches):
        now, root, out = None, {}, []

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        for s, row in _cells(batches):
            if s is None:
                yield record_batch(_PAIR, [x[0] for x in out], [x[1] for x in out])
                out = []
                continue
            if s["cell"] != now:
                now, root = s["cell"], {}
                s["strangers"] = _Strangers(percent, [(h[0], h[1], h[2], h[3], np.frombuffer(h[4], np.uint8)) for h in s["held"]])
                s["sets"] = [_unpacked(h[5]) for h in s["held"]]
            node, label, n, pos, bits, body = row
            mine = None
            for i in s["strangers"].near(label, n, pos, np.frombuffer(bits, np.uint8)):
                x, y = find(s["held"][i][1]), find(label)
                if x == y:
                    continue
                mine = _unpacked(body) if mine is None else mine
                if _linked(s["sets"][i], mine, percent):
                    root[x] = y
                    out.append((s["held"][i][0], node))

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    same = int((x[at] == y).sum())
    return 100 * same >= percent * (len(x) + len(y) - same)


def _compared(percent: int):
    """Rows (leader, share, node, shingles) by leader and share, the leader's own, of a null node, first: the pairs that are similar."""

    def run(batches):
        now, own = None, None
        for b in batches:
            out = []
            for lead, share, node, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                mine = _unpacked(body)
                if node is None:
                    now, own = (lead, share), mine
                elif now == (lead, share):
                    if _linked(own, mine, percent):
                        out.append((node, lead))
            yield record_batch(_PAIR, [x[0] for x in out], [x[1] for x in out])

    return run


def _fits(x: Column, y: Column, percent: int) -> Column:
    """Whether two sets (n, pos) that share the places pos first can be similar."""
    n, m = x["n"].cast("long"), y["n"].cast("long")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * F.least(n - x["pos"], m - y["pos"]) >= percent * (n + m))


def _close(pairs: DataFrame, nodes: DataFrame, percent: int, bits: int) -> DataFrame:
    """Of pairs (a, b) of nodes those that parities don't tell apart."""
    mine = only(nodes.select("node", "n", "bits"), _ends(pairs, "a", "b"), bits)
    side = lambda c, n, bits: mine.select(F.col("node").alias(c), F.col("n").alias(n), F.col("bits").alias(bits))
    return pairs.join(side("a", "n", "x"), "a").join(side("b", "m", "y"), "b").select("a", "b", "n", "m", "x", "y").mapInArrow(_near(percent), "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, bits: int) -> DataFrame:
    """Of different pairs (a, b) of nodes those that are similar. The sets of all a's that meet one b travel to it, a b with many of them stands in several tasks."""
    sets = only(sets, _ends(pairs, "a", "b"), bits)
    leads = pairs.groupBy("b").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    members = pairs.join(leads, "b").join(sets, F.col("a") == F.col("node")).select("b", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("share"), F.col("a").alias("node"), "shingles")
    own = leads.join(sets, F.col("b") == F.col("node")).select("b", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(None).cast("long").alias("node"), "shingles")
    rows = own.union(members).repartition(shuffle_partitions(pairs.sparkSession), "b", "share").sortWithinPartitions("b", "share", F.col("node").asc_nulls_first())
    return rows.mapInArrow(_compared(percent), "a long, b long")


def _met(now: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, bits: int) -> DataFrame:
    """now(token, node, n, pos, label): links of a list's members whose label is not that of most of them with any of its members."""
    most = now.groupBy("token", "label").count().groupBy("token").agg(F.max_by("label", F.struct("count", "label")).alias("most"), F.sum("count").alias("all"), F.max("count").alias("joined"))
    cells = most.select("token", "most", F.ceil(F.col("all") / (2 * SHARE)).cast("int").alias("members"), F.ceil((F.col("all") - F.col("joined")) / SHARE).cast("int").alias("strangers"))
    parities = staged(only(nodes.select("node", "bits"), now.select("node"), bits))
    full = now.join(cells, "token").join(parities, "node")
    grid = lambda mine, others, cell: F.transform(F.sequence(F.lit(0), others - 1), lambda k: cell(F.pmod(F.xxhash64("node"), mine).cast("int"), k))
    members, strangers = F.col("members"), F.col("strangers")
    every = full.withColumn("cell", F.explode(grid(members, strangers, lambda own, k: own * strangers + k))).withColumn("apart", F.lit(False))
    few = full.where("label <> most").withColumn("cell", F.explode(grid(strangers, members, lambda own, k: k * strangers + own))).withColumn("apart", F.lit(True))
    names = ("token", "cell", "apart", "node", "label", "n", "pos", "bits")
    parts = shuffle_partitions(now.sparkSession)
    by_cell = lambda df: df.repartition(parts, "token", "cell").sortWithinPartitions("token", "cell", F.desc("apart"))
    viable = staged(by_cell(few.select(*names).union(every.select(*names))).mapInArrow(_viable(percent), "token long, cell int, apart boolean, node long"))
    rows = viable.join(now.select("token", "node", "label", "n", "pos"), ["token", "node"]).join(parities, "node").join(only(sets, viable.select("node"), bits), "node")
    links = staged(by_cell(rows.select(*names, "shingles")).mapInArrow(_joining(percent), "a long, b long"))
    dropped(viable, parities)
    return links


def linked_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_shingles, component_id): the least id reachable over pairs of a Jaccard similarity of percent or more."""
    spark = docs.sparkSession
    tune(spark)
    key, text = docs.columns
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = spark.sparkContext.broadcast(levels(docs.select("text"), size))
    schema = docs.select("doc_id").withColumns({"node": F.lit(0).cast("long"), "n": F.lit(0), "gid": F.lit(0).cast("long"), "tokens": F.expr("cast(array() as array<long>)"), "bits": F.lit(b"")}).schema
    placed = staged(docs.mapInArrow(_placed(size, percent, order), schema))
    found = placed.select("doc_id", "node", "n")
    first = [F.first(c).alias(c) for c in ("n", "gid", "tokens", "bits")]
    bits = _bits_for(found.count())
    copied = placed.where("n > 0").groupBy("node").count().where("count > 1").select("node")
    known = told_apart(placed.where("n > 0"), copied, bits)
    columns = ("node", "least", "n", "gid", "tokens", "bits")
    single = known.where("alone").withColumnRenamed("doc_id", "least").select(*columns)
    nodes = staged(single.union(known.where("not alone").groupBy("node").agg(F.min("doc_id").alias("least"), *first).select(*columns)))
    # Every group posts once.
    shared = staged(nodes.groupBy("gid").count().where("count > 1").select("gid"))
    groups = told_apart(nodes.select("gid", "n", "tokens"), shared, bits)
    one = groups.where("alone").select("gid", "n", "tokens").union(groups.where("not alone").groupBy("gid").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")))
    posts = one.select(F.posexplode("tokens").alias("pos", "token"), "gid", "n").select("token", "gid", "n", "pos")
    long_ = F.shiftrightunsigned("token", 48) >= LONG
    rest = posts.where(~long_).repartition(shuffle_partitions(spark), "token").sortWithinPartitions("token")
    posted = staged(rest.mapInArrow(_listed(percent), "token long, gid long, n int, pos int, other long").union(posts.where(long_).withColumn("other", F.lit(None).cast("long"))))
    # Short lists: pairs of groups, expanded into pairs of their members.
    met = staged(posted.where("other is not null").select(F.col("gid").alias("gidx"), F.col("other").alias("gidy")).distinct())
    mine = only(nodes.select("gid", "node", "n", "bits"), _ends(met, "gidx", "gidy"), bits)
    sides = [mine.select(*[F.col(c).alias(c + k) for c in ("gid", "node", "n", "bits")]) for k in "xy"]
    few = met.join(sides[0], "gidx").join(sides[1], "gidy")
    few = staged(few.select(F.col("nodex").alias("a"), F.col("nodey").alias("b"), "nx", "ny", "bitsx", "bitsy").mapInArrow(_near(percent), "a long, b long"))
    # Longer lists, of members; a group's members are a list too.
    inside = nodes.join(shared, "gid").select(F.bitwise_not("gid").alias("token"), "gid", F.lit(0).alias("pos"), "node", "n")
    lists = posted.where("other is null").select("token", "gid", "pos").join(nodes.select("gid", "node", "n"), "gid").select("token", "gid", "pos", "node", "n")
    lists = staged(lists.union(inside))
    dropped(posted, met, shared)
    # Whole sets of nodes that may have a link, from the texts again.
    ends = staged(nodes.select("node", "least").join(few.select(F.explode(F.array("a", "b")).alias("node")).union(lists.select("node")).distinct(), "node", "left_semi"))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    wanted = spark.sparkContext.broadcast(bitmap(ends.select(place("least").alias("place")), bits))
    sets = docs.select(place("doc_id").alias("h"), "text").mapInArrow(_sets(size, wanted), "node long, shingles binary")
    sets = staged(sets.join(ends.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")))

    def led(now: DataFrame, k: int) -> DataFrame:
        """Pairs of the members of lists with a leader of another label, that parities don't tell apart."""
        lead = now.groupBy("token").agg(F.min_by(F.struct("node", "label", "n", "pos"), F.struct(F.xxhash64("gid", F.lit(k), F.col("token") % 2), "node")).alias("o"))
        both = now.join(lead, "token").select(F.struct("node", "label", "n", "pos").alias("m"), "o")
        both = staged(both.where((F.col("m.label") != F.col("o.label")) & _fits(F.col("m"), F.col("o"), percent)).select(F.col("m.node").alias("a"), F.col("o.node").alias("b")).distinct())
        pairs = staged(_close(both, nodes, percent, bits))
        dropped(both)
        return pairs

    def joined(edges: DataFrame, label: DataFrame) -> DataFrame:
        edges = staged(edges)
        of = [label.withColumnsRenamed({"node": c, "label": f"l{c}"}) for c in "ab"]
        roots = connected_components(edges.join(of[0], "a").join(of[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))).withColumnRenamed("node", "label")
        after = staged(label.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")))
        dropped(edges, label)
        return after

    label = staged(ends.select("node", F.col("node").alias("label")))
    pairs = led(lists.withColumn("label", F.col("node")), 0) if LEADERS else None
    label = joined(_confirmed(few.union(pairs).distinct() if LEADERS else few, sets, percent, bits), label)
    for k in range(1, max(LEADERS, 1) + 1):
        # Only lists whose members are not all joined.
        every = lists.join(label, "node")
        open_ = every.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
        now = staged(every.join(open_, "token"))
        if now.isEmpty():
            dropped(now)
            break
        pairs = led(now, k) if k < LEADERS else _met(now, nodes, sets, percent, bits)
        label = joined(_confirmed(pairs, sets, percent, bits) if k < LEADERS else pairs, label)
        dropped(now, pairs)
    of = nodes.select("node", "least").join(label, "node", "left").select("node", "least", F.coalesce("label", "node").alias("root"))
    of = of.join(of.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    linked = found.join(of, "node", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    dropped(lists, sets, few, ends)
    return linked


def brute_force(texts: list[tuple[int, str | None]], size: int = 4, percent: int = 85) -> list[tuple]:
    """(doc_id, n_shingles, component id) over all pairs; for tests."""
    sets, parent = [], list(range(len(texts)))
    for _, t in texts:
        words = (t or "").encode().translate(LOWER).split()
        sets.append({tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set())

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(texts)]
