"""Near copies by Jaccard similarity of word shingles: candidates by SimHash fingerprints and covering anchors (``simhash``), then, for what differs in more bits, by MinHash bands; each is
confirmed on the whole sets.

Documents with equal shingle sets are one node. Nodes whose fingerprints are linked at three bits or fewer are joined first, where their sets are similar. Nodes that share a band are candidates: at the least similarity that counts, a pair shares none of BANDS
bands of ROWS values with probability (1 - least ** ROWS) ** BANDS, 7 in 100,000 at 0.8. In LEADERS rounds the members of a band that are not all joined meet one
of them, another one each round and for every other band, so that a large group of near copies needs no pairs. After that those of a band's members that are still apart from the
most of them meet each of its members: both are dealt by band, large bands over a grid of shares, and compared where they meet, so no pair that a band holds
goes unseen and only links between what is not joined yet are written. A pair is first judged by the values that its signatures share, five standard
deviations below what the least similarity lets expect, then by its sets: members' sets travel to their leader's, a leader with many
members stands in several tasks.

Nulls and the like: texts without words have no shingles and link to nothing; a text of fewer words than a shingle is one shingle; a null id never is a
component's id unless all of its members' are null. Equality of 64-bit hashes stands in for equality of sets, of 32-bit ones for that of a pair's shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import LOWER, as_bytes, dropped, mix64, record_batch, shuffle_partitions, staged, trim, tune, word_hashes, words_by_number
from stemma.llm.components import connected_components
from stemma.llm.simhash import fingerprint, links

BANDS, ROWS, LEADERS = 24, 5, 4
#: Bits in which linked fingerprints differ at most.
BITS = 3
#: Members that one task compares with a leader, or holds of those that are apart.
SHARE = 2000
_FACTORS = np.random.default_rng(64).integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)


def shingle_sets(text: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Of each text the sorted hashes of its different shingles."""
    names, word, of, texts = words_by_number(text)
    h = word_hashes(names)[word] if len(word) else np.zeros(0, np.uint64)
    # Of every place its word and those after it, one further each time, as far as the text goes.
    end = np.cumsum(np.bincount(of, minlength=texts))
    first = np.concatenate([[0], end[:-1]])
    out, at = mix64(h), np.arange(len(h))
    for k in range(1, size):
        far = at + k < end[of]
        out[far] = mix64(out[far] + h[at[far] + k] * np.uint64(0x9FB21C651E98DF25))
    # The last places' runs are too short, but for that of a text's first place.
    whole = (at + size <= end[of]) | (at == first[of])
    out, of = out[whole], of[whole]
    cuts = np.searchsorted(of, np.arange(texts + 1))
    return [np.unique(out[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def least_values(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set that is not empty."""
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(low, (_FACTORS[:, None] * shingles[None, i : i + 512]).min(1), out=low)
    return low


def _node(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) if len(shingles) else 0


def _sets(size: int):
    """Of each text its node and its shingles, 32 bits of each, as bytes."""

    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(0), size)
            nodes = np.array([_node(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([np.unique(s >> np.uint64(32)).astype("<u4").tobytes() for s in sets], pa.binary())], names=["node", "shingles"])
        trim()

    return run


def _signed(size: int):
    """Of each text its node, the number of its shingles, its fingerprint, the keys of its bands, and a byte of each value."""

    def run(batches):
        for b in batches:
            nodes, sizes, keys, signs = [], [], [], []
            for s in shingle_sets(b.column(1), size):
                nodes.append(_node(s))
                sizes.append(len(s))
                low = least_values(s) if len(s) else np.zeros(0, np.uint64)
                keys.append([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(low.reshape(-1, ROWS))])
                signs.append(low.astype(np.uint8).tobytes())
            at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            values = np.array([x for k in keys for x in k], np.uint64).view(np.int64)
            fps = np.array([fingerprint(t, size) for t in as_bytes(b.column(1).cast(pa.binary()))], np.uint64).view(np.int64)
            columns = [b.column(0), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(np.array(sizes, np.int32)), pa.array(fps), pa.ListArray.from_arrays(pa.array(at), pa.array(values)), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "fp", "bands", "signature"])
        trim()

    return run


def _alike(least: float):
    """Of pairs with signatures those that may be similar."""
    values = BANDS * ROWS
    enough = values * least - 5 * math.sqrt(values * least * (1 - least))

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(b.num_rows, -1) for i in (2, 3))
                good = pa.array((x == y).sum(1) >= enough)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(good), b.column(1).filter(good)], names=["a", "b"])

    return run


def _apart(least: float):
    """Rows (band, cell, apart, node, label, n, bands, signature, shingles) by band and cell, those apart first: links (a, b) between the labels of
    different rows. A pair is compared in the first band that both have."""
    values = BANDS * ROWS
    enough = values * least - 5 * math.sqrt(values * least * (1 - least))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        now, held, told = None, [], None
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        for b in batches:
            out = []
            for band, cell, apart, node, label, n, bands, signature, shingles in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (band, cell) != now:
                    now, held, told, root = (band, cell), [], None, {}
                mine = (node, label, n, np.array(bands, np.int64), np.frombuffer(signature, np.uint8), np.frombuffer(shingles, "<u4"))
                if apart:
                    held.append(mine)
                    continue
                if not held:
                    continue
                if told is None:
                    told = [np.array([h[k] for h in held]) for k in range(5)]
                sizes = told[2]
                good = (np.minimum(sizes, n) >= least * np.maximum(sizes, n)) & (told[1] != label)
                at = np.flatnonzero(good)
                at = at[(told[4][at] == mine[4]).sum(1) >= enough]
                if at.size:
                    shared = told[3][at] == mine[3]
                    at = at[mine[3][shared.argmax(1)] == band]
                for i in at.tolist():
                    x, y = find(int(told[1][i])), find(label)
                    if x == y:
                        continue
                    own, other = held[i][5], mine[5]
                    place = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    same = int((own[place] == other).sum())
                    if same >= least * (len(own) + len(other) - same):
                        root[x] = y
                        out.append((int(told[0][i]), node))
            yield record_batch(schema, [x[0] for x in out], [x[1] for x in out])

    return run


def _met(now: DataFrame, nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """now(band, node, n, label): links of those of a band's members whose label is not that of most of them, with any of its members."""
    most = now.groupBy("band", "label").count().groupBy("band").agg(F.max_by("label", F.struct("count", "label")).alias("most"), F.sum("count").alias("all"), F.max("count").alias("joined"))
    cells = most.select("band", "most", F.ceil(F.col("all") / (2 * SHARE)).cast("int").alias("members"), F.ceil((F.col("all") - F.col("joined")) / SHARE).cast("int").alias("strangers"))
    full = now.join(cells, "band").join(nodes.select("node", "bands", "signature"), "node").join(sets, "node")
    grid = lambda mine, others, cell: F.transform(F.sequence(F.lit(0), others - 1), lambda k: cell(F.pmod(F.xxhash64("node"), mine).cast("int"), k))
    members, strangers = F.col("members"), F.col("strangers")
    every = full.withColumn("cell", F.explode(grid(members, strangers, lambda own, k: own * strangers + k))).withColumn("apart", F.lit(False))
    few = full.where("label <> most").withColumn("cell", F.explode(grid(strangers, members, lambda own, k: k * strangers + own))).withColumn("apart", F.lit(True))
    names = ("band", "cell", "apart", "node", "label", "n", "bands", "signature", "shingles")
    rows = few.select(*names).union(every.select(*names)).repartition(shuffle_partitions(now.sparkSession), "band", "cell").sortWithinPartitions("band", "cell", F.desc("apart"), "node")
    return rows.mapInArrow(_apart(least), "a long, b long")


def _compared(least: float):
    """Rows (leader, share, node, shingles) by leader and share, the leader's own, of a null node, first: the pairs that are similar."""

    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        now, own = None, None
        for b in batches:
            a_side, b_side = [], []
            for lead, share, node, body in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                mine = np.frombuffer(body, "<u4")
                if node is None:
                    now, own = (lead, share), mine
                elif now == (lead, share):
                    at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                    same = int((own[at] == mine).sum())
                    if same >= least * (len(own) + len(mine) - same):
                        a_side.append(node)
                        b_side.append(lead)
            yield record_batch(schema, a_side, b_side)

    return run


def _confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Of different pairs (a, b) of nodes, b the leaders, those that are similar."""
    signs = nodes.select("node", "signature")
    both = pairs.join(signs.withColumnsRenamed({"node": "a", "signature": "x"}), "a").join(signs.withColumnsRenamed({"node": "b", "signature": "y"}), "b")
    pairs = staged(both.select("a", "b", "x", "y").mapInArrow(_alike(least), "a long, b long"))
    shares = F.ceil(F.count("*") / SHARE).cast("int")
    leads = pairs.groupBy("b").agg(shares.alias("shares"))
    members = pairs.join(leads, "b").join(sets, F.col("a") == F.col("node")).select("b", F.pmod(F.xxhash64("a"), F.col("shares")).cast("int").alias("share"), F.col("a").alias("node"), "shingles")
    own = leads.join(sets, F.col("b") == F.col("node")).select("b", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(None).cast("long").alias("node"), "shingles")
    rows = own.union(members).repartition(shuffle_partitions(pairs.sparkSession), "b", "share").sortWithinPartitions("b", "share", F.col("node").asc_nulls_first())
    return rows.mapInArrow(_compared(least), "a long, b long")


def _close(found: DataFrame, most: int) -> DataFrame:
    """found(node, n, fp) -> pairs (a, b) of nodes whose fingerprints are equal or linked at most bits, b the least node of its fingerprint."""
    marked = staged(found.where("n > 0").select("fp", "node").distinct())
    leads = staged(marked.groupBy("fp").agg(F.min("node").alias("lead")))
    of = [leads.withColumnsRenamed({"fp": c, "lead": f"l{c}"}) for c in "ab"]
    across = links(leads.select("fp"), most).distinct().join(of[0], "a").join(of[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    within = marked.join(leads, "fp").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    pairs = staged(across.union(within).where("a <> b").distinct())
    dropped(marked, leads)
    return pairs


def _joined(label: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes' labels after the labels that edges (a, b) of nodes connect have become one."""
    of = [label.withColumnsRenamed({"node": c, "label": f"l{c}"}) for c in "ab"]
    joins = edges.join(of[0], "a").join(of[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    roots = connected_components(joins).withColumnRenamed("node", "label")
    after = staged(label.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")))
    dropped(edges, label)
    return after


def similar_groups(docs: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, component_id): the least id reachable over pairs of a Jaccard similarity of least or more."""
    tune(docs.sparkSession)
    key, text = docs.columns
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = docs.select("doc_id").withColumns({"node": F.lit(0).cast("long"), "n": F.lit(0), "fp": F.lit(0).cast("long"), "bands": F.expr("cast(array() as array<long>)"), "signature": F.lit(b"")}).schema
    found = staged(docs.mapInArrow(_signed(size), schema))
    named = staged(found.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature")))
    banded = named.select(F.explode("bands").alias("band"), "node", "n")
    banded = staged(banded.join(banded.groupBy("band").count().where("count > 1").select("band"), "band"))
    close = _close(found, BITS)
    candidates = banded.select("node").union(close.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    nodes = staged(named.join(candidates, "node", "left_semi").select("node", "least", "signature", "bands"))
    # Whole sets only of nodes that have a candidate, from the texts again.
    again = docs.join(nodes.select("least").distinct(), F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
    sets = again.select("text").mapInArrow(_sets(size), "node long, shingles binary")
    sets = staged(sets.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")))
    label = _joined(staged(nodes.select("node", F.col("node").alias("label"))), staged(_confirmed(close, nodes, sets, least)))
    dropped(close)
    for k in range(LEADERS + 1):
        # Only bands whose members are not all joined.
        every = banded.join(label, "node")
        apart = every.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("band")
        now = staged(every.join(apart, "band"))
        if not now.limit(1).count():
            dropped(now)
            break
        if k < LEADERS:
            lead = now.groupBy("band").agg(F.min_by(F.struct("node", "label", "n"), F.xxhash64("node", F.lit(k), F.col("band") % 2)).alias("o"))
            met = now.join(lead, "band").select("node", "label", "n", F.col("o.node").alias("other"), F.col("o.label").alias("other_label"), F.col("o.n").alias("m"))
            met = met.where((F.col("label") != F.col("other_label")) & (F.least("n", "m") >= least * F.greatest("n", "m")))
            pairs = staged(met.select(F.col("node").alias("a"), F.col("other").alias("b")).distinct())
            edges = staged(_confirmed(pairs, nodes, sets, least))
            dropped(pairs)
        else:
            edges = staged(_met(now, nodes, sets, least))
        label = _joined(label, edges)
        dropped(now)
    of = named.select("node", "least").join(label, "node", "left").select("node", "least", F.coalesce("label", "node").alias("root"))
    lead = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(lead, "root").select("node", "component_id")
    linked = found.select("doc_id", "node").join(of, "node").select("doc_id", "component_id")
    dropped(banded, nodes, sets)
    return linked.union(found.where("n = 0").select("doc_id", F.col("doc_id").alias("component_id")))


def brute_force(texts: dict[int, str | None], size: int = 5, least: float = 0.8) -> dict[int, int]:
    """doc_id -> component id over all pairs; for tests."""
    sets = {}
    for i, t in texts.items():
        words = (t or "").encode().translate(LOWER).split()
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in sets.items():
        for j, y in sets.items():
            if i < j and x and y and min(len(x), len(y)) >= least * max(len(x), len(y)):
                same = len(x & y)
                if same >= least * (len(x) + len(y) - same):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return {i: root(i) for i in texts}
