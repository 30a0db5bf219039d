"""Token ids in grammar-compressed shards.

A shard is the ids of consecutive documents, compressed by Re-Pair in parallel rounds: count the pairs of
neighbours, rank the pairs by count, replace each pair that ranks before both pairs overlapping it (of equal
ones the leftmost) by a nonterminal of its own, and go on until no round replaces any pair in three places; pairs that only get in each other's way may be left. While a round saves much, pairs are counted
by the slots of a hash table, and of those that want one slot one waits for another round; after that all are counted exactly. Rules, their expansion lengths and the
final symbols are stored, with the position of every k-th symbol in the expansion, so any range of ids is decoded without the rest.

File format, all little-endian: ``RPG1``; uint32 first nonterminal, rules, symbols, k; then, each as uint32 length and zstd frame:
rule pairs (2 x uint32), expansion lengths (uint32), symbols (uint32), positions (uint64), tokens by document (uint32). A file is a Parquet
table of shards: part, shard, before (ids before it in its part), first and last document, tokens, documents, body.

Nulls and the like: a null or empty text holds the end id alone; null document ids come first; rows that repeat an id lie
side by side, in the order of their texts; an empty table gives an empty file.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stemma.llm.common import gathered, joined, record_batch, shared_dir, shuffle_partitions, tune
from stemma.llm.tokens import BYTE_BPE, encoder

MAGIC = b"RPG1"
STRIDE = 4096
_SLOTS = 18


def _apart(weight: np.ndarray) -> np.ndarray:
    """Places of pairs to replace: those of a positive weight that is more than that of the pairs overlapping them, every second of a run of equals."""
    n = len(weight)
    ahead = weight > 0
    ahead[1:] &= weight[1:] > weight[:-1]
    ahead[:-1] &= weight[:-1] >= weight[1:]
    tie = np.zeros(n, bool)
    tie[1:] = weight[1:] == weight[:-1]
    tie &= weight > 0
    if tie.any():
        edge = np.flatnonzero(np.diff(np.concatenate([[False], tie, [False]])))
        first, end = edge[::2] - 1, edge[1::2]
        # A run is taken whole where no neighbour outranks its ends.
        good = (first < 1) | (weight[first] > weight[np.maximum(first - 1, 0)])
        good &= (end >= n) | (weight[end - 1] >= weight[np.minimum(end, n - 1)])
        size = end - first
        places = np.repeat(first, size) + (inner := np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
        ahead[places] = np.repeat(good, size) & (inner % 2 == 0)
    at = np.flatnonzero(ahead)
    # Never both of two that overlap: of neighbours every second.
    near = np.flatnonzero(np.diff(at) == 1) + 1
    if near.size:
        begin = np.ones(len(at), bool)
        begin[near] = False
        run = np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
    return at


def _by_slots(pair: np.ndarray, round_: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Each place's pair by number (0: none), and the pairs by number: counted in a table's slots, where the last of several pairs holds the slot."""
    mix = np.uint64((0x9E3779B97F4A7C15 * (2 * round_ + 1)) & (1 << 64) - 1)
    slot = ((pair * mix) >> np.uint64(64 - _SLOTS)).astype(np.int32)
    holder = np.zeros(1 << _SLOTS, np.uint64)
    holder[slot] = pair
    mine = holder[slot] == pair
    count = np.bincount(slot[mine], minlength=1 << _SLOTS)
    live = np.flatnonzero(count >= least)
    live = live[np.argsort(count[live], kind="stable")]
    rank = np.zeros(1 << _SLOTS, np.int32)
    rank[live] = np.arange(1, len(live) + 1, dtype=np.int32)
    weight = rank[slot]
    weight *= mine
    return weight, np.concatenate([[np.uint64(0)], holder[live]])


def _exactly(seq: np.ndarray, round_: int, least: int, some: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The same, of all pairs, counted by sorting. some: places that can hold a pair that is frequent enough; a table of all pairs tells where None is known."""
    if some is None:
        pair = seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:]
        mix = np.uint64((0x9E3779B97F4A7C15 * (2 * round_ + 1)) & (1 << 64) - 1)
        slot = ((pair * mix) >> np.uint64(64 - _SLOTS - 2)).astype(np.int32)
        some = np.flatnonzero((np.bincount(slot, minlength=1 << _SLOTS + 2) >= least)[slot])
    kinds, where, count = np.unique(seq[some].astype(np.uint64) << np.uint64(32) | seq[some + 1], return_inverse=True, return_counts=True)
    live = np.flatnonzero(count >= least)
    live = live[np.argsort(count[live], kind="stable")]
    rank = np.zeros(len(kinds), np.int32)
    rank[live] = np.arange(1, len(live) + 1, dtype=np.int32)
    weight = np.zeros(len(seq) - 1, np.int32)
    weight[some] = rank[where]
    return weight, np.concatenate([[np.uint64(0)], kinds[live]])


def compress(ids: np.ndarray, much: float = 0.03) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, rules (pairs of symbols) and the first nonterminal's number. much: the share of symbols that a round by slots has to save."""
    first = int(ids.max()) + 1 if len(ids) else 0
    seq = ids.astype(np.uint32)
    rules = [np.zeros((0, 2), np.uint32)]
    top, round_, exact, some = first, 0, False, None
    while len(seq) > 3:
        n = len(seq)
        if exact:
            weight, kinds = _exactly(seq, round_, 3, some)
        else:
            weight, kinds = _by_slots(seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:], round_, 4)
        at = _apart(weight)
        of = weight[at]
        used = np.bincount(of, minlength=len(kinds))
        good = used[of] >= 3
        at, of = at[good], of[good]
        round_ += 1
        if len(at) < much * n and not exact:
            exact = True
            continue
        if not len(at):
            break
        live = np.flatnonzero(used >= 3)
        number = np.zeros(len(kinds), np.uint32)
        number[live] = top + np.arange(len(live), dtype=np.uint32)
        rules.append(np.stack([(kinds[live] >> np.uint64(32)).astype(np.uint32), (kinds[live] & np.uint64(0xFFFFFFFF)).astype(np.uint32)], 1))
        seq[at] = number[of]
        stay = np.ones(n, bool)
        stay[at + 1] = False
        if exact:
            # Only pairs that were frequent and are still there, and pairs with a symbol made just now, can be frequent next.
            made = np.zeros(n, bool)
            made[at] = True
            left = np.append(weight > 0, False)[stay]
            made = made[stay]
            some = np.flatnonzero(left[:-1] | made[:-1] | made[1:])
        seq = seq[stay]
        top += len(live)
    return seq, np.concatenate(rules), first


def expansions(rules: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every symbol (terminals of one length among them): length, place in a dictionary of expansions, the dictionary."""
    n = len(rules)
    length = np.ones(first + n, np.int64)
    level = np.zeros(first + n, np.int64)
    todo = np.arange(n)
    # A rule's symbols are older than the rule; whole rounds of rules resolve at a time.
    done = 0
    while done < n:
        ready = (rules[done:] < first + done).all(1)
        upto = n if ready.all() else done + int(np.argmin(ready))
        r = rules[done:upto]
        length[first + done : first + upto] = length[r[:, 0]] + length[r[:, 1]]
        level[first + done : first + upto] = np.maximum(level[r[:, 0]], level[r[:, 1]]) + 1
        done = upto
    at = np.concatenate([[0], np.cumsum(length)])
    out = np.zeros(at[-1], np.uint32)
    out[:first] = np.arange(first)
    for k in range(1, int(level.max(initial=0)) + 1):
        mine = todo[level[first:] == k]
        for side in range(2):
            s = rules[mine, side]
            to = at[first + mine] + (length[rules[mine, 0]] if side else 0)
            m = length[s]
            steps = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            out[np.repeat(to, m) + steps] = out[np.repeat(at[s], m) + steps]
    return length, at, out


def expand(symbols: np.ndarray, length: np.ndarray, at: np.ndarray, words: np.ndarray) -> np.ndarray:
    n = length[symbols]
    ends = np.cumsum(n)
    return words[np.repeat(at[symbols] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


def write_body(ids: np.ndarray, counts: np.ndarray) -> bytes:
    symbols, rules, first = compress(ids)
    length = expansions(rules, first)[0]
    starts = np.concatenate([[0], np.cumsum(length[symbols])])
    pack = zstandard.ZstdCompressor(level=1).compress
    frames = [rules.astype("<u4"), length[first:].astype("<u4"), symbols.astype("<u4"), starts[:-1:STRIDE].astype("<u8"), counts.astype("<u4")]
    body = [MAGIC, struct.pack("<4I", first, len(rules), len(symbols), STRIDE)]
    for f in frames:
        z = pack(f.tobytes())
        body += [struct.pack("<I", len(z)), z]
    return b"".join(body)


class Shard:
    """Reads a body; ids(a, b) decodes that range alone."""

    def __init__(self, body: bytes):
        if body[:4] != MAGIC:
            raise ValueError("not a grammar shard")
        self.first, n, m, self.stride = struct.unpack_from("<4I", body, 4)
        at, raw = 20, []
        unpack = zstandard.ZstdDecompressor().decompress
        for _ in range(5):
            (size,) = struct.unpack_from("<I", body, at)
            raw.append(unpack(body[at + 4 : at + 4 + size]))
            at += 4 + size
        self.rules = np.frombuffer(raw[0], "<u4").reshape(n, 2)
        self.symbols = np.frombuffer(raw[2], "<u4")
        self.positions = np.frombuffer(raw[3], "<u8").astype(np.int64)
        self.counts = np.frombuffer(raw[4], "<u4").astype(np.int64)
        self.tables = expansions(self.rules, self.first)
        if len(self.symbols) != m or not np.array_equal(self.tables[0][self.first :], np.frombuffer(raw[1], "<u4")):
            raise ValueError("damaged grammar shard")

    def ids(self, a: int | None = None, b: int | None = None) -> np.ndarray:
        if a is None:
            return expand(self.symbols, *self.tables)
        k = int(np.searchsorted(self.positions, a, "right")) - 1
        j = int(np.searchsorted(self.positions, b, "left"))
        return expand(self.symbols[k * self.stride : j * self.stride], *self.tables)[a - self.positions[k] : b - self.positions[k]]


def write_shards(docs: DataFrame, path: str, tokenizer: str = BYTE_BPE, end_id: int = 2, shard_bytes: int = 4 << 20, tokenizer_path: str | None = None) -> None:
    """docs(doc_id, text, more...) to a file of shards, in ascending order of doc_id, a long integer; more is left out. A shard holds the documents of about shard_bytes of text."""
    spark = docs.sparkSession
    tune(spark)
    key, text = docs.columns[:2]
    # Equal ids lie in one range; more ranges than keys do no harm.
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    docs = docs.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("tokens", pa.int64()), ("documents", pa.int64()), ("doc_ids", pa.binary()), ("body", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        part, shard, before = TaskContext.get().partitionId(), 0, 0
        encode = encoder(tokenizer, tokenizer_path).encode
        for b in gathered(batches, shard_bytes):
            ids, at = encode(*joined(b.column(1)))
            ids = np.insert(ids, at[1:], end_id)
            counts = np.diff(at) + 1
            keys = b.column(0).to_pylist()
            # ids as int64 with a leading byte that is 0 for null
            named = b"".join(b"\0" * 9 if k is None else b"\1" + struct.pack("<q", k) for k in keys)
            yield record_batch(schema, [part], [shard], [before], [keys[0]], [keys[-1]], [len(ids)], [len(keys)], [zstandard.compress(named, 1)], [write_body(ids, counts)])
            shard, before = shard + 1, before + len(ids)

    docs.mapInArrow(run, "part int, shard int, before long, first_doc long, last_doc long, tokens long, documents long, doc_ids binary, body binary").write.option("compression", "none").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document of such a file: doc_id, start, n_tokens, ids_crc32, from the decoded ids."""
    tune(spark)
    shards = spark.read.parquet(path)
    # One row for each part, however many shards: their totals give where each part begins.
    totals = shards.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    starts = totals.select("part", F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    shards = shards.select("part", "before", "doc_ids", "body").join(starts, "part")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for before, base, named, body in zip(*(b.column(c).to_pylist() for c in ("before", "base", "doc_ids", "body")), strict=True):
                s = Shard(body)
                ids = memoryview(s.ids().astype("<u4").tobytes())
                at = np.concatenate([[0], np.cumsum(s.counts)])
                raw = np.frombuffer(zstandard.decompress(named), np.uint8).reshape(-1, 9)
                keys = pa.array(np.ascontiguousarray(raw[:, 1:]).view("<i8")[:, 0], mask=raw[:, 0] == 0)
                crc = [zlib.crc32(ids[4 * i : 4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield record_batch(schema, keys, at[:-1] + before + base, s.counts, np.array(crc, np.int64))

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes docs(doc_id, text) and reads the file back."""
    path = path or shared_dir(docs.sparkSession)
    write_shards(docs, path)
    return read_shards(docs.sparkSession, path)
