"""Best-fit packing of token sequences under several capacities.

Pieces are alike if they have the same number of tokens: a piece of n tokens asks for (n, 1, n * n) of a bin's
tokens, documents and attention cost. So bins are chosen over the histogram of lengths, which has at most as many
entries as a sequence has tokens, however many pieces there are; bins with the same residuals stand as one group
with a count. Each length, longest first, goes to the feasible group that scores best, by least residual norm or
greatest weighted dot product of demand and residual. A length adds at most three groups, so the plan stays within
a bound that the capacity alone sets. Pieces then find their bins by their rank among those of their length.

Nulls and the like: a null or empty text is one piece that holds the end token; rows with a null id are packed like
others; repeated rows are pieces of their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.llm.common import joined, record_batch, staged, trim, tune
from stemma.llm.tokens import WORD_BPE, encoder


@dataclass(frozen=True)
class Capacity:
    """Of one sequence. None: no limit of its own."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None


def plan(counts: dict[int, int], capacity: Capacity, score: str = "norm", weights: tuple[float, float, float] = (1.0, 0.25, 0.25)) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, pieces a bin, first bin, offset): pieces of a length whose rank is in the run lie that
    many to a bin, on end from the offset."""
    limits = [capacity.tokens, capacity.documents, capacity.attention]
    active = [i for i, x in enumerate(limits) if x is not None]
    full = np.array([limits[i] for i in active], float)
    weight = np.array([weights[i] for i in active])
    left = np.zeros((0, len(active)))  # residuals by group
    bins = np.zeros(0, np.int64)  # how many bins, and the number of the first
    first = np.zeros(0, np.int64)
    used = np.zeros(0, np.int64)  # tokens so far
    out, made = [], 0
    for length in sorted(counts, reverse=True):
        todo, rank = counts[length], 0
        need = np.array([(length, 1, length * length)[i] for i in active], float)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens does not fit any sequence")
        while todo:
            fits = np.flatnonzero((left >= need).all(1))
            if fits.size:
                rest = left[fits]
                if score == "norm":
                    best = fits[np.argmin((weight * ((rest - need) / full) ** 2).sum(1))]
                else:
                    best = fits[np.argmax((weight * (need / full) * (rest / full)).sum(1))]
                room = int((left[best] // need).min()) if score == "norm" else 1
            else:
                room = int((full // need).min())
                fresh = -(-todo // room)
                left = np.vstack([left, full])
                bins, first, used = np.append(bins, fresh), np.append(first, made), np.append(used, 0)
                made += fresh
                best = len(bins) - 1
            each = min(room, max(1, todo // int(bins[best])))
            take = min(int(bins[best]), todo // each)
            if take < bins[best]:  # part of the group stays as it is
                left = np.vstack([left, left[best]])
                bins, first, used = np.append(bins, bins[best] - take), np.append(first, first[best] + take), np.append(used, used[best])
                bins[best] = take
            out.append((length, rank, take * each, each, int(first[best]), int(used[best])))
            left[best] -= each * need
            used[best] += each * length
            rank += take * each
            todo -= take * each
        alive = left[:, 0] >= 1
        left, bins, first, used = left[alive], bins[alive], first[alive], used[alive]
    return out


def token_pieces(docs: DataFrame, most: int, tokenizer: str = WORD_BPE, end_id: int = 0, path: str | None = None) -> DataFrame:
    """docs(id, text) -> doc_id, piece, start, length, ids_crc32, and the piece's number among those of its length in its
    part of the table (part, nth), for ranks."""
    tune(docs.sparkSession)
    docs = docs.select(*docs.columns[:2])

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(most + 1, np.int64)
        encode = encoder(tokenizer, path).encode
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())])
        for b in batches:
            if not b.num_rows:
                continue
            ids, at = encode(*joined(b.column(1)))
            ids = np.insert(ids, at[1:], end_id).astype("<u4")
            at = at + np.arange(len(at))
            sizes = np.diff(at)
            pieces = -(-sizes // most)
            doc = np.repeat(np.arange(len(sizes)), pieces)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = nth * most
            length = np.minimum(sizes[doc] - start, most)
            raw = memoryview(ids.tobytes())
            begin = ((at[doc] + start) * 4).tolist()
            crc = [zlib.crc32(raw[i : i + 4 * n]) for i, n in zip(begin, length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            run_at = np.searchsorted(length[order], length[order])
            among = np.empty(len(doc), np.int64)
            among[order] = np.arange(len(doc)) - run_at
            among += seen[length]
            seen += np.bincount(length, minlength=most + 1)
            yield record_batch(schema, b.column(0).take(pa.array(doc)), nth.astype(np.int32), start, length, np.array(crc, np.int64), np.full(len(doc), part, np.int32), among)
        trim()

    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


def pack(docs: DataFrame, capacity: Capacity = Capacity(), score: str = "norm", weights: tuple[float, float, float] = (1.0, 0.25, 0.25), tokenizer: str = WORD_BPE, end_id: int = 0, path: str | None = None) -> DataFrame:
    """docs(id, text, more...) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset. Ids are read as long integers; more is left out."""
    spark = docs.sparkSession
    pieces = staged(token_pieces(docs, capacity.tokens, tokenizer, end_id, path))
    by_part = staged(pieces.groupBy("length", "part").agg(F.max("nth").alias("last")).withColumn("n", F.col("last") + 1))
    # At most capacity.tokens rows, whatever the corpus.
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(counts, capacity, score, weights)
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    # The offsets grow with the parts, so they are merged, not sent everywhere.
    ranked = pieces.join(base.hint("merge"), ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    by_length: dict[int, np.ndarray] = {}
    for length in counts:
        by_length[length] = np.array([r[1:] for r in rows if r[0] == length], np.int64)
    sent = spark.sparkContext.broadcast(by_length)

    def run(batches):
        runs = sent.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            where, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                mine = np.flatnonzero(length == n)
                r = runs[n]
                k = np.searchsorted(r[:, 0], rank[mine], "right") - 1
                i = rank[mine] - r[k, 0]
                where[mine] = r[k, 3] + i // r[k, 2]
                offset[mine] = r[k, 4] + i % r[k, 2] * n
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(where), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
