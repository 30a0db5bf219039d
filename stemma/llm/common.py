"""Helpers shared by the corpus operators: tables, shared work folder, Arrow plumbing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII-only lower-casing that leaves every other byte alone.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small in bytes: texts may be very long, workers are small. The session keeps the setting, as results are computed when they are read."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    except Exception:  # an older Spark without the setting bounds batches by rows alone
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folder of this process on a single machine without a shared one.
_LOCAL: list[str] = []
#: Setting under which a query's shuffle files go when it has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder, ``spark.checkpoint.dir``. Only a session on one machine may do without the
    setting (tests): it gets a temporary folder there."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="stemma-"))
        root = _LOCAL[0]
    return f"{root.rstrip('/')}/stemma-{uuid.uuid4().hex}"


def staged(df: DataFrame, codec: str = "snappy", options: dict[str, str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage is cut and a lost executor
    costs no recomputation. Shuffle files of the writing go with its end; those of the table stay until ``dropped``."""
    spark = df.sparkSession
    path = shared_dir(spark)
    before = spark.conf.get(_CLEAN, None)
    try:
        spark.conf.set(_CLEAN, "true")
        df.write.options(**(options or {})).option("compression", codec).parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes the files of staged tables that nothing reads any more."""
    for t in tables:
        hadoop = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs
        path = hadoop.Path(t.staged_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bitmap(places: DataFrame, bits: int) -> bytes:
    """places(place), numbers from 0 and below bits -> that many bits, the places' set. Tasks fill blocks of 4 KB; all that comes to the driver is the bitmap."""
    # The built-in bitmaps count bits and buckets from 1.
    found = places.select((F.col("place") + 1).alias("place")).groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    out = np.zeros(max(1, bits >> 15), "V4096")
    for r in found.collect():
        out[r.bucket - 1] = np.void(bytes(r.bits))
    return out.tobytes()


def trim() -> None:
    """Gives memory that a worker has freed back to the system, before its next task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column: pa.Array) -> list[bytes]:
    """Python bytes of a binary column; null is empty."""
    return [x or b"" for x in column.to_pylist()]


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column on end, and each value's offset (one more than values). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def gathered(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Join small batches up to about ``limit`` bytes each."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _planes(x: np.ndarray) -> Iterator[np.ndarray]:
    """Of rows: each field's bytes, the lowest of all rows first; they may be written."""
    whole = x.view(np.uint8).reshape(len(x), x.dtype.itemsize)
    for kind, at in (x.dtype.fields[f][:2] for f in x.dtype.names):
        for k in range(at, at + kind.itemsize):
            yield whole[:, k]


def pack(x: np.ndarray) -> bytes:
    """Rows as a compressed frame, field by field: like bytes lie together."""
    x = np.ascontiguousarray(x)
    n = len(x)
    raw = np.empty(8 + x.nbytes, np.uint8)
    raw[:8] = np.frombuffer(n.to_bytes(8, "little"), np.uint8)
    for k, plane in enumerate(_planes(x)):  # a strided copy each; tobytes() of the transposed rows goes byte by byte
        raw[8 + k * n : 8 + (k + 1) * n] = plane
    return _zstd()[0].compress(raw)


@cache
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """This process's, as making one for each frame costs more than a small frame."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def unpack(body: bytes, kind: np.dtype) -> np.ndarray:
    raw = np.frombuffer(_zstd()[1].decompress(body), np.uint8)
    n = int.from_bytes(raw[:8].tobytes(), "little")
    out = np.empty(n, kind)
    for k, plane in enumerate(_planes(out)):
        plane[:] = raw[8 + k * n : 8 + (k + 1) * n]
    return out


def groups(batches) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Rows (route, kind, payload) sorted by route, a whole route at a time."""
    now, held = None, []
    for b in batches:
        for r, k, x in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if r != now:
                if held:
                    yield now, held
                now, held = r, []
            held.append((k, x))
    if held:
        yield now, held


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers without pattern."""
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def word_hashes(words: pa.Array) -> np.ndarray:
    """56 bits of each word, from its length and its bytes by eights."""
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.append(np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(8, np.uint8))
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    n = np.diff(at)
    out, live, k = mix64(n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.arange(len(n)), 0
    while live.size:
        left = np.minimum(n[live] - 8 * k, 8)
        x = eights[at[live] + 8 * k]
        x = np.where(left < 8, x & (np.uint64(1) << (left % 8 * 8).astype(np.uint64)) - np.uint64(1), x)
        out[live] = mix64(out[live] + x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1))
        k += 1
        live = live[n[live] > 8 * k]
    return out >> np.uint64(8)


def words_by_number(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
    """Of texts: the different words (A-Z lower-cased, parted by ASCII white space), each place's word by number, its text, and how many texts there are."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text.fill_null("")))
    flat, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    word, of, names = coded.indices.to_numpy(), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), coded.dictionary
    blank = names.index("").as_py()
    if blank >= 0:  # white space at a text's edge
        some = word != blank
        word, of = word[some], of[some]
    return names, word, of, len(sizes)
