"""Whitening of embeddings: principal directions by MLlib's singular values of the centred, distributed rows.

An entry c counts as the whole number floor(64 c) + 1,000,000. Sums, and so centres, are exact: a row's deviation from the centre is taken in whole numbers
and divided once. Singular values s of the centred rows give the eigenvalues s^2 / n of the covariance of divisor n. The share that a component explains is of
the total variance, which comes from the exact deviations, not from the values found.

Nulls and the like: rows whose vector is null, empty, or holds a null or non-finite entry are dropped, and so are entries of 2^40 or more in size, which count as
not finite. Of vectors of different dimensions those of the commonest (of equally common ones the greatest) make the space, the others are dropped. Repeated rows
count each. Directions without variance (an eigenvalue under 10^-12 of the greatest) cannot be whitened and give no component; a table without rows or
without variance gives no rows. A deviation beyond a 64-bit number is null there and whole in deviation_exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import record_batch, staged, tune

SCALE, SHIFT = 64, 1_000_000
#: Dimensions up to which all directions are found at once from the dimensions' products on the driver (32 MB of them); beyond, only the leading ones, by iteration over the rows.
DENSE = 2048
_LARGE = float(1 << 40)


def _whole(batches):
    """Of rows that can be used the entries in whole numbers."""
    for b in batches:
        lists = b.column(1)
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        c = lists.flatten().to_numpy(zero_copy_only=False)  # nulls are NaN
        row = np.repeat(np.arange(len(n)), n)
        good = np.isfinite(c) & (np.abs(c) < _LARGE)
        kept = n > 0
        kept[row[~good]] = False
        x = np.floor(c[kept[row]] * SCALE).astype(np.int64) + SHIFT
        at = np.concatenate([[0], np.cumsum(n[kept])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(kept)), pa.ListArray.from_arrays(pa.array(at), pa.array(x))], names=["id", "x"])


def whole_numbers(rows: DataFrame) -> DataFrame:
    """rows(id, vector) -> (id, x), x the vector in whole numbers, of rows that can be used."""
    key, vector = rows.columns
    plain = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    x = staged(plain.mapInArrow(_whole, plain.select("id", F.col("v").cast("array<long>").alias("x")).schema), codec="zstd")
    common = x.groupBy(F.size("x").alias("d")).count().agg(F.max_by("d", F.struct("count", "d"))).first()[0]
    return x.where(F.size("x") == (common or 0))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _summed(batches):
    """Each batch's number of rows and sums by dimension; dimension -1 holds the number."""
    for b in batches:
        if b.num_rows:
            x = _matrix(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, x.shape[1], dtype=np.int32)), pa.array(np.concatenate([[len(x)], x.sum(0)]))], names=["place", "total"])


def centre(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows, and exact sums of their x by dimension."""
    sums = rows.select("x").mapInArrow(_summed, "place int, total long").groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r.place: int(r.total) for r in sums.collect()}  # one number a dimension
    return found.pop(-1, 0), [found[k] for k in sorted(found)]


def directions(rows: DataFrame, n: int, sums: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors as columns, of the covariance of divisor n."""
    d = len(sums)
    place = _away(n, sums)

    def centred(batches):
        for b in batches:
            if b.num_rows:
                v = place(_matrix(b.column(0)))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, d, dtype=np.int32)), pa.array(v.ravel()))], names=["v"])

    vectors = rows.select("x").mapInArrow(centred, "v array<double>").select(array_to_vector("v").alias("v"))
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), 0, d)
    try:
        found = matrix.computeSVD(d if d <= DENSE else min(most, d), computeU=False, rCond=1e-6)
        values, v = found.s.toArray(), found.V.toArray()  # falling
    except Exception as e:  # MLlib refuses a matrix of zeros
        if "zero singular" not in str(e) and "singular values" not in str(e):
            raise
        return np.zeros(0), np.zeros((d, 0))
    some = values[:most] > 1e-6 * max(values[0], 1e-300)
    return (values[:most][some]) ** 2 / n, v[:, :most][:, some]


def _away(n: int, sums: list[int]):
    """x -> its distance from the centre, whole parts first."""
    whole, part = np.array([s // n for s in sums]), np.array([s % n / n for s in sums])
    return lambda x: (x - whole) - part


def _projected(n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
    """x -> whitened components, one row each."""
    place, turn = _away(n, sums), vectors / np.sqrt(values)
    return lambda x: place(x) @ turn


def _products(project, means: np.ndarray):
    """Of all rows of a task the sums of products of centred whitened components."""

    def run(batches):
        total = np.zeros((len(means), len(means)))
        for b in batches:
            if b.num_rows:
                w = project(_matrix(b.column(0))) - means
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["place", "total"])

    return run


def _means(project, k: int):
    def run(batches):
        total = np.zeros(k)
        for b in batches:
            if b.num_rows:
                total += project(_matrix(b.column(0))).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(total)], names=["place", "total"])

    return run


def _by_place(rows: DataFrame, f, size: int) -> np.ndarray:
    """Sums of what tasks have summed, a bounded number of places."""
    got = rows.select("x").mapInArrow(f, "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    out = np.zeros(size)
    for r in got:
        out[r.place] = r.total
    return out


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Of each row the exact sum over dimensions of (n x - sum)^2."""
    whole, part = np.array([s // n for s in sums]), np.array([s % n for s in sums])
    # n x - sum = n (x - whole) - part
    away = x - whole
    most = n * float(np.abs(away).max(initial=0)) + n
    if most * most * x.shape[1] < 2.0**62:
        y = away * n - part
        return (y * y).sum(1).tolist()
    return [sum((n * a - p) ** 2 for a, p in zip(row, part.tolist(), strict=True)) for row in away.tolist()]


def _components(n: int, sums: list[int], project, k: int):
    def run(batches):
        for b in batches:
            schema = pa.schema([("id", b.column(0).type), ("component", pa.int32()), ("exact", pa.string()), ("whitened", pa.float64())])
            for a in range(0, b.num_rows, 1024):
                some = b.slice(a, 1024)
                x = _matrix(some.column(1))
                each = np.repeat(np.arange(len(x)), k)
                exact = pa.array([str(v) for v in deviations(x, n, sums)], pa.string()).take(pa.array(each))
                yield record_batch(schema, some.column(0).take(pa.array(each)), np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), exact, project(x).ravel())

    return run


def _deviated(n: int, sums: list[int]):
    """Of all rows of a task the sum of their deviations, exactly."""

    def run(batches):
        total = sum(sum(deviations(_matrix(b.column(0)), n, sums)) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array([str(total)])], names=["total"])

    return run


def whiten(rows: DataFrame, most: int = 32) -> DataFrame:
    """rows(id, vector), more columns left out -> (id, component, n, deviation, whitened, explained, identity_error, deviation_exact) for each row and component up to ``most``.

    Sums, products and the proof of whiteness are each one pass in which tasks hand on a fixed number of sums; the rows themselves are never exchanged, only written once as whole numbers."""
    tune(rows.sparkSession)
    key = rows.columns[0]
    x = whole_numbers(rows.select(*rows.columns[:2]))
    n, sums = centre(x)
    values, vectors = directions(x, n, sums, most) if n else (np.zeros(0), np.zeros((0, 0)))
    if not len(values):
        return x.where("false").select(F.col("id").alias(key), *(F.lit(0).cast(t).alias(c) for c, t in (("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"), ("deviation_exact", "string"))))
    k, project = len(values), _projected(n, sums, values, vectors)
    # The sum of deviations is n^3 times the total variance; tasks' sums of any length are added as whole numbers, one a task.
    total = x.select("x").mapInArrow(_deviated(n, sums), "total string").agg(F.sum(F.col("total").cast("double"))).first()[0]
    explained = (values * float(n) ** 3 / total).tolist()
    means = _by_place(x, _means(project, k), k) / n
    covariance = _by_place(x, _products(project, means), k * k).reshape(k, k) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    shares = F.element_at(F.array(*(F.lit(e) for e in explained)), F.col("component"))
    schema = x.select("id").withColumns({"component": F.lit(0), "exact": F.lit(""), "whitened": F.lit(0.0)}).schema
    out = x.mapInArrow(_components(n, sums, project, k), schema)
    return out.select(
        F.col("id").alias(key), "component", F.lit(n).cast("long").alias("n"), F.expr("try_cast(exact as long)").alias("deviation"), "whitened", shares.alias("explained"), F.lit(error).alias("identity_error"), F.col("exact").alias("deviation_exact")
    )
