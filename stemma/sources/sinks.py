"""Outputs, by Spark's own commit protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.operators.catalogue import order_catalogue
from stemma.operators.order import numbered


def append_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """Rows in their total order: files in name order, lines in file order."""
    order_catalogue(catalogue).write.mode("overwrite").json(path)


def write_array(df: DataFrame, path: str, order: list) -> None:
    """One JSON document: an array of all rows in their order. Tasks write the rows' texts by ranges of the order, with the comma that stands before each but the first; when all
    of them are there, the parts are put on end, piece by piece, and the document gets its name. Until then nothing is to be seen under it, and what a failed run has left goes."""
    spark = df.sparkSession
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    io = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target, parts = fs.Path(path), fs.Path(f"{path}.parts")
    files = target.getFileSystem(conf)
    try:
        rows = numbered(df, order, "__n").select(F.col("__n"), F.to_json(F.struct(*df.columns)).alias("json"))
        lines = rows.select("__n", F.concat(F.when(F.col("__n") == 0, "").otherwise(","), "json").alias("value"))
        lines.repartitionByRange("__n").sortWithinPartitions("__n").select("value").write.mode("overwrite").text(f"{path}.parts")
        whole = fs.Path(f"{path}.parts/_whole")
        out = files.create(whole, True)
        try:
            out.write(bytearray(b"[\n"))
            for name in sorted(s.getPath().getName() for s in files.listStatus(parts)):
                if name.startswith("part-"):
                    part = files.open(fs.Path(parts, name))
                    try:
                        io.copyBytes(part, out, 1 << 16, False)
                    finally:
                        part.close()
            out.write(bytearray(b"]\n"))
        finally:
            out.close()
        files.delete(target, True)
        if not files.rename(whole, target):
            raise OSError(f"cannot name {path}")
    finally:
        files.delete(parts, True)


def write_queue(queue: DataFrame, path: str) -> None:
    queue.write.mode("overwrite").json(path)


def archive_raw(df: DataFrame, path: str) -> None:
    """Raw batches as they came, by day of capture; a batch is there whole or not at all, and one that is archived again takes its own place."""
    df.withColumn("day", F.coalesce(F.substring("captured_at", 1, 10), F.lit("unknown"))).write.mode("overwrite").partitionBy("day").json(path)


def write_progress(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
