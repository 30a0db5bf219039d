"""Places in one order of a whole table, without one task that sees all of it.

Rows are dealt by ranges of the order and numbered where they lie; what a range cannot know of those before it is a few figures a range, added up on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.operators.staging import checkpointed


def ranged(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """With __part, the number of a row's range, and __at, its place there from 0. Written, as another run might cut the ranges elsewhere."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The lower bits of this id count the rows of a partition as they lie.
    return checkpointed(dealt.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))


def numbered(df: DataFrame, order: list, name: str, parts: int | None = None) -> DataFrame:
    """Adds name, a row's place from 0 in the order of the whole table. The order has to tell all rows apart, else equal ones stand in any order."""
    rows = ranged(df, order, parts)
    before, offsets = 0, []
    for r in sorted(rows.groupBy("__part").count().collect()):  # a row for each range
        offsets.append((r["__part"], before))
        before += r["count"]
    told = F.broadcast(df.sparkSession.createDataFrame(offsets, "__part int, __before bigint"))
    return rows.join(told, "__part").withColumn(name, F.col("__before") + F.col("__at")).select(*df.columns, name)


def stall_runs(snapshots: DataFrame, order: str, value: str, within: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Adds gained, against the snapshot before, and stalls, the length of the run without gain that ends here, of series of any length: of each range of the
    order only the last snapshot, and how long a run ends there, is told to the next."""
    keys = within or []
    rows = ranged(snapshots, [*keys, order], parts)
    here = Window.partitionBy("__part").orderBy("__at")
    key = F.struct(*[F.col(k) for k in keys], F.lit(0))
    rows = rows.withColumns({"__before": F.lag(value).over(here), "__same": F.coalesce(F.lag(key).over(here).eqNullSafe(key), F.lit(False))})
    still = F.coalesce(F.col("__same") & (F.col(value) == F.col("__before")), F.lit(False))
    # Length of the run that ends here, as far as the range shows it: places since the last snapshot that gained, or the whole of it so far.
    rows = rows.withColumn("__moved", F.max(F.when(~still, F.col("__at"))).over(here))
    ends = rows.groupBy("__part").agg(F.max_by(F.struct(key.alias("key"), F.col(value).alias("value")), "__at").alias("last"), F.max("__at").alias("at"), F.max("__moved").alias("moved"), F.min_by(F.struct(key.alias("key"), F.col(value).alias("value")), "__at").alias("first"))
    told, now, run = [], None, 0
    for r in sorted(ends.collect(), key=lambda r: r["__part"]):  # a row for each range
        carry = run + 1 if now is not None and now["key"] == r["first"]["key"] and now["value"] is not None and now["value"] == r["first"]["value"] else 0
        told.append((r["__part"], now["value"] if now is not None and now["key"] == r["first"]["key"] else None, carry))
        # The first snapshot of a range always counts as one that moved; unless nothing moved after it, its own run goes no further.
        run = r["at"] - r["moved"] + (carry if r["moved"] == 0 else 0)
        now = r["last"]
    kind = snapshots.schema[value].dataType.simpleString()
    told = F.broadcast(snapshots.sparkSession.createDataFrame(told, f"__part int, __last {kind}, __carry bigint"))
    rows = rows.join(told, "__part")
    before = F.when(F.col("__at") == 0, F.col("__last")).when(F.col("__same"), F.col("__before"))
    stalls = F.col("__at") - F.col("__moved") + F.when(F.col("__moved") == 0, F.col("__carry")).otherwise(0)
    return rows.withColumns({"gained": F.col(value) - before, "stalls": stalls.cast("int")}).select(*snapshots.columns, "gained", "stalls")
