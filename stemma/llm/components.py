"""Connected components of a distributed edge list, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import dropped, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, root): every node of an edge with the least node that it can reach.

    Alternates large stars and small stars until the edges are stars about their roots. Minima by node
    combine before the shuffle; a node with very many edges meets them in a join whose large partitions can be split.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # A table of edges is told by their number and two sums without carry of their hashes.
    signs = (F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("a", "b", F.lit(1))))
    now = edges.agg(*signs).first()
    while now[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Here each row's a is the greater end; a node's neighbours that are not greater, and itself, go to their least.
        large = staged(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        after = staged(small.select("e.a", "e.b").where("a <> b").distinct())
        # Stars: no root hangs below another node, and nothing changed.
        dropped(edges, large)
        edges, before, now = after, now, after.agg(*signs).first()
        if now == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
