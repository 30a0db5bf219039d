"""The same item across sources: barcodes, missing volumes, exact identity strings, then fuzzy ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators.dedupe import keep_best
from stemma.operators.similarity import fuzzy_link
from stemma.operators.staging import checkpointed

#: No alias: the key stands for itself.
ALIAS = "product_key string, canonical_key string"


def products_by_key(products: DataFrame, order: list) -> DataFrame:
    """One row of each key: that with most known, then the first."""
    known = T.informativeness(*[F.col(c) for c in products.columns])
    return keep_best(products, ["product_key"], [known.desc(), *order])


def merge_gtin(products: DataFrame, order: list) -> DataFrame:
    """(product_key, canonical_key): keys that share a barcode take the first holder's."""
    coded = products.where(F.col("gtin").isNotNull())
    first = keep_best(coded, ["gtin"], order).select("gtin", F.col("product_key").alias("canonical_key"))
    return coded.select("product_key", "gtin").join(first, "gtin").where("product_key <> canonical_key").select("product_key", "canonical_key").distinct()


def merge_missing_volume(products: DataFrame, slug: str, order: list) -> DataFrame:
    """(product_key, canonical_key): products without a volume join the one known volume of their identity string; with several it stays open."""
    known = products.where("volume_ml is not null")
    if all(isinstance(o, str) for o in order):  # the first by plain columns comes with the count, in one pass
        first = known.groupBy(slug).agg(F.min("volume_ml").alias("__least"), F.max("volume_ml").alias("__most"), F.min_by("product_key", F.struct(*order)).alias("canonical_key"))
    else:
        first = keep_best(known.withColumns({"__least": F.min("volume_ml").over(Window.partitionBy(slug)), "__most": F.max("volume_ml").over(Window.partitionBy(slug))}), [slug], order).withColumnRenamed("product_key", "canonical_key")
    primary = first.where("__least = __most").select(slug, "canonical_key")
    return products.where("volume_ml is null").join(primary, slug).where("product_key <> canonical_key").select("product_key", "canonical_key").distinct()


def followed(steps: DataFrame) -> DataFrame:
    """steps(product_key, canonical_key), one of each key: every step led on to where it ends. Each round doubles how far a step reaches. Steps that
    lead into a circle end at its least key, which is then no alias."""
    now = checkpointed(steps.where("product_key <> canonical_key").withColumn("least", F.col("canonical_key")))
    every, reach = now.count(), 1
    while True:
        on = now.select(F.col("product_key").alias("__from"), F.col("canonical_key").alias("__to"), F.col("least").alias("__least"))
        met = now.join(on, now["canonical_key"] == on["__from"], "left")
        if not met.where("__from is not null").limit(1).count():
            return now.select("product_key", "canonical_key")
        if reach >= every:  # as many steps as there are keys: what leads on still is on a circle, and has seen all of it
            return met.select("product_key", F.coalesce("__least", "canonical_key").alias("canonical_key")).where("product_key <> canonical_key")
        now = checkpointed(met.select("product_key", F.coalesce("__to", "canonical_key").alias("canonical_key"), F.least("least", "__least").alias("least")))
        reach *= 2


def merge_products(products: DataFrame, slug: str, order: list) -> DataFrame:
    """(product_key, canonical_key): by barcode, then by volume among those that the first step leaves, as one map. No canonical key is an alias, however many
    barcodes a key has."""
    one = merge_gtin(products, order).groupBy("product_key").agg(F.min("canonical_key").alias("canonical_key"))
    left = products.join(one.select("product_key"), "product_key", "left_anti")
    second = merge_missing_volume(left, slug, order).groupBy("product_key").agg(F.min("canonical_key").alias("canonical_key"))
    return followed(one.unionByName(second))


def apply_alias(df: DataFrame, alias: DataFrame, key: str = "product_key") -> DataFrame:
    a = alias.select(F.col("product_key").alias("__from"), F.col("canonical_key").alias("__to"))
    return df.join(a, df[key] == a["__from"], "left").withColumn(key, F.coalesce("__to", key)).drop("__from", "__to")


def exact_link(reviews: DataFrame, products: DataFrame, order: list) -> DataFrame:
    """reviews(slug...), products(slug, product_key...): score 1 where the identity strings are equal; of products that share one, the first."""
    first = keep_best(products.where("slug <> ''"), ["slug"], order).select("slug", F.col("product_key").alias("linked_key"))
    return reviews.join(first, "slug").withColumn("match_score", F.lit(1.0))


def link(reviews: DataFrame, products: DataFrame, order: list, threshold: float = 0.86, scorer: str = "ratio") -> tuple[DataFrame, DataFrame]:
    """reviews(review_key, slug, vintage, subject_type), products(product_key, slug, vintage) -> linked and queue.

    Reviews of retailers are left aside. Exact strings first; the rest by blocked similarity. A best candidate of another vintage, or
    below the threshold, goes to the queue with its score and the reason.
    """
    mine = reviews.where(F.coalesce("subject_type", F.lit("product")) != "retailer")
    exact = exact_link(mine, products, order)
    rest = mine.join(exact.select("review_key"), "review_key", "left_anti")
    best = fuzzy_link(rest.select("review_key", "slug"), products.select("product_key", "slug"), threshold=0.0, scorer=scorer)
    names = products.select(F.col("product_key").alias("match_candidate"), F.col("vintage").alias("__vintage"))
    rest = rest.join(best.select("review_key", F.col("product_key").alias("match_candidate"), "match_score"), "review_key", "left").join(names, "match_candidate", "left")
    conflict = F.coalesce(F.col("vintage") != F.col("__vintage"), F.lit(False))
    rest = rest.withColumn("match_reason", F.when(F.col("match_candidate").isNull(), "no candidate").when(conflict, "vintage conflict").when(F.col("match_score") < threshold, "below threshold")).drop("__vintage")
    linked = exact.select(*mine.columns, F.col("linked_key").alias("product_key"), "match_score").unionByName(
        rest.where("match_reason is null").select(*mine.columns, F.col("match_candidate").alias("product_key"), "match_score")
    )
    return linked, rest.where("match_reason is not null")


def link_rate(linked: DataFrame, queued: DataFrame) -> DataFrame:
    each = linked.select(F.lit(1).alias("hit")).unionAll(queued.select(F.lit(0).alias("hit")))
    counts = each.agg(F.count_if(F.col("hit") == 1).alias("linked"), F.count_if(F.col("hit") == 0).alias("queued"))
    return counts.withColumn("rate_pct", F.expr("linked * 100 div nullif(linked + queued, 0)"))
