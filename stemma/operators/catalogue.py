"""The nested catalogue: products with their offers, reviews, aggregates and comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators.compare import compare_offers


def offer_aggregates(offers: DataFrame) -> DataFrame:
    packs = F.array_sort(F.collect_set("pack_size"))
    return offers.groupBy("product_key").agg(
        F.min("price_aud").alias("min_price_aud"), F.max("price_aud").alias("max_price_aud"), packs.alias("pack_sizes"), (F.size(F.collect_set("pack_size")) > 1).alias("pack_size_mismatch"), F.count_distinct("retailer").alias("retailer_count"), F.count("*").alias("offer_count")
    )


def review_aggregates(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_key").agg(F.count("*").alias("review_count"), T.rounded(F.avg("rating_norm"), 4).alias("mean_rating_norm"), F.coalesce(F.bool_or(T.is_biased(F.col("sort_order"))), F.lit(False)).alias("reviews_biased_sample"))


def first_summary(offers: DataFrame, summaries: DataFrame, offer_order: list[str], summary_order: str) -> DataFrame:
    """Of each product the summary of its first offer whose address has one; of an address's summaries the last."""
    latest = summaries.groupBy(T.strip_query(F.col("source_url")).alias("page")).agg(F.max_by(F.struct("average_rating_norm", "total_reviews"), summary_order).alias("summary"))
    met = offers.withColumn("page", T.strip_query(F.col("url"))).join(latest, "page")
    return met.groupBy("product_key").agg(F.min_by("summary", F.struct(*offer_order)).alias("summary")).select("product_key", F.col("summary.average_rating_norm").alias("site_rating_norm"), F.col("summary.total_reviews").alias("site_review_count"))


def build_catalogue(products: DataFrame, offers: DataFrame, reviews: DataFrame, summaries: DataFrame | None = None, offer_order: list[str] | None = None, summary_order: str = "ord") -> DataFrame:
    """Each side is gathered by product before it joins, so offers and reviews don't multiply. Columns in order; sort by order_catalogue()."""
    order = offer_order or ["retailer", "url"]
    nested_offers = offers.groupBy("product_key").agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in offers.columns if c not in (*order, "product_key", "record_type")]))).alias("offers"))
    # Reviews stand in an order of their own: by key and text where there are such columns, then by whatever else sorts.
    first = [c for c in ("ord", "review_key", "text") if c in reviews.columns]
    told = [c for c in reviews.columns if c not in (*first, "product_key", "record_type")]
    nested_reviews = reviews.groupBy("product_key").agg(F.array_sort(F.collect_list(F.struct(*first, *told))).alias("reviews"))
    out = products.join(nested_offers, "product_key", "left").join(offer_aggregates(offers), "product_key", "left").join(compare_offers(offers), "product_key", "left").join(nested_reviews, "product_key", "left").join(review_aggregates(reviews), "product_key", "left")
    if summaries is not None:
        out = out.join(first_summary(offers, summaries, order, summary_order), "product_key", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("retailer_count", "offer_count", "review_count")}
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("pack_size_mismatch", "compare_suspect", "reviews_biased_sample")}
    lists = {c: F.coalesce(c, F.array()) for c in ("offers", "reviews", "pack_sizes")}
    return out.withColumns(zero | flags | lists)


def catalogue_order() -> list:
    """Total order of products."""
    return [F.coalesce("brand", F.lit("")), F.col("name"), F.col("product_key")]


def order_catalogue(catalogue: DataFrame) -> DataFrame:
    return catalogue.orderBy(*catalogue_order())


def report(catalogue: DataFrame) -> DataFrame:
    """One row of counts."""
    many = F.col("retailer_count") > 1
    return catalogue.agg(
        F.count("*").alias("products"), F.count_if(F.col("min_price_aud").isNotNull()).alias("with_price"), F.count_if(many).alias("multi_retailer"),
        F.count_if(F.col("compare_basis").isNotNull() & ~F.col("compare_suspect")).alias("trusted"), F.count_if(F.col("compare_suspect")).alias("suspect"),
        F.count_if(F.col("reviews_biased_sample")).alias("biased"), F.coalesce(F.sum("review_count"), F.lit(0)).alias("reviews"),
    )


def histogram_total(distribution: str = "distribution"):
    return F.aggregate(F.map_values(distribution), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def median_gap(catalogue: DataFrame) -> DataFrame:
    """Beyond the pipeline's own outputs: the median spread of trusted comparisons."""
    return catalogue.where(F.col("compare_basis").isNotNull() & ~F.col("compare_suspect")).agg(F.median("compare_spread_pct").alias("median_gap_pct"))
