"""One deterministic row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_best(df: DataFrame, keys: list, order_by: list) -> DataFrame:
    """First row of each key by a total order. Rank limits are pushed below the shuffle by the planner."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def nullable_key(*columns: Column) -> list[Column]:
    """Keys in which null equals null and differs from all values (window partitions do so already; for joins)."""
    return [F.coalesce(c.cast("string"), F.lit("\0")) for c in columns]


def dedupe_offers_ingest(offers: DataFrame, order: list) -> DataFrame:
    """One offer for product, retailer, both prices and day; offers without any price go."""
    priced = offers.where(F.coalesce("price_aud", "member_price_aud").isNotNull())
    return keep_best(priced, ["product_key", "retailer", "price_aud", "member_price_aud", F.substring("scraped_at", 1, 10)], order)


def dedupe_offers_resolve(offers: DataFrame, informative: Column, order: list) -> DataFrame:
    """One offer for product, retailer, price and day: the most informative, then the first."""
    return keep_best(offers, ["product_key", "retailer", "price_aud", F.substring("scraped_at", 1, 10)], [informative.desc(), *order])


def dedupe_reviews(reviews: DataFrame, order: list) -> DataFrame:
    """One review for source, author and the beginning of its text, case and white space aside: the longest, then the first."""
    start = F.regexp_replace(F.lower(F.substring("text", 1, 180)), r"\s+", " ")
    return keep_best(reviews, ["source", F.lower(F.coalesce("author", F.lit(""))), start], [F.length("text").desc(), *order])


def dedupe_reviews_ingest(reviews: DataFrame, order: list) -> DataFrame:
    return keep_best(reviews, ["review_key"], order)


def dedupe_payload_products(items: DataFrame, order: list) -> DataFrame:
    return keep_best(items, ["name_raw", "price_raw", "source_url"], order)


def dedupe_payload_reviews(items: DataFrame, order: list) -> DataFrame:
    return keep_best(items.where(F.length("text") >= 15), [F.substring("text", 1, 120), F.coalesce("author", F.lit(""))], order)


def accumulate_tiles(tiles: DataFrame, order: list) -> DataFrame:
    """One tile of each address and name: a priced one before any without a price, then the first."""
    return keep_best(tiles, ["source_url", "name_raw"], [F.col("price_raw").isNull(), *order])
