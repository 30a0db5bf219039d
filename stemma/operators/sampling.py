"""Ranked work queues, and how deep to sample what they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators.dedupe import keep_best
from stemma.operators.order import numbered


def depth(count: Column, full: bool = False, cap: int | None = None) -> Column:
    """Newest reviews to keep of a product with so many."""
    if full:
        return count
    if cap:
        return F.least(count, F.lit(cap))
    return F.when(count >= 200, 50).when(count > 20, 20).otherwise(count)


def sample_newest(df: DataFrame, key: str, order: list, count: str | None = None, full: bool = False, cap: int | None = None) -> DataFrame:
    """The newest rows of each key, as many as depth() gives for its number of rows, or for the column count."""
    if full:
        return df
    # Ranks end at the greatest depth there is, so the planner cuts every key's rows before they are exchanged; numbers come from a count of their own.
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("__rank") <= (cap or 50))
    if count is not None:
        return ranked.where(F.col("__rank") <= depth(F.col(count), cap=cap)).drop("__rank")
    totals = df.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("__total"))
    met = ranked.join(totals, F.col(key).eqNullSafe(F.col("__key")))
    return met.where(F.col("__rank") <= depth(F.col("__total"), cap=cap)).select(*df.columns)


def rank_queue(offers: DataFrame, min_reviews: int = 1, limit: int | None = None, retailer: str | None = None, supported: tuple[str, ...] = (), countless: tuple[str, ...] = (), order: list | None = None) -> DataFrame:
    """offers(product_key, name, retailer, url, aggregate_review_count) -> one target for each address, the most reviewed first.

    supported: retailers to queue (all if empty); countless: those that publish no counts and need none.
    """
    page = T.strip_query(F.coalesce("url", F.lit("")))
    count = F.coalesce("aggregate_review_count", F.lit(0))
    ok = page.contains("/product/") | page.rlike(r"_\d+$")
    enough = (count >= min_reviews) | F.col("retailer").isin(*countless) if countless else count >= min_reviews
    df = offers.where(ok & enough)
    if supported:
        df = df.where(F.col("retailer").isin(*supported))
    if retailer:
        df = df.where(F.col("retailer") == retailer)
    df = df.withColumn("url", page).withColumn("expected_reviews", count)
    best = keep_best(df, ["url"], [F.desc("expected_reviews"), *(order or ["product_key"])])
    best = best.select("url", "product_key", "name", "retailer", "expected_reviews", depth(F.col("expected_reviews")).alias("max_reviews"))
    ranked = best.orderBy(F.desc("expected_reviews"), "url")
    return ranked.limit(limit) if limit else ranked


def queue_plan(queue: DataFrame, per_page: int = 4, page_s: float = 2.0, product_s: float = 11.0) -> DataFrame:
    """One row: targets, advertised and planned reviews, page turns, hours."""
    take = F.least("expected_reviews", F.coalesce(F.nullif("max_reviews", F.lit(0)), "expected_reviews"))
    totals = queue.agg(F.count("*").alias("targets"), F.coalesce(F.sum("expected_reviews"), F.lit(0)).alias("advertised"), F.coalesce(F.sum(take), F.lit(0)).alias("planned"), F.coalesce(F.sum(F.ceil(take / per_page)), F.lit(0)).alias("pages"))
    return totals.withColumn("hours", T.rounded((F.col("pages") * page_s + F.col("targets") * product_s) / 3600, 2))


def missing_only(products: DataFrame, offers: DataFrame) -> DataFrame:
    return products.join(offers.select("product_key"), "product_key", "left_anti")


def batch_ids(df: DataFrame, n: int, order: list, within: list | None = None) -> DataFrame:
    """batch: number of the n rows that a row stands among, by the order, of the whole table or within keys."""
    if not within:
        return numbered(df, order, "batch").withColumn("batch", F.floor(F.col("batch") / n))
    w = Window.partitionBy(*within).orderBy(*order)
    return df.withColumn("batch", F.floor((F.row_number().over(w) - 1) / n))


def scan_targets(records: DataFrame, pattern: str, order: str = "ord") -> DataFrame:
    """records(record_type, url, name, aggregate_review_count, ord) -> code, expected_reviews, name of codes with reviews, most first."""
    coded = records.withColumn("code", F.nullif(F.regexp_extract("url", pattern, 1), F.lit(""))).where("code is not null")
    counts = coded.where("record_type = 'offer'").groupBy("code").agg(F.max("aggregate_review_count").alias("expected_reviews")).where("expected_reviews > 0")
    names = coded.where("record_type = 'product' and name is not null").groupBy("code").agg(F.min_by("name", order).alias("name"))
    return counts.join(names, "code", "left").orderBy(F.desc("expected_reviews"), "code")


def enrich_offers(rows: DataFrame, index: DataFrame, retailer: str) -> DataFrame:
    """Enrichment rows as offers of the product that has their stock code; rows without a product or a price go.
    Prices are strings or figures."""
    price, member = T.parse_price(F.col("price").cast("string")), T.parse_price(F.col("member_price").cast("string"))
    pack = F.coalesce(T.parse_pack_size(F.col("unit")), F.lit(1))
    met = rows.join(index.select("stockcode", "product_key"), "stockcode").withColumns({"__p": price, "__m": member, "pack_size": pack}).where("coalesce(__p, __m) is not null")
    return met.select(
        F.lit("offer").alias("record_type"), "product_key", F.lit(retailer).alias("retailer"), "url", F.col("__p").alias("price_aud"), F.lit(None).cast("double").alias("was_price_aud"), F.col("__m").alias("member_price_aud"),
        T.unit_price(F.col("__p"), F.col("__m"), F.col("pack_size")).alias("unit_price_aud"), "in_stock", "pack_size", T.norm_rating(F.col("rating"), F.lit(5)).alias("aggregate_rating_norm"), F.nullif("reviews", F.lit(0)).alias("aggregate_review_count"),
    )
