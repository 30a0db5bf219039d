"""Record types. A missing field is null; fields that only some sources give are part of the superset."""

from __future__ import annotations

import re


def _struct(ddl: str) -> str:
    """Columns as the fields of a struct."""
    return "struct<" + ", ".join(c.strip().replace(" ", ": ", 1) for c in re.split(r",\s(?=\w+ )", ddl)) + ">"


PRODUCT = (
    "record_type string, product_key string, source string, source_url string, source_product_id string, name string, brand string, category string, subcategory string, volume_ml int, pack_size int, abv double, vintage int, country string, region string, image_url string, gtin string, scraped_at string, standard_drinks double, description string, carton_qty int"
)
OFFER = (
    "record_type string, product_key string, retailer string, url string, price_aud double, was_price_aud double, unit_price_aud double, member_price_aud double, promo string, in_stock boolean, pack_size int, postcode string, store string, aggregate_rating_norm double, aggregate_review_count int, scraped_at string"
)
REVIEW = (
    "record_type string, review_key string, product_key string, product_name_raw string, subject_type string, source string, source_url string, author string, title string, text string, rating_raw double, rating_scale double, rating_norm double, sort_order string, review_date string, scraped_at string, recommended boolean, helpful_votes int, syndicated_from string, match_score double"
)
REVIEW_SUMMARY = (
    "record_type string, product_name_raw string, source string, source_url string, average_rating double, rating_scale double, average_rating_norm double, pct_recommend double, distribution map<string,bigint>, total_reviews int, scraped_at string"
)
#: DDL of each record type.
KINDS = {"product": PRODUCT, "offer": OFFER, "review": REVIEW, "review_summary": REVIEW_SUMMARY}
RAW_PRODUCT = "source string, retailer string, source_url string, source_product_id string, name_raw string, brand_raw string, description_raw string, subcategory_raw string, price_raw string, member_price_raw string, was_price_raw string, promo_raw string, unit_raw string, availability_raw string, aggregate_rating_raw double, aggregate_rating_scale double, aggregate_review_count int, image_url string, gtin string, currency string, postcode string"
RAW_REVIEW = "source string, subject_type string, source_url string, product_name_raw string, author string, title string, text string, rating_raw double, rating_scale double, review_date string, sort_order string"
RAW_SUMMARY = "product_name_raw string, source_url string, average_rating double, rating_scale double, pct_recommend double, distribution map<string,bigint>, total_reviews int"
RAW_ENRICHED = "stockcode string, price string, member_price string, unit string, package_size string, rating double, reviews int, in_stock boolean, url string"
RAW_BATCH = (
    f"url string, host string, captured_at string, products array<{_struct(RAW_PRODUCT)}>, reviews array<{_struct(RAW_REVIEW)}>, review_summary {_struct(RAW_SUMMARY)}, enriched array<{_struct(RAW_ENRICHED)}>, listing_url string, sweep_url string"
)


def fields(ddl: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ", 1)) for c in re.split(r",\s(?=\w+ )", ddl)]


def conform(df, ddl: str):
    """Columns of a record type, absent ones null, in its order and types."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[(F.col(name) if name in have else F.lit(None)).cast(kind).alias(name) for name, kind in fields(ddl)])
