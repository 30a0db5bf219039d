"""Raw payloads of different makes as the four record types.

Every adapter takes a frame of payloads and the facts of its source, and gives frames of records; ``ADAPTERS`` names them. Run time is a parameter
(``as_of`` for scraped_at, its year for vintages), so replays give what the first run gave.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators.dedupe import keep_best
from stemma.schemas import OFFER, PRODUCT, REVIEW, REVIEW_SUMMARY, conform


def _year(as_of: str) -> int:
    return int(as_of[:4])


def _none() -> Column:
    return F.lit(None).cast("string")


def _products(df: DataFrame, as_of: str, order: list) -> DataFrame:
    return keep_best(conform(df.withColumns({"record_type": F.lit("product"), "scraped_at": F.lit(as_of)}), PRODUCT + ", __ord " + df.schema["__ord"].dataType.simpleString()), ["product_key"], order).drop("__ord")


def _offers(df: DataFrame, as_of: str) -> DataFrame:
    return conform(df.withColumns({"record_type": F.lit("offer"), "scraped_at": F.lit(as_of)}), OFFER)


def parse_products(items: DataFrame, as_of: str, names: dict[str, str], order: str = "ord", url_hint: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw product payloads of captured pages, one product and at most one offer each, with __ord; for streams too."""
    c = F.col
    blob = F.concat_ws(" ", c("name_raw"), F.coalesce(c("subcategory_raw"), F.lit("")), F.coalesce(c("description_raw"), F.lit("")))
    volume, vintage = T.parse_volume_ml(blob), T.parse_vintage(c("name_raw"), _year(as_of))
    who = T.canonical_source(c("source"), c("retailer"), names)
    price, member = T.parse_price(c("price_raw")), T.parse_price(c("member_price_raw"))
    df = items.where(F.coalesce(c("name_raw"), F.lit("")) != "").withColumns(
        {
            "__ord": c(order), "__source": who["source"], "__retailer": who["retailer"], "volume_ml": volume, "vintage": vintage, "abv": T.parse_abv(blob),
            "pack_size": F.coalesce(T.parse_pack_size(c("unit_raw")), T.parse_pack_size(blob), F.lit(1)), "name": T.clean_name(c("name_raw")), "brand": c("brand_raw"),
            "subcategory": F.nullif(c("subcategory_raw"), F.lit("")), "price_aud": price, "member_price_aud": member,
            "category": T.resolve_category(T.guess_category(c("subcategory_raw"), c("name_raw"), c("description_raw")), url_hint if url_hint is not None else _none()),
        }
    )
    df = df.withColumn("product_key", T.product_key(c("brand"), c("name"), c("volume_ml"), c("vintage")))
    ordered = ", __ord " + df.schema["__ord"].dataType.simpleString()
    products = conform(df.withColumns({"source": F.coalesce("__source", F.lit("unknown")), "record_type": F.lit("product"), "scraped_at": F.lit(as_of)}), PRODUCT + ordered)
    offers = df.where("coalesce(price_aud, member_price_aud) is not null").withColumns(
        {
            "retailer": c("__retailer"), "url": c("source_url"), "was_price_aud": T.was_price(T.parse_price(c("was_price_raw")), c("price_aud")), "unit_price_aud": T.unit_price(c("price_aud"), c("member_price_aud"), c("pack_size")),
            "promo": c("promo_raw"), "in_stock": T.in_stock(c("availability_raw")), "aggregate_rating_norm": T.norm_rating(c("aggregate_rating_raw"), c("aggregate_rating_scale")), "record_type": F.lit("offer"), "scraped_at": F.lit(as_of),
        }
    )
    return products, conform(offers, OFFER + ordered)


def ingest_products(items: DataFrame, as_of: str, names: dict[str, str], order: str = "ord", url_hint: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw product payloads of captured pages, one product of each key and one offer of each product, retailer and prices."""
    products, offers = parse_products(items, as_of, names, order, url_hint)
    return keep_best(products, ["product_key"], ["__ord"]).drop("__ord"), keep_best(offers, ["product_key", "retailer", "price_aud", "member_price_aud"], ["__ord"]).drop("__ord")


def parse_reviews(items: DataFrame, as_of: str, order: str = "ord") -> DataFrame:
    """Raw reviews with a text of 15 characters or more, with __ord; for streams too."""
    c = F.col
    df = items.withColumn("text", T.stripped(F.coalesce("text", F.lit("")))).where(F.length("text") >= 15)
    df = df.withColumns({"source": F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown")), "source_url": F.coalesce("source_url", F.lit("")), "subject_type": F.coalesce(F.nullif("subject_type", F.lit("")), F.lit("product"))})
    scale = F.coalesce(F.nullif(c("rating_scale").cast("double"), F.lit(0.0)), F.when(c("rating_raw").isNotNull(), F.lit(5.0)))
    df = df.withColumns({"rating_scale": scale, "review_key": T.review_key(c("source"), c("source_url"), c("author"), c("text")), "review_date": T.iso_date(c("review_date"))})
    df = df.withColumns({"rating_norm": T.norm_rating(c("rating_raw"), c("rating_scale")), "record_type": F.lit("review"), "scraped_at": F.lit(as_of)})
    return conform(df.withColumn("__ord", c(order)), REVIEW + ", __ord " + df.schema[order].dataType.simpleString())


def ingest_reviews(items: DataFrame, as_of: str, order: str = "ord") -> DataFrame:
    """Raw reviews with a text of 15 characters or more, one of each key."""
    return keep_best(parse_reviews(items, as_of, order), ["review_key"], ["__ord"]).drop("__ord")


def summary_columns(items: DataFrame, as_of: str) -> DataFrame:
    scale = F.coalesce(F.nullif(F.col("rating_scale").cast("double"), F.lit(0.0)), F.lit(5.0))
    return items.withColumn("rating_scale", scale).withColumns({"average_rating_norm": T.norm_rating(F.col("average_rating"), F.col("rating_scale")), "record_type": F.lit("review_summary"), "scraped_at": F.lit(as_of)})


def ingest_summaries(items: DataFrame, as_of: str) -> DataFrame:
    return conform(summary_columns(items, as_of), REVIEW_SUMMARY)


def storefront(products: DataFrame, as_of: str, source: str, retailer: str, base_url: str, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """products(id, handle, title, vendor, product_type, tags array, body_html, images array<struct<src>>, variants array<struct<title, price,
    compare_at_price, available, barcode>>): one offer of each variant, priced or not."""
    c = F.col
    df = products.select("*", F.posexplode("variants").alias("__at", "v"))
    tags, kind = F.coalesce(F.array_join("tags", " "), F.lit("")), F.coalesce(c("product_type"), F.lit(""))
    title, variant = F.coalesce(c("title"), F.lit("")), F.coalesce(c("v.title"), F.lit(""))
    blob = F.concat_ws(" ", title, variant, kind, tags)
    plain = F.lower(variant).isin("", "default title", "default")
    df = df.withColumns(
        {
            "__ord": F.struct(c(order).alias("a"), c("__at").alias("b")), "source": F.lit(source), "retailer": F.lit(retailer), "url": F.concat(F.lit(base_url + "/products/"), F.coalesce("handle", F.lit(""))),
            "volume_ml": T.parse_volume_ml(blob), "pack_size": F.coalesce(T.parse_pack_size(blob), F.lit(1)), "vintage": T.parse_vintage(title, _year(as_of)), "abv": T.parse_abv(F.concat_ws(" ", title, F.coalesce("body_html", F.lit("")))),
            "category": T.guess_category(kind, tags, title), "brand": F.nullif("vendor", F.lit("")), "subcategory": F.nullif(kind, F.lit("")), "source_product_id": c("id").cast("string"),
            "name": F.when(plain, T.clean_name(title)).otherwise(T.stripped(F.concat_ws(" ", T.clean_name(title), T.clean_name(variant)))), "image_url": F.get("images", 0)["src"], "gtin": F.nullif(c("v.barcode"), F.lit("")),
            "price_aud": T.parse_price(c("v.price").cast("string")), "__was": T.parse_price(c("v.compare_at_price").cast("string")),
        }
    )
    df = df.withColumn("source_url", c("url")).withColumn("product_key", T.product_key(c("brand"), c("name"), c("volume_ml"), c("vintage")))
    offers = df.withColumns({"was_price_aud": T.was_price(c("__was"), c("price_aud")), "unit_price_aud": T.unit_price(c("price_aud"), F.lit(None).cast("double"), c("pack_size")), "in_stock": F.coalesce(c("v.available"), F.lit(False))})
    return _products(df, as_of, ["__ord"]), _offers(offers, as_of)


def product_api(items: DataFrame, as_of: str, source: str, retailer: str, image_prefix: str, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """items(Stockcode, Name, BrandName, PackageSize, Price, WasPrice, IsOnSpecial, IsAvailable, OverallRating, NumberOfReviews,
    AdditionalDetails array<struct<Name, Value>>, url)."""
    c = F.col
    df = items.where(F.coalesce(T.stripped(c("Name")), F.lit("")) != "").withColumn("__d", T.detail_map(c("AdditionalDetails")))
    d = lambda name: T.blank_to_null(F.try_element_at("__d", F.lit(name)))
    name = T.stripped(c("Name"))
    full = F.coalesce(d("productname"), name)
    price = T.parse_price(c("Price").cast("string"))
    df = df.withColumns(
        {
            "__ord": c(order), "source": F.lit(source), "retailer": F.lit(retailer), "source_url": c("url"), "source_product_id": F.coalesce(c("Stockcode").cast("string"), F.lit("")), "name": T.clean_name(name), "brand": F.coalesce(F.nullif("BrandName", F.lit("")), d("brand_name")),
            "category": T.guess_category(d("standardcategory"), d("categorynodename"), name), "subcategory": F.coalesce(d("liquorstyle"), d("varietal"), d("categorynodename")), "volume_ml": F.coalesce(T.parse_volume_ml(c("PackageSize")), T.parse_volume_ml(full)),
            "pack_size": F.coalesce(T.parse_pack_size(full), T.parse_pack_size(name), F.lit(1)), "abv": F.coalesce(F.nullif(T.as_float(d("alcohol%")), F.lit(0.0)), T.parse_abv(full)), "vintage": F.coalesce(T.parse_vintage(d("vintage"), _year(as_of)), T.parse_vintage(full, _year(as_of))),
            "country": d("countryoforigin"), "region": F.coalesce(d("regionoforigin"), d("stateoforigin")), "image_url": T.image_url(d("image1"), image_prefix), "standard_drinks": T.as_float(d("standarddrinks")), "description": T.strip_html(d("productcopy")), "price_aud": price,
        }
    )
    df = df.withColumn("product_key", T.product_key(c("brand"), c("name"), c("volume_ml"), c("vintage")))
    offers = df.where("price_aud is not null").withColumns(
        {
            "was_price_aud": T.was_price(T.parse_price(c("WasPrice").cast("string")), c("price_aud")), "promo": F.when(c("IsOnSpecial"), "special"), "unit_price_aud": T.unit_price(c("price_aud"), F.lit(None).cast("double"), c("pack_size")), "in_stock": c("IsAvailable"),
            "aggregate_rating_norm": T.norm_rating(c("OverallRating"), F.lit(5)), "aggregate_review_count": F.nullif("NumberOfReviews", F.lit(0)),
        }
    )
    return _products(df, as_of, ["__ord"]), _offers(offers, as_of)


def jsonld_pages(pages: DataFrame, as_of: str, source: str, retailer: str, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """pages(url, html, ord): the first product node, with the first of its offers."""
    from stemma.sources.jsonld import first_products, product_offers

    c = F.col
    first = first_products(pages, "url", "html")
    raw = product_offers(first, "url")
    raw = raw.join(pages.select("url", c(order).alias("__ord")), "url")
    raw = keep_best(raw, ["url", "__ord"], ["offer_at"])
    blob = F.concat_ws(" ", c("name_raw"), F.coalesce("description_raw", F.lit("")))
    df = raw.withColumns(
        {
            "source": F.lit(source), "retailer": F.lit(retailer), "source_url": c("url"), "name": T.clean_name(c("name_raw")), "brand": c("brand_raw"), "category": T.guess_category(c("name_raw"), c("description_raw")), "volume_ml": T.parse_volume_ml(blob),
            "pack_size": F.coalesce(T.parse_pack_size(blob), F.lit(1)), "abv": T.parse_abv(blob), "vintage": T.parse_vintage(c("name_raw"), _year(as_of)), "gtin": T.valid_gtin(c("gtin")), "price_aud": T.parse_price(c("price_raw")),
        }
    )
    df = df.withColumn("product_key", T.product_key(c("brand"), c("name"), c("volume_ml"), c("vintage")))
    blank = F.coalesce(c("availability_raw"), F.lit("")) == ""
    gone = F.replace(F.lower("availability_raw"), F.lit("/"), F.lit("")).contains("outofstock")
    offers = df.where("price_aud is not null").withColumns({"unit_price_aud": T.unit_price(c("price_aud"), F.lit(None).cast("double"), c("pack_size")), "in_stock": F.when(~blank, ~gone)})
    return _products(df, as_of, ["__ord"]), _offers(offers, as_of)


def store_items(items: DataFrame, as_of: str, source: str, retailer: str, base_url: str, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """items(fullName, name, unitSize, packQty, barcodes array, group, slug, id, price_cents, special_cents, store)."""
    c = F.col
    name = F.coalesce(F.nullif("fullName", F.lit("")), c("name"))
    numeric = F.floor(c("unitSize").cast("string").try_cast("double")).cast("int")
    best = T.price_of_cents(c("price_cents"), c("special_cents"))
    df = items.where(F.coalesce(name, F.lit("")) != "").withColumns(
        {
            "__ord": c(order), "source": F.lit(source), "retailer": F.lit(retailer), "source_url": F.concat(F.lit(base_url), F.coalesce("slug", F.lit(""))), "url": F.concat(F.lit(base_url), F.coalesce("slug", F.lit(""))), "source_product_id": c("id").cast("string"),
            "__name": name, "volume_ml": F.coalesce(F.nullif(numeric, F.lit(0)), T.parse_volume_ml(name)), "pack_size": F.coalesce(T.parse_pack_size(name), F.lit(1)), "vintage": T.parse_vintage(name, _year(as_of)), "abv": T.parse_abv(name),
            "category": T.guess_category(c("group"), name), "subcategory": c("group"), "gtin": T.first_valid_gtin(c("barcodes")), "carton_qty": c("packQty"), "price_aud": best["price"], "promo": F.when(best["special"], "special"),
        }
    )
    df = df.withColumn("name", T.clean_name(c("__name"))).withColumn("product_key", T.product_key(_none(), c("name"), c("volume_ml"), c("vintage")))
    offers = df.where("price_aud is not null").withColumn("unit_price_aud", T.unit_price(c("price_aud"), F.lit(None).cast("double"), c("pack_size")))
    return _products(df, as_of, ["__ord"]), _offers(offers, as_of)


def posts(items: DataFrame, as_of: str, source: str) -> DataFrame:
    """items(title, content, points, link, date): tasting notes with a title and a body of 40 characters or more, on 100 points."""
    c = F.col
    df = items.withColumns({"title": T.strip_html(c("title")), "text": T.strip_html(c("content")), "rating_raw": T.stripped(c("points").cast("string")).try_cast("double")}).where("title is not null and length(text) >= 40")
    df = df.withColumns({"source": F.lit(source), "source_url": c("link"), "author": _none(), "product_name_raw": c("title"), "subject_type": F.lit("product"), "rating_scale": F.when(c("rating_raw").isNotNull(), F.lit(100.0)), "review_date": F.nullif(F.substring("date", 1, 10), F.lit("")), "sort_order": F.lit("Newest"), "record_type": F.lit("review"), "scraped_at": F.lit(as_of)})
    df = df.withColumns({"rating_norm": T.norm_rating(c("rating_raw"), c("rating_scale")), "review_key": T.review_key(c("source"), F.coalesce("source_url", F.lit("")), c("author"), c("text"))})
    return conform(df, REVIEW)


def api_reviews(payloads: DataFrame, as_of: str, source: str) -> DataFrame:
    """payloads(url, product_name, Reviews array<struct>, reviews_b array<struct>): two dialects, the first where it has rows.

    First: LongDesc, Name, Rating, Title, DateSubmitted, IsRecommended, Likes, SyndReviewSource; second: description, displayName, rating, title, date,
    wouldRecommend, helpful_yes, SourceClient.
    """
    c = F.col
    names = [("text", "LongDesc", "description", "string"), ("author", "Name", "displayName", "string"), ("rating_raw", "Rating", "rating", "double"), ("title", "Title", "title", "string"), ("review_date", "DateSubmitted", "date", "string"), ("recommended", "IsRecommended", "wouldRecommend", "boolean"), ("helpful_votes", "Likes", "helpful_yes", "int"), ("syndicated_from", "SyndReviewSource", "SourceClient", "string")]
    as_one = lambda array, k: F.transform(array, lambda r: F.struct(*[r[n[k]].cast(n[3]).alias(n[0]) for n in names]))
    chosen = F.when(F.size("Reviews") > 0, as_one(c("Reviews"), 1)).otherwise(as_one(c("reviews_b"), 2))
    df = payloads.select("url", "product_name", F.explode(chosen).alias("r")).select(c("url").alias("source_url"), c("product_name").alias("product_name_raw"), "r.*")
    df = df.withColumn("text", T.stripped(F.coalesce("text", F.lit("")))).where(F.length("text") >= 15)
    df = df.withColumns({"source": F.lit(source), "subject_type": F.lit("product"), "rating_scale": F.lit(5.0), "rating_norm": T.norm_rating(c("rating_raw"), F.lit(5)), "sort_order": F.lit("Newest"), "review_date": T.parse_date(c("review_date")), "record_type": F.lit("review"), "scraped_at": F.lit(as_of)})
    return conform(df.withColumn("review_key", T.review_key(c("source"), c("source_url"), c("author"), c("text"))), REVIEW)


def api_summaries(payloads: DataFrame, as_of: str, source: str) -> DataFrame:
    """payloads(url, product_name, RatingDistribution array<struct<RatingValue, Count>>, OverallRating, TotalReviewCount, TotalResults, RecommendedPercentage,
    overall struct<rating, totalReviews, percentageRecommending>). Of rows that tell of one star the last counts."""
    c = F.col
    first = F.size("RatingDistribution") > 0
    rows = F.filter("RatingDistribution", lambda r: r["RatingValue"].isNotNull())
    stars = F.array_distinct(F.transform(rows, lambda r: r["RatingValue"].cast("string")))
    counts = F.transform(stars, lambda s: F.element_at(F.filter(rows, lambda r: r["RatingValue"].cast("string") == s), -1)["Count"].cast("bigint"))
    total = F.coalesce(F.nullif(c("TotalReviewCount"), F.lit(0)), c("TotalResults"), c("TotalReviewCount"))
    df = payloads.select(
        c("url").alias("source_url"), c("product_name").alias("product_name_raw"), F.when(first, F.map_from_arrays(stars, counts)).alias("distribution"),
        F.when(first, c("OverallRating")).otherwise(c("overall.rating")).cast("double").alias("average_rating"), F.when(first, total).otherwise(c("overall.totalReviews")).cast("int").alias("total_reviews"),
        F.when(first, c("RecommendedPercentage").cast("double")).otherwise(T.parse_price(c("overall.percentageRecommending").cast("string"))).alias("pct_recommend"),
    ).where("average_rating is not null or distribution is not null")
    return conform(df.withColumns({"source": F.lit(source), "average_rating": T.rounded(c("average_rating"), 4), "rating_scale": F.lit(5.0), "average_rating_norm": T.norm_rating(c("average_rating"), F.lit(5)), "record_type": F.lit("review_summary"), "scraped_at": F.lit(as_of)}), REVIEW_SUMMARY)


def enriched_rows(rows: DataFrame) -> DataFrame:
    """rows(Stockcode, Prices struct<singleprice, promoprice, ... struct<Value>>, PackageSize, ...) flattened: the first price that has a value."""
    c = F.col
    return rows.select(c("Stockcode").cast("string").alias("stockcode"), F.coalesce("Prices.singleprice.Value", "Prices.SinglePrice.Value").cast("string").alias("price"), F.coalesce("Prices.promoprice.Value", "Prices.MemberOffer.Value").cast("string").alias("member_price"), F.coalesce("Unit", "PackageSize").alias("unit"), c("Rating").cast("double").alias("rating"), c("Reviews").cast("int").alias("reviews"), c("IsAvailable").alias("in_stock"), "url")


def tiles_a(tiles: DataFrame) -> DataFrame:
    """tiles(brand, subtitle, shown, full, unit, url, reviews_text): raw products of tiles that name brand and product apart; what everybody pays is the price."""
    c = F.col
    shown, everybody = T.money(c("shown")), T.non_member_price(c("full"))
    name = T.blank_to_null(F.concat_ws(" ", T.blank_to_null(c("brand")), T.blank_to_null(c("subtitle"))))
    return tiles.select("*", name.alias("name_raw"), c("brand").alias("brand_raw"), F.coalesce(everybody, shown).alias("price_raw"), F.when(c("full").rlike(r"(?i)member\s*offer"), shown).alias("member_price_raw"), T.promotion(c("full")).alias("promo_raw"), T.review_count(c("reviews_text")).alias("aggregate_review_count"), c("unit").alias("unit_raw"), c("url").alias("source_url")).where("name_raw is not null")


def tiles_b(tiles: DataFrame) -> DataFrame:
    """tiles(brand, name, dollars, cents, was_dollars, was_cents, href): raw products of tiles whose prices stand in two parts."""
    c = F.col
    amount = lambda d, n: F.when(c(d).isNotNull(), F.concat(c(d), F.lit("."), F.coalesce(c(n), F.lit("00"))))
    now, was = amount("dollars", "cents"), amount("was_dollars", "was_cents")
    return tiles.where(F.coalesce("name", F.lit("")) != "").select("*", F.concat_ws(" ", "brand", "name").alias("name_raw"), c("brand").alias("brand_raw"), now.alias("price_raw"), F.when(was.try_cast("double") > now.try_cast("double"), was).alias("was_price_raw"), F.nullif(F.substring_index("href", "_", -1), F.lit("")).alias("source_product_id"), c("href").alias("source_url"))


#: name -> function; register() adds to them.
ADAPTERS: dict[str, Callable] = {f.__name__: f for f in (ingest_products, ingest_reviews, ingest_summaries, storefront, product_api, jsonld_pages, store_items, posts, api_reviews, api_summaries, enriched_rows, tiles_a, tiles_b)}


def register(name: str, adapter: Callable) -> None:
    ADAPTERS[name] = adapter


def adapter(name: str) -> Callable:
    return ADAPTERS[name]
