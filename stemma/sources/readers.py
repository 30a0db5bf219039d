"""Landed raw files as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.schemas import KINDS, RAW_BATCH, conform

#: Superset of the record types; fields of other types are null.
RECORD = "record_type string, product_key string, source string, source_url string, source_product_id string, name string, brand string, category string, subcategory string, volume_ml int, pack_size int, abv double, vintage int, country string, region string, image_url string, gtin string, scraped_at string, standard_drinks double, description string, carton_qty int, retailer string, url string, price_aud double, was_price_aud double, unit_price_aud double, member_price_aud double, promo string, in_stock boolean, postcode string, store string, aggregate_rating_norm double, aggregate_review_count int, review_key string, product_name_raw string, subject_type string, author string, title string, text string, rating_raw double, rating_scale double, rating_norm double, sort_order string, review_date string, recommended boolean, helpful_votes int, syndicated_from string, match_score double, average_rating double, average_rating_norm double, pct_recommend double, distribution map<string,bigint>, total_reviews int"


def read_records(spark: SparkSession, path: str, skip: tuple[str, ...] = ("catalogue", "unlinked_reviews", "targets")) -> DataFrame:
    """JSON lines of all record types below a path, in the order of file names and lines: ord sorts them. Malformed and blank lines are
    left out, and files named as outputs."""
    df = spark.read.schema(RECORD).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.jsonl").json(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.jsonl$", 1)
    df = df.withColumns({"__file": name, "__at": F.col("_metadata.file_block_start"), "__n": F.monotonically_increasing_id()})
    df = df.where(~F.col("__file").isin(*skip) & F.col("record_type").isNotNull())
    return df.withColumn("ord", F.struct(F.col("__file").alias("file"), F.col("__at").alias("at"), F.col("__n").alias("n"))).drop("__file", "__at", "__n")


def of_kind(records: DataFrame, kind: str) -> DataFrame:
    """Rows of one record type with its columns, and ord where there is one."""
    rows = records.where(F.col("record_type") == kind)
    if "ord" not in records.columns:
        return conform(rows, KINDS[kind])
    return conform(rows, KINDS[kind] + ", ord " + records.schema["ord"].dataType.simpleString())


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Archived raw batches, one JSON document each, ordered by ord; broken files are left out."""
    df = spark.read.schema(RAW_BATCH).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    return df.withColumn("ord", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1))


def expand_seeds(lines: DataFrame, clicks: int = 60) -> DataFrame:
    """lines(value, ord): address or "address | pages=N" to one row of each page; comments and blanks are skipped, repeats go."""
    s = T.stripped(F.col("value"))
    kept = lines.where((s != "") & ~s.startswith("#"))
    base = T.strip_query(T.stripped(F.split_part(s, F.lit("|"), F.lit(1))))
    pages = F.coalesce(T.found(s, r"\|.*\bpages=(\d+)(?:\s|$)").try_cast("int"), F.lit(0))
    rows = kept.select("ord", base.alias("base"), pages.alias("pages")).withColumn("page", F.explode(F.when(F.col("pages") > 0, F.sequence(F.lit(1), F.col("pages"))).otherwise(F.array(F.lit(1)))))
    url = F.when(F.col("page") == 1, F.col("base")).otherwise(F.concat("base", F.lit("?page="), F.col("page").cast("string")))
    rows = rows.select(url.alias("url"), F.when(F.col("pages") > 0, 0).otherwise(clicks).alias("clicks"), F.struct("ord", "page").alias("position"))
    return rows.groupBy("url").agg(F.min_by("clicks", "position").alias("clicks"), F.min("position").alias("position"))


def sitemap_codes(xml: DataFrame, column: str = "value", pattern: str = r"/product/(\d+)/") -> DataFrame:
    """Different codes of a sitemap's addresses, each with its first address: (code, url, position)."""
    locs = xml.select(F.posexplode(F.regexp_extract_all(column, F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))).alias("position", "url"))
    coded = locs.withColumn("code", T.found(F.col("url"), pattern)).where("code is not null")
    return coded.groupBy("code").agg(F.min_by("url", "position").alias("url"), F.min("position").alias("position"))


def extract_anchors(pages: DataFrame, key: str, html: str, prefix: str = "") -> DataFrame:
    """Different link targets that begin with prefix, with the place where each first stands."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1))).alias("position", "href"))
    return found.where(F.col("href").startswith(prefix)).groupBy(key, "href").agg(F.min("position").alias("position"))


def read_article(html, least_paragraph: int = 80, least: int = 150):
    """struct<name, text> of a page: its first heading, and its longer paragraphs; null text where these are too short."""
    name = T.strip_html(T.found(html, r"(?is)<h1[^>]*>(.*?)</h1>"))
    paragraphs = F.filter(F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1)), T.strip_html), lambda p: F.length(p) > least_paragraph)
    text = F.array_join(paragraphs, "\n\n")
    return F.struct(name.alias("name"), F.when(F.length(text) > least, text).alias("text"))
