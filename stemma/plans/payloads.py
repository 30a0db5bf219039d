"""Registered queries over raw payloads: built from the benchmark tables, read by the adapters, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators import dedupe, state
from stemma.plans import sqltext
from stemma.plans.registry import query
from stemma.plans.views import table
from stemma.sources import adapters, cards, jsonld

AS_OF = "2026-01-31"


def _parts(spark, sf_dir, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*columns)


# --- shops ---------------------------------------------------------------------
_VARIANTS = """
    array(named_struct('title', 'Default Title', 'price', concat(p_size, '.50'), 'compare_at_price', concat(p_size + p_partkey % 3 - 1, '.50'), 'available', p_size % 2 = 0, 'barcode', ''),
      named_struct('title', '6 Pack', 'price', case when p_partkey % 4 <> 0 then concat('$', p_size * 5) end, 'compare_at_price', cast(null as string), 'available', cast(null as boolean), 'barcode', lpad(p_partkey, 13, '0'))) as variants"""


def _storefront(spark, sf_dir):
    p = _parts(spark, sf_dir, "p_partkey as id", "concat('h', p_partkey) as handle", "p_name as title", "p_brand as vendor", "p_type as product_type", "array('x', lower(p_type)) as tags", "cast(null as string) as body_html", "array(named_struct('src', concat('i', p_partkey))) as images", _VARIANTS, "p_partkey as ord")
    return adapters.storefront(p, AS_OF, "shop", "Shop", "https://shop.example")


_STORE_ROWS = f"""v as (select *, 0 as place, 'Default Title' as variant, p_size + 0.5 as price, p_size + p_partkey % 3 - 1 + 0.5 as was, p_size % 2 = 0 as stock, cast(null as varchar) as barcode from part
  union all select *, 1, '6 Pack', case when p_partkey % 4 <> 0 then cast(p_size * 5 as double) end, null, false, lpad(cast(p_partkey as varchar), 13, '0') from part),
blobs as (select *, concat_ws(' ', p_name, variant, p_type, concat('x ', lower(p_type))) as blob, lower(concat_ws(' ', p_type, concat('x ', lower(p_type)), p_name)) as about,
  case when place = 0 then {sqltext.clean("p_name")} else {sqltext.stripped(f"concat_ws(' ', {sqltext.clean('p_name')}, {sqltext.clean('variant')})")} end as name from v),
parsed as (select *, p_brand as brand, {sqltext.volume("blob")} as volume_ml, coalesce({sqltext.pack("blob")}, 1) as pack_size, {sqltext.year("p_name", int(AS_OF[:4]))} as vintage, {sqltext.category("about")} as category from blobs)"""


@query(f"""
with {_STORE_ROWS}
select concat('https://shop.example/products/h', p_partkey) as url, pack_size, cast(price as double) as price_aud, cast(case when was > price then was end as double) as was_price_aud,
  cast(case when pack_size > 1 then floor(price / pack_size * 100 + 0.5) / 100 else price end as double) as unit_price_aud, stock as in_stock from parsed""")
def storefront_offers(spark, sf_dir):
    return _storefront(spark, sf_dir)[1].select("url", "pack_size", "price_aud", "was_price_aud", "unit_price_aud", "in_stock")


_RECORD = ("product_key", "name", "brand", "category", "subcategory", "volume_ml", "vintage", "abv", "gtin", "source_product_id")


@query(f"""
with {_STORE_ROWS}, {sqltext.keyed("parsed", "keyed")}
select product_key, name, brand, category, p_type as subcategory, volume_ml, vintage, {sqltext.abv("concat_ws(' ', p_name, '')")} as abv, nullif(barcode, '') as gtin, cast(p_partkey as varchar) as source_product_id
from (select *, row_number() over (partition by product_key order by p_partkey, place) as rn from keyed) where rn = 1""")
def storefront_products(spark, sf_dir):
    return _storefront(spark, sf_dir)[0].select(*_RECORD)


@query("""
with items as (select p_partkey, p_name, p_brand, p_size, p_type, p_size * 100 + p_partkey % 100 as cents from part)
select concat('https://s/', p_partkey) as url, cast(floor(cents + 0.5) / 100 as double) as price_aud, cast(case when cents + 150 > cents and p_partkey % 2 = 0 then (cents + 150) / 100.0 end as double) as was_price_aud,
  case when p_partkey % 3 = 0 then 'special' end as promo, p_size % 2 = 0 as in_stock, cast(floor(least(1, (p_partkey % 7) / 5.0) * 10000 + 0.5) / 10000 as double) as aggregate_rating_norm, nullif(cast(p_partkey % 5 as integer), 0) as aggregate_review_count
from items where cents > 0""")
def product_api_offers(spark, sf_dir):
    return _product_api(spark, sf_dir)[1].select("url", "price_aud", "was_price_aud", "promo", "in_stock", "aggregate_rating_norm", "aggregate_review_count")


def _product_api(spark, sf_dir):
    cents = "(p_size * 100 + p_partkey % 100)"
    money = lambda x: f"concat({x} div 100, '.', lpad({x} % 100, 2, '0'))"
    p = _parts(
        spark, sf_dir, "p_partkey as Stockcode", "p_name as Name", "p_brand as BrandName", "concat(p_size * 10, 'ml') as PackageSize", f"{money(cents)} as Price", f"case when p_partkey % 2 = 0 then {money(cents + ' + 150').replace(cents + ' + 150 ', '(' + cents + ' + 150) ')} end as WasPrice",
        "p_partkey % 3 = 0 as IsOnSpecial", "p_size % 2 = 0 as IsAvailable", "cast(p_partkey % 7 as double) as OverallRating", "cast(p_partkey % 5 as int) as NumberOfReviews",
        "array(named_struct('Name', 'vintage', 'Value', '2019'), named_struct('Name', 'alcohol%', 'Value', concat(p_size % 15, '.5%')), named_struct('Name', 'vintage', 'Value', '2020')) as AdditionalDetails", "concat('https://s/', p_partkey) as url", "p_partkey as ord",
    )
    return adapters.product_api(p, AS_OF, "api", "Api", "https://img/")


@query(f"""
with parsed as (select *, {sqltext.stripped("p_name")} as plain, {sqltext.clean(sqltext.stripped("p_name"))} as name, p_brand as brand, p_size * 10 as volume_ml, 2020 as vintage, coalesce({sqltext.pack("p_name")}, 1) as pack_size, {sqltext.category("lower(p_name)")} as category from part),
{sqltext.keyed("parsed", "keyed")}
select product_key, name, brand, category, cast(null as varchar) as subcategory, volume_ml, vintage, cast(p_size % 15 as double) + 0.5 as abv, cast(null as varchar) as gtin, cast(p_partkey as varchar) as source_product_id
from (select *, row_number() over (partition by product_key order by p_partkey) as rn from keyed) where rn = 1""")
def product_api_products(spark, sf_dir):
    """Of a detail that is told twice the last counts: vintage 2020, after 2019."""
    return _product_api(spark, sf_dir)[0].select(*_RECORD)


@query("""
with x as (select p_partkey, p_size * 100 as cents, case when p_partkey % 2 = 0 then p_size * 100 + (p_partkey % 5 - 2) * 50 when p_partkey % 3 = 0 then 0 end as special from part),
b as (select *, special > 0 and (coalesce(cents, 0) <= 0 or special < cents) as use from x)
select concat('https://store/p', p_partkey) as url, cast(case when use then special else cents end / 100.0 as double) as price_aud, case when use then 'special' end as promo from b where case when use then special else cents end > 0""")
def store_item_offers(spark, sf_dir):
    return _store_items(spark, sf_dir)[1].select("url", "price_aud", "promo")


def _store_items(spark, sf_dir):
    p = _parts(
        spark, sf_dir, "p_name as fullName", "p_name as name", "p_size * 10 as unitSize", "6 as packQty", "array('12', lpad(p_partkey, 13, '0')) as barcodes", "p_type as `group`", "concat('p', p_partkey) as slug", "p_partkey as id", "p_size * 100 as price_cents",
        "case when p_partkey % 2 = 0 then p_size * 100 + (p_partkey % 5 - 2) * 50 when p_partkey % 3 = 0 then 0 end as special_cents", "'s1' as store", "p_partkey as ord",
    )
    return adapters.store_items(p, AS_OF, "store", "Store", "https://store/")


@query(f"""
with parsed as (select *, {sqltext.clean("p_name")} as name, cast(null as varchar) as brand, p_size * 10 as volume_ml, {sqltext.year("p_name", int(AS_OF[:4]))} as vintage, {sqltext.category("lower(concat_ws(' ', p_type, p_name))")} as category from part),
{sqltext.keyed("parsed", "keyed")}
select product_key, name, brand, category, p_type as subcategory, volume_ml, vintage, {sqltext.abv("p_name")} as abv, lpad(cast(p_partkey as varchar), 13, '0') as gtin, cast(p_partkey as varchar) as source_product_id, 6 as carton_qty
from (select *, row_number() over (partition by product_key order by p_partkey) as rn from keyed) where rn = 1""")
def store_item_products(spark, sf_dir):
    return _store_items(spark, sf_dir)[0].select(*_RECORD, "carton_qty")


# --- structured data in pages -----------------------------------------------------
def _jsonld(spark, sf_dir) -> DataFrame:
    """Pages whose product lies one, two or thirteen levels deep, with no, one or several offers."""
    offer = "concat('{\"@type\":\"Offer\",\"price\":\"', p_size, '.25\",\"availability\":\"https://schema.org/', case when p_size % 2 = 0 then 'InStock' else 'OutOfStock' end, '\"}')"
    low = "concat('{\"@type\":\"AggregateOffer\",\"lowPrice\":', p_size, ',\"highPrice\":', p_size + 5, '}')"
    offers = f"case p_partkey % 4 when 0 then '' when 1 then concat(',\"offers\":', {offer}) when 2 then concat(',\"offers\":[', {offer}, ',', {low}, ']') else concat(',\"offers\":', {low}) end"
    product = f"concat('{{\"@type\":[\"Thing\",\"Product\"],\"name\":\"Item ', p_partkey, '\",\"sku\":\"', p_partkey, '\"', {offers}, '}}')"
    nested = "case p_partkey % 3 when 0 then j when 1 then concat('{\"@graph\":[{\"@type\":\"Page\"},', j, ']}') else concat(repeat('{\"inner\":', 13), j, repeat('}', 13)) end"
    page = f"concat('<html><script type=\"application/ld+json\">', {nested}, '</script><script type=\"application/ld+json\">{{broken</script></html>')"
    return _parts(spark, sf_dir, "*", f"{product} as j").selectExpr("p_partkey as page", f"{page} as html")


@query("""
with one as (select p_partkey, 0 as pos, concat(p_size, '.25') as price, cast(null as varchar) as was, concat('https://schema.org/', case when p_size % 2 = 0 then 'InStock' else 'OutOfStock' end) as stock from part where p_partkey % 4 in (1, 2)),
low as (select p_partkey, case when p_partkey % 4 = 2 then 1 else 0 end as pos, cast(p_size as varchar) as price, cast(p_size + 5 as varchar) as was, cast(null as varchar) as stock from part where p_partkey % 4 in (2, 3)),
every as (select * from one union all select * from low union all select p_partkey, null, null, null, null from part where p_partkey % 4 = 0)
select p_partkey as page, cast(pos as integer) as offer_at, concat('Item ', p_partkey) as name_raw, cast(p_partkey as varchar) as source_product_id, price as price_raw, was as was_price_raw, stock as availability_raw, 'AUD' as currency from every""")
def jsonld_offers(spark, sf_dir):
    found = jsonld.nodes(_jsonld(spark, sf_dir), "page", "html", ["Product"])
    return jsonld.product_offers(found, "page").select("page", "offer_at", "name_raw", "source_product_id", "price_raw", "was_price_raw", "availability_raw", "currency")


@query("select p_partkey as page, cast(case p_partkey % 3 when 0 then 1 when 1 then 3 else 14 end as integer) as depth from part")
def jsonld_depth(spark, sf_dir):
    return jsonld.nodes(_jsonld(spark, sf_dir), "page", "html", ["Product"]).select("page", F.size("path").alias("depth"))


# --- reviews -----------------------------------------------------------------------
_POST = "concat('<p>', coalesce(text, ''), '</p> Tasted <b>twice</b> with care, over a long dinner.')"


@query(f"""
select concat('n', doc_id) as source_url, cast(length({sqltext.strip_html(_POST)}) as bigint) as text_length, md5({sqltext.strip_html(_POST)}) as text_md5,
  case when doc_id % 4 <> 0 then cast(80 + doc_id % 21 as double) end as rating_raw, case when doc_id % 4 <> 0 then cast(80 + doc_id % 21 as double) / 100 end as rating_norm, '2025-03-04' as review_date
from documents where doc_id % 5 <> 0""")
def post_reviews(spark, sf_dir):
    """Every fifth post has no title, and so is no review."""
    items = table(spark, sf_dir, "documents").selectExpr("case when doc_id % 5 <> 0 then concat('<b>Note</b> ', doc_id) else '<i></i>' end as title", f"{_POST} as content", "case when doc_id % 4 <> 0 then concat(' ', 80 + doc_id % 21, ' ') else 'none' end as points", "concat('n', doc_id) as link", "'2025-03-04T10:00:00' as date")
    return adapters.posts(items, AS_OF, "notes").select("source_url", F.length("text").cast("long").alias("text_length"), F.md5("text").alias("text_md5"), "rating_raw", "rating_norm", "review_date")


@query(f"""
select concat('c', conv_id) as source_url, cast(length({sqltext.stripped("text")}) as bigint) as text_length, md5({sqltext.stripped("text")}) as text_md5, role as author, cast(turn % 6 as double) as rating_raw, cast(floor(least(1, (turn % 6) / 5.0) * 10000 + 0.5) / 10000 as double) as rating_norm, case when conv_id % 2 = 0 then turn = 1 end as recommended
from conversations where conv_id is not null and length({sqltext.stripped("coalesce(text, '')")}) >= 15""")
def api_review_dialects(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("conv_id is not null")
    first = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["text"].alias("LongDesc"), t["role"].alias("Name"), (t["turn"] % 6).cast("double").alias("Rating"), F.lit("t").alias("Title"), F.lit("3 June 2025").alias("DateSubmitted"), (t["turn"] == 1).alias("IsRecommended"), F.lit(1).alias("Likes"), F.lit(None).cast("string").alias("SyndReviewSource")))
    second = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["text"].alias("description"), t["role"].alias("displayName"), (t["turn"] % 6).cast("double").alias("rating"), F.lit("t").alias("title"), F.lit("2025-06-03").alias("date"), F.lit(None).cast("boolean").alias("wouldRecommend"), F.lit(1).alias("helpful_yes"), F.lit(None).cast("string").alias("SourceClient")))
    both = c.groupBy("conv_id").agg(first.alias("a"), second.alias("b"))
    payloads = both.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("url"), F.lit("p").alias("product_name"), F.when(F.col("conv_id") % 2 == 0, F.col("a")).alias("Reviews"), F.when(F.col("conv_id") % 2 != 0, F.col("b")).alias("reviews_b"))
    return adapters.api_reviews(payloads, AS_OF, "api").select("source_url", F.length("text").cast("long").alias("text_length"), F.md5("text").alias("text_md5"), "author", "rating_raw", "rating_norm", "recommended")


@query("""
with h as (select l_partkey, l_linenumber, count(*) as n from lineitem group by 1, 2),
s as (select l_partkey, string_agg(concat(l_linenumber, '=', n), ';' order by l_linenumber) as histogram, cast(sum(n) as integer) as total, sum(n * l_linenumber) * 1.0 / sum(n) as average from h group by 1)
select concat('p', l_partkey) as source_url, case when l_partkey % 2 = 0 then histogram end as histogram, total as total_reviews, floor(case when l_partkey % 2 = 0 then average else 4.0 end * 10000 + 0.5) / 10000 as average_rating, case when l_partkey % 2 = 0 then 90.0 else 87.0 end as pct_recommend from s""")
def api_summary_dialects(spark, sf_dir):
    """Each first star stands twice, and every third product's total is under its other name."""
    h = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linenumber").agg(F.count("*").alias("n"))
    s = h.groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("RatingValue"), F.col("n").alias("Count")))).alias("hist"), F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("l_linenumber")) / F.sum("n")).alias("average"))
    even = F.col("l_partkey") % 2 == 0
    overall = F.struct(F.lit(4.0).alias("rating"), F.col("total").alias("totalReviews"), F.lit("87 %").alias("percentageRecommending"))
    payloads = s.select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("url"), F.lit("n").alias("product_name"), F.when(even, F.concat(F.slice("hist", 1, 1), "hist")).alias("RatingDistribution"), F.col("average").alias("OverallRating"), F.when(F.col("l_partkey") % 3 != 0, F.col("total")).when(F.col("l_partkey") % 4 == 0, F.lit(0)).alias("TotalReviewCount"), F.col("total").alias("TotalResults"), F.lit(90).alias("RecommendedPercentage"), overall.alias("overall"))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("distribution")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return adapters.api_summaries(payloads, AS_OF, "api").select("source_url", text.alias("histogram"), "total_reviews", "average_rating", "pct_recommend")


# --- prices asked for again, and tiles ------------------------------------------------
@query("select cast(p_partkey as varchar) as stockcode, case p_partkey % 3 when 0 then concat(p_size, '.5') when 1 then concat(p_size, '.25') end as price, case when p_partkey % 2 = 0 then concat(p_size, '.1') end as member_price, case when p_partkey % 5 = 0 then '6 pack' else '750ml' end as unit from part")
def enriched_prices(spark, sf_dir):
    value = lambda x: f"named_struct('Value', {x})"
    price = value("case p_partkey % 3 when 0 then concat(p_size, '.5') when 1 then concat(p_size, '.25') end")
    member = value("case when p_partkey % 2 = 0 then concat(p_size, '.1') end")
    prices = f"named_struct('SinglePrice', {price}, 'promoprice', {value('cast(null as string)')}, 'MemberOffer', {member}) as Prices"
    rows = _parts(spark, sf_dir, "p_partkey as Stockcode", prices, "case when p_partkey % 5 = 0 then '6 pack' end as Unit", "'750ml' as PackageSize", "4.5 as Rating", "3 as Reviews", "true as IsAvailable", "'u' as url")
    return adapters.enriched_rows(rows).select("stockcode", "price", "member_price", "unit")


@query("""
select concat(p_brand, ' ', p_name) as name_raw, case when p_partkey % 2 = 0 then concat(p_size + 3, '.00') else concat(p_size, '.00') end as price_raw, case when p_partkey % 3 = 0 then concat(p_size, '.00') end as member_price_raw,
  case when p_partkey % 5 = 0 then '2 for $30' end as promo_raw, nullif(cast(p_partkey % 4 as integer), 0) as aggregate_review_count from part""")
def tiles_of_one_price(spark, sf_dir):
    tiles = _parts(spark, sf_dir, "p_brand as brand", "p_name as subtitle", "concat('$', p_size, '.00') as shown", "concat('now $', p_size, '.00', case when p_partkey % 2 = 0 then concat(' Non-Member: $', p_size + 3, '.00') else '' end, case when p_partkey % 3 = 0 then ' Member Offer' else '' end, case when p_partkey % 5 = 0 then ' 2 for $30' else '' end) as full", "'ea' as unit", "concat('u', p_partkey) as url", "concat('(', p_partkey % 4, ')') as reviews_text")
    return adapters.tiles_a(tiles).select("name_raw", "price_raw", "member_price_raw", "promo_raw", "aggregate_review_count")


@query("""
select concat_ws(' ', p_brand, p_name) as name_raw, concat(p_size, '.', case when p_partkey % 2 = 0 then '95' else '00' end) as price_raw, case when p_partkey % 3 = 0 then concat(p_size + 1, '.00') end as was_price_raw, concat('', p_partkey) as source_product_id from part""")
def tiles_of_two_parts(spark, sf_dir):
    tiles = _parts(spark, sf_dir, "p_brand as brand", "p_name as name", "cast(p_size as string) as dollars", "case when p_partkey % 2 = 0 then '95' end as cents", "case p_partkey % 3 when 0 then cast(p_size + 1 as string) when 1 then cast(p_size - 1 as string) end as was_dollars", "cast(null as string) as was_cents", "concat('/shop/x_y_', p_partkey) as href")
    return adapters.tiles_b(tiles).select("name_raw", "price_raw", "was_price_raw", "source_product_id")


# --- captured pages ---------------------------------------------------------------------
@query(f"""
with r as (select doc_id, {sqltext.stripped("coalesce(text, '')")} as t, doc_id % 6 as raw, case when doc_id % 2 = 0 then 10 end as scale from documents)
select concat('https://r/', doc_id) as source_url, cast(length(t) as bigint) as text_length, md5(t) as text_md5, cast(floor(least(1, raw / cast(coalesce(scale, 5) as double)) * 10000 + 0.5) / 10000 as double) as rating_norm, 'unknown' as source, '2026-06-19' as review_date from r where length(t) >= 15""")
def captured_reviews(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    items = d.selectExpr("'' as source", "cast(null as string) as subject_type", "concat('https://r/', doc_id) as source_url", "'p' as product_name_raw", "cast(null as string) as author", "'t' as title", "text", "cast(doc_id % 6 as double) as rating_raw", "case when doc_id % 2 = 0 then 10.0 end as rating_scale", "'19 June 2026' as review_date", "'Newest' as sort_order", "doc_id as ord")
    return adapters.ingest_reviews(items, AS_OF).select("source_url", F.length("text").cast("long").alias("text_length"), F.md5("text").alias("text_md5"), "rating_norm", "source", "review_date")


@query("""
with o as (select p_partkey, cast(p_size as double) + 0.5 as price, case when p_partkey % 2 = 0 then cast(p_size as double) end as member from part where p_partkey % 4 <> 0 union all select p_partkey, null, case when p_partkey % 2 = 0 then cast(p_size as double) end from part where p_partkey % 4 = 0)
select concat('https://c/', p_partkey) as url, 'The Shop' as retailer, price as price_aud, member as member_price_aud, case when p_partkey % 3 = 0 and price is not null then price + 2 end as was_price_aud, case p_partkey % 3 when 0 then true when 1 then false end as in_stock from o where coalesce(price, member) is not null""")
def captured_offers(spark, sf_dir):
    return _captured(spark, sf_dir)[1].select("url", "retailer", "price_aud", "member_price_aud", "was_price_aud", "in_stock")


def _captured(spark, sf_dir):
    items = _parts(
        spark, sf_dir, "'shop' as source", "'The Shop' as retailer", "concat('https://c/', p_partkey) as source_url", "cast(p_partkey as string) as source_product_id", "concat(p_name, ' no', p_partkey) as name_raw", "p_brand as brand_raw", "cast(null as string) as description_raw", "p_type as subcategory_raw",
        "case when p_partkey % 4 <> 0 then concat('$', p_size, '.50') end as price_raw", "case when p_partkey % 2 = 0 then concat('$', p_size) end as member_price_raw", "case p_partkey % 3 when 0 then concat(p_size + 2, '.50') else '0.10' end as was_price_raw", "cast(null as string) as promo_raw", "cast(null as string) as unit_raw",
        "case p_partkey % 3 when 0 then 'https://schema.org/InStock' when 1 then 'Sold out' end as availability_raw", "4.0 as aggregate_rating_raw", "5.0 as aggregate_rating_scale", "7 as aggregate_review_count", "'i' as image_url", "cast(null as string) as gtin", "'AUD' as currency", "p_partkey as ord",
    )
    return adapters.ingest_products(items, AS_OF, {"shop": "The Shop"})


@query(f"""
with raw as (select *, concat(p_name, ' no', p_partkey) as name_raw, concat_ws(' ', concat(p_name, ' no', p_partkey), p_type, '') as blob from part),
parsed as (select *, {sqltext.clean("name_raw")} as name, p_brand as brand, {sqltext.volume("blob")} as volume_ml, {sqltext.year("name_raw", int(AS_OF[:4]))} as vintage, {sqltext.category("lower(concat_ws(' ', p_type, name_raw))")} as category from raw),
{sqltext.keyed("parsed", "keyed")}
select product_key, name, brand, category, p_type as subcategory, volume_ml, vintage, {sqltext.abv("blob")} as abv, cast(null as varchar) as gtin, cast(p_partkey as varchar) as source_product_id
from (select *, row_number() over (partition by product_key order by p_partkey) as rn from keyed) where rn = 1""")
def captured_products(spark, sf_dir):
    return _captured(spark, sf_dir)[0].select(*_RECORD)


# --- what came back, by address -------------------------------------------------------------
def _targets(spark, sf_dir) -> DataFrame:
    """Every second product's page, some as a numbered page of a list."""
    return _parts(spark, sf_dir, "concat('https://l/', p_partkey, case when p_partkey % 3 = 0 then '?page=2' else '' end) as url", "p_partkey as position").where("position % 2 = 0")


_TARGETS = "targets as (select concat('https://l/', p_partkey, case when p_partkey % 3 = 0 then '?page=2' else '' end) as url, p_partkey as position from part where p_partkey % 2 = 0)"


@query(f"""
with {_TARGETS}, reports as (select concat('https://l/', p_partkey, case when p_partkey % 5 = 0 then '?page=2' when p_partkey % 5 = 1 then '?ref=x' else '' end) as reported from part)
select reported, coalesce(e.url, p.url) as url, coalesce(e.position, p.position) as position from reports left join targets e on e.url = reported left join targets p on not contains(p.url, '?') and p.url = split_part(reported, '?', 1)""")
def listing_lookup(spark, sf_dir):
    reports = _parts(spark, sf_dir, "concat('https://l/', p_partkey, case when p_partkey % 5 = 0 then '?page=2' when p_partkey % 5 = 1 then '?ref=x' else '' end) as reported")
    return state.find_listing(reports, "reported", _targets(spark, sf_dir))


@query(f"""
with {_TARGETS}, r as (select split_part(concat('https://l/', l_partkey, '?x=', l_linenumber), '?', 1) as path, l_linenumber as n, l_linenumber = 7 as done from lineitem),
t as (select *, split_part(url, '?', 1) as path, row_number() over (partition by split_part(url, '?', 1) order by position) as rn from targets)
select t.url, t.position, cast(sum(n) as bigint) as harvested, bool_or(r.done) as done from t join r using (path) where rn = 1 group by all""")
def reviews_by_path(spark, sf_dir):
    reports = table(spark, sf_dir, "lineitem").selectExpr("concat('https://l/', l_partkey, '?x=', l_linenumber) as url", "l_linenumber as n", "case when l_linenumber = 7 then 'done' else 'partial' end as kind")
    return state.mark_by_path(reports, _targets(spark, sf_dir))


@query(f"with {_TARGETS} select p_partkey as code, coalesce(t.url, concat('https://shop.example/product/', p_partkey, '/')) as url from part left join targets t on t.position = p_partkey")
def default_url(spark, sf_dir):
    codes, known = _parts(spark, sf_dir, "p_partkey as code"), _targets(spark, sf_dir).select(F.col("position").alias("code"), "url")
    return state.url_or_default(codes, known, "code", "https://shop.example/product/")


# --- cards of pages ---------------------------------------------------------------------------
_CARD = """concat('<!-- <div class="review-card"> --><DIV class="x review-card"><h3 class="review-card__title">T', doc_id, '</h3></i>', case when doc_id % 4 <> 0 then concat('<span class="review-card__sdesc">by<br> ', lang, '</span>') else '' end,
  '<p class="review-card__ldesc">', replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), ' Read more</p>', repeat('<b class="rating-icon checked"></b>', cast(doc_id % 6 as int)), '</div><![foo[x]]>')"""


def _card_pages(spark, sf_dir) -> DataFrame:
    """A hundred documents as review cards to a page."""
    each = table(spark, sf_dir, "documents").selectExpr("concat('https://r/', doc_id div 100) as url", "doc_id", f"{_CARD} as card")
    return each.groupBy("url").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "card"))), lambda x: x["card"]), "\n").alias("html"))


@query(f"""
with t as (select doc_id, concat('https://r/', doc_id // 100) as url, case when doc_id % 4 <> 0 then concat('by ', lang) end as author, trim(regexp_replace(concat(coalesce(text, ''), ' Read more'), '[{sqltext.WHITE}\\x1c-\\x1f]+', ' ', 'g')) as shown, doc_id % 6 as stars from documents),
d as (select *, {sqltext.stripped("regexp_replace(regexp_replace(shown, '(?i)\\s*Read (?:more|less)\\s*$', ''), '[\\s^]+$', '')")} as body from t),
k as (select *, row_number() over (partition by url, substr(body, 1, 120), coalesce(author, '') order by concat('T', doc_id), body) as rn from d where length(body) >= 15)
select url, concat('T', doc_id) as title, author, md5(body) as text_md5, cast(nullif(stars, 0) as double) as rating_raw, cast(5 as double) as rating_scale, 'retailer_cards' as source from k where rn = 1""")
def site_review_cards(spark, sf_dir):
    """Pages with comments, unknown declarations, stray end tags and capitals in their markup."""
    found = cards.site_reviews(_card_pages(spark, sf_dir), "url", "html", "retailer_cards", "cards")
    return found.select("url", "title", "author", F.md5("text").alias("text_md5"), "rating_raw", "rating_scale", "source")


@query("""
with r as (select p_partkey, unnest(['One', 'Two']) as name, unnest([0, 1]) as k from part), w as (select *, unnest(range(0, cast(1 + (p_partkey + k) % 2 as bigint))) as n from r)
select concat('https://p/', p_partkey) as url, concat(name, ' ', p_partkey) as product_name_raw, concat('A', n) as author, concat('Review ', n, ' of ', name, ', which is long enough') as text, cast(1 + n as double) as rating_raw from w""")
def product_review_arrays(spark, sf_dir):
    """Two products to a page, each with one review or two: every review is its own product's."""
    review = lambda name, n: f"""concat('{{"@type":"Review","author":{{"name":"A{n}"}},"reviewBody":"Review {n} of {name}, which is long enough","reviewRating":{{"ratingValue":{n + 1},"bestRating":5}}}}')"""
    product = lambda name, at: f"""concat('{{"@type":"Product","name":"{name} ', p_partkey, '","review":[', {review(name, 0)}, case when (p_partkey + {at}) % 2 = 1 then concat(',', {review(name, 1)}) else '' end, ']}}')"""
    page = f"""concat('<script type="application/ld+json">[', {product("One", 0)}, ',', {product("Two", 1)}, ']</script>')"""
    pages = _parts(spark, sf_dir, "concat('https://p/', p_partkey) as url", f"{page} as html")
    return jsonld.review_arrays(jsonld.nodes(pages, "url", "html", ["Product"]), "url").select("url", "product_name_raw", "author", "text", "rating_raw")


@query("""
with h as (select l_partkey, l_linenumber, count(*) as n from lineitem group by 1, 2), s as (select l_partkey, string_agg(concat(l_linenumber, '=', n), ';' order by l_linenumber) as histogram, sum(n) as total from h group by 1)
select concat('https://c/', l_partkey) as url, case when l_partkey % 3 <> 0 then histogram end as histogram, cast(case when l_partkey % 3 <> 0 then total else l_partkey + 1 end as integer) as total_reviews, case when l_partkey % 3 = 0 then 3.5 when l_partkey % 2 = 0 then 4.25 end as average_rating, case when l_partkey % 3 <> 0 and l_partkey % 2 = 0 then 81.0 end as pct_recommend from s""")
def page_rating_charts(spark, sf_dir):
    """Charts of stars, whose first row stands twice with another count, beside what pages say in words; every third page has structured data alone."""
    h = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linenumber").agg(F.count("*").alias("n"))
    row = lambda n: F.concat(F.lit('<li class="rating-chart__row"><b class="rating-chart__rating">'), F.col("l_linenumber").cast("string"), F.lit('</b><i class="rating-chart__review-count">('), n, F.lit(" reviews)</i></li>"))
    rows = h.groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", row(F.lit("9,999")).alias("other"), row(F.format_number("n", 0)).alias("row")))).alias("rows"))
    chart = F.concat(F.col("rows")[0]["other"], F.array_join(F.transform("rows", lambda r: r["row"]), ""))
    words = F.when(F.col("l_partkey") % 2 == 0, "<p>Average customer rating: <b>4.25</b></p> <p>81% of reviewers would recommend</p>").otherwise("")
    data = F.concat(F.lit('<script type="application/ld+json">{"@type":"Product","name":"p","aggregateRating":{"ratingValue":"3.5","reviewCount":'), (F.col("l_partkey") + 1).cast("string"), F.lit("}}</script>"))
    pages = rows.select(F.concat(F.lit("https://c/"), F.col("l_partkey").cast("string")).alias("url"), F.when(F.col("l_partkey") % 3 == 0, data).otherwise(F.concat(words, F.lit("<ul>"), chart, F.lit("</ul>"))).alias("html"))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("distribution")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return cards.page_summaries(pages, "url", "html").select("url", text.alias("histogram"), "total_reviews", "average_rating", "pct_recommend")


@query("select doc_id, case doc_id % 4 when 0 then 'Great stuff' when 1 then 'Great stuff' when 2 then 'Great stuff ^ up' else '' end as plain, case doc_id % 3 when 0 then cast(doc_id as varchar) when 1 then cast(doc_id as varchar) end as product_id from documents")
def review_labels(spark, sf_dir):
    """Expanders' labels and carets off, and products' figures out of addresses."""
    text = F.expr("case doc_id % 4 when 0 then 'Great stuff  Read more ' when 1 then ' Great stuff ^^ ' when 2 then 'Great stuff ^ up' else 'Read less' end")
    url = F.expr("case doc_id % 3 when 0 then concat('https://s/product/AB_', doc_id, '/name?x=_7') when 1 then concat('https://s/red/x_', doc_id, '?p=1') else concat('https://s/list/', doc_id) end")
    return table(spark, sf_dir, "documents").select("doc_id", T.detoggled(text).alias("plain"), T.url_product_id(url).alias("product_id"))


@query("select p_partkey, case when p_partkey % 3 = 0 then concat('n', p_partkey) end as name_raw, case when p_partkey % 2 = 0 then concat('$', p_size) end as price_raw, min(l_orderkey) as ord from part join lineitem on l_partkey = p_partkey group by all")
def payload_products(spark, sf_dir):
    """A product's payload comes once for each of its orders; one of each name, price and address stays."""
    rows = table(spark, sf_dir, "part").join(table(spark, sf_dir, "lineitem"), F.col("l_partkey") == F.col("p_partkey"))
    items = rows.selectExpr("p_partkey", "case when p_partkey % 3 = 0 then concat('n', p_partkey) end as name_raw", "case when p_partkey % 2 = 0 then concat('$', p_size) end as price_raw", "concat('https://x/', p_partkey) as source_url", "l_orderkey as ord", "l_linenumber")
    return dedupe.dedupe_payload_products(items, ["ord", "l_linenumber"]).select("p_partkey", "name_raw", "price_raw", "ord")


# --- names of sources and details ---------------------------------------------------------------
@query("""
select p_partkey, case p_partkey % 4 when 2 then 'two' when 3 then concat('new_place_', p_partkey) else 'shop_one' end as source, case p_partkey % 4 when 2 then 'Two!' when 3 then 'X' else 'Shop One' end as retailer from part""")
def canonical_sources(spark, sf_dir):
    """Known sources, arguments the wrong way round, known displays, and names of their own."""
    rows = _parts(spark, sf_dir, "p_partkey", "case p_partkey % 4 when 0 then 'shop_one' when 1 then 'Shop One' when 2 then concat('Cellar ', p_partkey) else concat('New Place (', p_partkey, ')') end as s", "case p_partkey % 4 when 0 then 'Whatever' when 1 then 'shop_one' when 2 then 'Two!' else 'X' end as r")
    who = T.canonical_source(F.col("s"), F.col("r"), {"shop_one": "Shop One", "two": "Two!"})
    return rows.select("p_partkey", who.alias("w")).select("p_partkey", "w.source", "w.retailer")


@query("select p_partkey, p_partkey % 4 in (0, 2) as same from part")
def same_pages(spark, sf_dir):
    """Equal figures of products, other ones, equal pages of no product, and one page with and one without a figure."""
    a = "case p_partkey % 4 when 0 then concat('https://s/product/AB_', p_partkey, '/x?y') when 1 then concat('https://s/a_', p_partkey) when 2 then concat('https://s/list?x=', p_partkey) else concat('https://s/list/', p_partkey) end as a"
    b = "case p_partkey % 4 when 0 then concat('https://s/product/', p_partkey, '/z') when 1 then concat('https://s/product/', p_partkey + 1) when 2 then 'https://s/list' else concat('https://s/product/', p_partkey) end as b"
    return _parts(spark, sf_dir, "p_partkey", a, b).select("p_partkey", T.same_page(F.col("a"), F.col("b")).alias("same"))


@query("""
select p_partkey, case p_partkey % 3 when 0 then concat('http://x/', p_partkey, '.png') when 1 then concat('https://cdn/Pic', p_partkey) end as image, case when p_partkey % 2 = 0 then p_size + 0.5::double end as figure,
  case when p_partkey % 5 <> 0 then concat('a ', p_name) end as joined, case when p_partkey % 4 <> 0 then concat(p_name, ' x ', p_size) end as collapsed, concat('é&A ', p_size) as decoded from part""")
def detail_values(spark, sf_dir):
    rows = _parts(
        spark, sf_dir, "p_partkey", "case p_partkey % 3 when 0 then concat('http://x/', p_partkey, '.png') when 1 then concat(' Pic', p_partkey, '.PNG ') else '  ' end as i", "case when p_partkey % 2 = 0 then concat(' ', p_size, '.5%% ') else 'n/a' end as f",
        "case when p_partkey % 5 <> 0 then array('a', p_name) else array('', '') end as j", "case when p_partkey % 4 <> 0 then concat('\\u00a0 ', p_name, '\\t\\n x \\u2003', p_size, ' ') else ' \\u3000 ' end as c", "concat('&eacute;&amp;&#x41; ', p_size) as h",
    )
    c = F.col
    return rows.select("p_partkey", T.image_url(c("i"), "https://cdn/").alias("image"), T.as_float(c("f")).alias("figure"), T.joined_text(c("j")).alias("joined"), T.collapsed(c("c")).alias("collapsed"), T.html_text(c("h")).alias("decoded"))
