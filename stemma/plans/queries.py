"""Registered queries over the catalogue operators, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as T
from stemma.operators import catalogue, compare, dedupe, resolve, sampling, similarity, state
from stemma.plans import payloads, sqltext  # noqa: F401  the first registers its queries
from stemma.plans.registry import ORACLES, QUERIES, query
from stemma.plans.views import table, view
from stemma.sources import readers

YEAR = 2026
OFFER_ORDER = ["o1", "o2", "o3", "o4", "o5", "o6", "o7", "o8", "o9", "o10"]
_ORD = "o1, o2, o3, o4, o5, o6, o7, o8, o9, o10"


# --- prices ------------------------------------------------------------------
_SAME_PACK = """
usable as (select * from v_offer where pack_size <> 0 and price_aud is not null),
cheapest as (select product_key, pack_size, retailer, min(price_aud) as price from usable group by 1, 2, 3),
packs as (select product_key, pack_size, min(price) as lo, max(price) as hi, min_by(retailer, (price, retailer)) as compare_cheapest,
  string_agg(concat(retailer, '=', printf('%.2f', price)), ';' order by retailer) as prices from cheapest group by 1, 2 having count(*) >= 2),
spread as (select *, floor((hi - lo) / lo * 100 * 10 + 0.5) / 10 as compare_spread_pct from packs where lo > 0),
same_pack as (select product_key, 'same_pack' as compare_basis, pack_size as compare_pack_size, prices, compare_spread_pct, compare_cheapest, compare_spread_pct > 150 as compare_suspect
  from (select *, row_number() over (partition by product_key order by compare_spread_pct desc, pack_size) as rn from spread) where rn = 1)"""
_UNIT = """
units as (select product_key, retailer, min(floor(price_aud / pack_size * 100 + 0.5) / 100) as price from v_offer where pack_size <> 0 and price_aud is not null group by 1, 2),
n_packs as (select product_key, count(distinct pack_size) as n from v_offer where pack_size <> 0 and price_aud is not null group by 1),
whole as (select product_key, min(price) as lo, max(price) as hi, min_by(retailer, (price, retailer)) as compare_cheapest, string_agg(concat(retailer, '=', printf('%.2f', price)), ';' order by retailer) as prices
  from units group by 1 having count(*) > 1),
unit_price as (select product_key, 'unit_price' as compare_basis, cast(null as integer) as compare_pack_size, prices, floor((hi - lo) / lo * 100 * 10 + 0.5) / 10 as compare_spread_pct, compare_cheapest,
  floor((hi - lo) / lo * 100 * 10 + 0.5) / 10 > 150 as compare_suspect from whole join n_packs using (product_key) where n > 1 and lo > 0)"""


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("prices", compare.prices_text()).drop("compare_prices")


@query("with " + _SAME_PACK + " select * from same_pack")
def compare_same_pack(spark, sf_dir):
    return _flat(compare.compare_same_pack(view(spark, sf_dir, "offer")))


@query("with " + _UNIT + " select * from unit_price")
def compare_unit_price(spark, sf_dir):
    return _flat(compare.compare_unit_price(view(spark, sf_dir, "offer")))


@query(
    "with " + _SAME_PACK + "," + _UNIT + """, keys as (select distinct product_key from v_offer),
  best as (select * from same_pack union all select * from unit_price where product_key not in (select product_key from same_pack))
  select keys.product_key, compare_basis, compare_pack_size, coalesce(prices, '') as prices, compare_spread_pct, compare_cheapest, coalesce(compare_suspect, false) as compare_suspect from keys left join best using (product_key)"""
)
def compare_best(spark, sf_dir):
    return _flat(compare.compare_offers(view(spark, sf_dir, "offer")))


@query("with " + _SAME_PACK + ", best as (select * from (select *, row_number() over (partition by product_key order by compare_spread_pct > 150, compare_spread_pct desc, pack_size) as rn from spread) where rn = 1) select product_key, pack_size as compare_pack_size, compare_spread_pct, compare_cheapest from best")
def compare_prefer_trusted(spark, sf_dir):
    return compare.compare_same_pack(view(spark, sf_dir, "offer"), prefer_trusted=True).select("product_key", "compare_pack_size", "compare_spread_pct", "compare_cheapest")


def _signed(spark, sf_dir) -> DataFrame:
    """Offers with coarse prices and days, so that signatures repeat."""
    v = view(spark, sf_dir, "offer")
    bucket = F.floor(F.col("price_aud") / F.col("pack_size") / 500)
    return v.withColumn("price_aud", bucket.cast("double")).withColumn("member_price_aud", F.floor(F.col("member_price_aud") / 500).cast("double")).withColumn("scraped_at", F.date_format("day", "yyyy"))


_SIGNED = "signed as (select product_key, retailer, pack_size, promo, was_price_aud, availability, cast(floor(price_aud / pack_size / 500) as double) as price_aud, cast(floor(member_price_aud / 500) as double) as member_price_aud, cast(year(day) as varchar) as scraped_at, " + _ORD + " from v_offer)"


@query(f"with {_SIGNED} select product_key, retailer, price_aud, member_price_aud, scraped_at, o1, o2, o3 from (select *, row_number() over (partition by product_key, retailer, price_aud, member_price_aud, scraped_at order by {_ORD}) as rn from signed where coalesce(price_aud, member_price_aud) is not null) where rn = 1")
def offer_dedupe_ingest(spark, sf_dir):
    return dedupe.dedupe_offers_ingest(_signed(spark, sf_dir), OFFER_ORDER).select("product_key", "retailer", "price_aud", "member_price_aud", "scraped_at", "o1", "o2", "o3")


@query(f"with {_SIGNED} select product_key, retailer, price_aud, scraped_at, promo, o1, o2, o3 from (select *, row_number() over (partition by product_key, retailer, price_aud, scraped_at order by cast(member_price_aud is not null as int) + cast(promo is not null as int) + cast(was_price_aud is not null as int) + cast(availability is not null as int) desc, {_ORD}) as rn from signed) where rn = 1")
def offer_dedupe_resolve(spark, sf_dir):
    score = T.informativeness(*[F.col(c) for c in ("member_price_aud", "promo", "was_price_aud", "availability")])
    return dedupe.dedupe_offers_resolve(_signed(spark, sf_dir), score, OFFER_ORDER).select("product_key", "retailer", "price_aud", "scraped_at", "promo", "o1", "o2", "o3")


@query("select product_key, o1, o2, o3, o4, case when pack_size > 1 then floor(coalesce(price_aud, member_price_aud) / pack_size * 100 + 0.5) / 100 else coalesce(price_aud, member_price_aud) end as unit_price from v_offer")
def unit_price(spark, sf_dir):
    return view(spark, sf_dir, "offer").select("product_key", "o1", "o2", "o3", "o4", T.unit_price(F.col("price_aud"), F.col("member_price_aud"), F.col("pack_size")).alias("unit_price"))


@query("select product_key, o1, o2, o3, o4, case when was_price_aud > price_aud then was_price_aud end as was from v_offer")
def was_price_gate(spark, sf_dir):
    return view(spark, sf_dir, "offer").select("product_key", "o1", "o2", "o3", "o4", T.was_price(F.col("was_price_aud"), F.col("price_aud")).alias("was"))


@query("select product_key, o1, o2, o3, o4, case when availability = 'Sold out' then false when availability = 'In Stock' then true end as in_stock from v_offer")
def in_stock(spark, sf_dir):
    return view(spark, sf_dir, "offer").select("product_key", "o1", "o2", "o3", "o4", T.in_stock(F.col("availability")).alias("in_stock"))


# --- text ----------------------------------------------------------------------
_VOLUME_SQL, _PACK_SQL, _YEAR_SQL = sqltext.volume("name_raw"), sqltext.pack("name_raw"), sqltext.year("name_raw", YEAR)


@query(f"select ord, {_VOLUME_SQL} as volume_ml from v_listing")
def parse_volume(spark, sf_dir):
    return view(spark, sf_dir, "listing").select("ord", T.parse_volume_ml(F.col("name_raw")).alias("volume_ml"))


@query(f"select ord, {_PACK_SQL} as pack_size from v_listing")
def parse_pack(spark, sf_dir):
    return view(spark, sf_dir, "listing").select("ord", T.parse_pack_size(F.col("name_raw")).alias("pack_size"))


@query(f"select ord, {sqltext.abv('name_raw')} as abv from v_listing")
def parse_abv(spark, sf_dir):
    return view(spark, sf_dir, "listing").select("ord", T.parse_abv(F.col("name_raw")).alias("abv"))


@query(f"select ord, {_YEAR_SQL} as vintage from v_listing")
def parse_vintage(spark, sf_dir):
    return view(spark, sf_dir, "listing").select("ord", T.parse_vintage(F.col("name_raw"), YEAR).alias("vintage"))


@query(f"select ord, {sqltext.price('price_raw')} as price, floor(price * 100 + 0.5) / 100 as price_number from v_listing")
def parse_price(spark, sf_dir):
    return view(spark, sf_dir, "listing").select("ord", T.parse_price(F.col("price_raw")).alias("price"), T.price_number(F.col("price")).alias("price_number"))


_CATEGORY_SQL = sqltext.category("blob")


@query(f"select ord, {_CATEGORY_SQL} as category from (select ord, lower(name_raw) as blob from v_listing)")
def guess_category(spark, sf_dir):
    return view(spark, sf_dir, "listing").select("ord", T.guess_category(F.col("name_raw")).alias("category"))


_HINTED = "concat('https://shop.example/', lower(case ord % 5 when 0 then 'beer/all' when 1 then 'list/Wine' when 2 then 'spirits/premix-drinks' when 3 then 'deals' else 'origin' end), '?cat=cider')"
_URL_SQL = "case " + " ".join("when " + " or ".join(f"contains(path, '{p}')" for p in parts) + f" then '{name}'" for name, parts in T.URL_CATEGORY_PARTS.items()) + " end"


def _hinted():
    i = F.col("ord") % 5
    part = F.when(i == 0, "beer/all").when(i == 1, "list/Wine").when(i == 2, "spirits/premix-drinks").when(i == 3, "deals").otherwise("origin")
    return F.concat(F.lit("https://shop.example/"), F.lower(part), F.lit("?cat=cider"))


@query(f"select page_id, {_URL_SQL} as category from (select page_id, lower(split_part(url, '?', 1)) as path from pages)")
def category_from_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.category_from_url(F.col("url")).alias("category"))


@query(f"select ord, coalesce(nullif(g, 'other'), h, g, 'other') as category from (select ord, {_CATEGORY_SQL} as g, {_URL_SQL} as h from (select ord, lower(name_raw) as blob, split_part({_HINTED}, '?', 1) as path from v_listing))")
def resolve_category(spark, sf_dir):
    return view(spark, sf_dir, "listing").select("ord", T.resolve_category(T.guess_category(F.col("name_raw")), T.category_from_url(_hinted())).alias("category"))


@query(f"select ord, {sqltext.clean('name_raw')} as name from v_listing")
def clean_name(spark, sf_dir):
    return view(spark, sf_dir, "listing").select("ord", T.clean_name(F.col("name_raw")).alias("name"))


_PRODUCTS = f"""named as (select ord, brand, name_raw, gtin, price, size, {sqltext.clean("name_raw")} as name, {_VOLUME_SQL} as volume_ml, {_YEAR_SQL} as vintage, coalesce({_PACK_SQL}, 1) as pack_size from v_listing),
{sqltext.keyed("named", "products", of="name_raw")}"""


def _products(spark, sf_dir) -> DataFrame:
    c = F.col
    v = view(spark, sf_dir, "listing").withColumns({"name": T.clean_name(c("name_raw")), "volume_ml": T.parse_volume_ml(c("name_raw")), "vintage": T.parse_vintage(c("name_raw"), YEAR), "pack_size": F.coalesce(T.parse_pack_size(c("name_raw")), F.lit(1))})
    return v.withColumns({"slug": T.match_slug(c("brand"), c("name"), c("volume_ml"), c("vintage")), "bare_slug": T.match_slug(c("brand"), c("name"), F.lit(None).cast("int"), c("vintage")), "product_key": T.product_key(c("brand"), c("name"), c("volume_ml"), c("vintage"))})


@query(f"with {_PRODUCTS} select ord, slug from products")
def match_slug(spark, sf_dir):
    return _products(spark, sf_dir).select("ord", "slug")


@query(f"with {_PRODUCTS} select ord, product_key from products")
def product_key(spark, sf_dir):
    return _products(spark, sf_dir).select("ord", "product_key")


@query("select ord, substr(sha1(concat(source, '|', '', '|', coalesce(author, ''), '|', substr(coalesce(text, ''), 1, 200))), 1, 16) as review_key from v_review")
def review_key(spark, sf_dir):
    return view(spark, sf_dir, "review").select("ord", T.review_key(F.col("source"), F.lit(""), F.col("author"), F.col("text")).alias("review_key"))


@query("select ord, case when rating_raw is not null and rating_scale is not null then floor(greatest(0.0, least(1.0, rating_raw / rating_scale)) * 10000 + 0.5) / 10000 end as rating_norm from v_review")
def norm_rating(spark, sf_dir):
    return view(spark, sf_dir, "review").select("ord", T.norm_rating(F.col("rating_raw"), F.col("rating_scale")).alias("rating_norm"))


@query("select doc_id, source, regexp_replace(regexp_replace(lower(concat(source, ' (', lang, ')')), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g') as slug from documents")
def slugify(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", T.slugified(F.concat("source", F.lit(" ("), "lang", F.lit(")"))).alias("slug"))


@query("select o_orderkey, cast(cast(o_orderdate as date) as varchar) as iso, cast(cast(o_orderdate as date) as varchar) as worded, cast(cast(o_orderdate as date) as varchar) as epoch, cast(cast(o_orderdate as date) as varchar) as parsed from orders")
def iso_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate"))
    return o.select(
        "o_orderkey", T.iso_date(F.concat(F.lit("on "), F.date_format("at", "yyyy-MM-dd"), F.lit("T10:00"))).alias("iso"), T.iso_date(F.date_format("at", "d MMMM yyyy")).alias("worded"), T.iso_date(F.unix_timestamp("at").cast("string")).alias("epoch"), T.parse_date(F.date_format("at", "d MMM yyyy")).alias("parsed")
    )


@query("select p_partkey, case when p_size % 4 = 0 then null else lpad(cast(p_partkey as varchar), case p_size % 4 when 1 then 8 when 2 then 12 else 13 end, '7') end as digits, case when p_size % 4 = 1 then lpad(cast(p_partkey as varchar), 8, '7') end as first_of from part")
def gtin_valid(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = F.col("p_size") % 4
    raw = F.when(s == 0, F.concat(F.lit("E06C"), F.lit("4B2E"))).otherwise(F.concat(F.lit("no. "), F.lpad(F.col("p_partkey").cast("string"), F.when(s == 1, 8).when(s == 2, 12).otherwise(13), F.lit("7"))))
    listed = F.array(F.lit("ab"), F.lit("123"), F.when(s == 1, F.lpad(F.col("p_partkey").cast("string"), 8, "7")).otherwise("12"))
    return p.select("p_partkey", T.valid_gtin(raw).alias("digits"), T.first_valid_gtin(listed).alias("first_of"))


# --- pages ---------------------------------------------------------------------
@query("select page_id, split_part(url, '?', 1) as page, nullif(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', ''), '') as host from pages")
def url_normalise(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.strip_query(F.col("url")).alias("page"), T.bare_host(F.col("url")).alias("host"))


@query(f"select page_id, md5({sqltext.strip_html('html')}) as text_md5 from pages")
def strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(T.strip_html(F.col("html"))).alias("text_md5"))


@query("""with a as (select page_id, regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1) as l from pages), e as (select page_id, unnest(l) as href, unnest(range(0, len(l))) as position from a)
  select page_id, href, cast(min(position) as integer) as position from e where starts_with(href, '/') group by 1, 2""")
def anchors(spark, sf_dir):
    return readers.extract_anchors(table(spark, sf_dir, "pages"), "page_id", "html", "/")


@query("""with u as (select concat('<urlset>', string_agg(concat('<url><loc> ', split_part(url, '?', 1), '/product/', page_id % 97, '/x </loc></url>'), chr(10) order by page_id), '</urlset>') as value from pages),
  l as (select regexp_extract_all(value, '(?s)<loc>\\s*(.*?)\\s*</loc>', 1) as l from u), e as (select unnest(l) as url, unnest(range(0, len(l))) as position from l), c as (select *, nullif(regexp_extract(url, '/product/(\\d+)/', 1), '') as code from e)
  select code, min_by(url, position) as url, cast(min(position) as integer) as position from c where code is not null group by 1""")
def sitemap_codes(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    loc = F.concat(F.lit("<url><loc> "), T.strip_query(F.col("url")), F.lit("/product/"), (F.col("page_id") % 97).cast("string"), F.lit("/x </loc></url>"))
    # One document holds the whole sitemap, as at a source; only its addresses are gathered.
    xml = p.agg(F.concat(F.lit("<urlset>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", loc.alias("x")))), lambda r: r["x"]), "\n"), F.lit("</urlset>")).alias("value"))
    return readers.sitemap_codes(xml)


@query(f"""with r as (select page_id, {sqltext.strip_html("nullif(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '')")} as name, list_filter(list_transform(regexp_extract_all(html, '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1), lambda x: {sqltext.strip_html("x")}), lambda p: length(p) > 80) as ps from pages),
  t as (select page_id, name, array_to_string(ps, chr(10) || chr(10)) as text from r) select page_id, md5(name) as name_md5, case when length(text) > 150 then md5(text) end as text_md5 from t""")
def article_reader(spark, sf_dir):
    a = table(spark, sf_dir, "pages").select("page_id", readers.read_article(F.col("html")).alias("a"))
    return a.select("page_id", F.md5("a.name").alias("name_md5"), F.md5("a.text").alias("text_md5"))


# --- reviews -------------------------------------------------------------------
@query(r"select ord, text_length from (select ord, length(text) as text_length, row_number() over (partition by source, lower(coalesce(author, '')), regexp_replace(lower(substr(text, 1, 180)), '\s+', ' ', 'g') order by length(text) desc, ord) as rn from v_review) where rn = 1")
def review_dedupe(spark, sf_dir):
    return dedupe.dedupe_reviews(view(spark, sf_dir, "review"), ["ord"]).select("ord", F.length("text").cast("long").alias("text_length"))


@query("select ord from v_review where length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) >= 15")
def review_min_text(spark, sf_dir):
    return view(spark, sf_dir, "review").where(F.length(T.stripped(F.col("text"))) >= 15).select("ord")


@query("select ord from (select ord, row_number() over (partition by substr(sha1(concat(source, '||', coalesce(author, ''), '|', substr(coalesce(text, ''), 1, 200))), 1, 16) order by ord) as rn from v_review) where rn = 1")
def review_dedupe_ingest(spark, sf_dir):
    v = view(spark, sf_dir, "review").withColumn("review_key", T.review_key(F.col("source"), F.lit(""), F.col("author"), F.col("text")))
    return dedupe.dedupe_reviews_ingest(v, ["ord"]).select("ord")


@query("select ord from (select ord, row_number() over (partition by substr(text, 1, 120), coalesce(author, '') order by ord) as rn from v_review where length(text) >= 15) where rn = 1")
def payload_dedupe(spark, sf_dir):
    return dedupe.dedupe_payload_reviews(view(spark, sf_dir, "review"), ["ord"]).select("ord")


@query("select product_key, retailer, o1, o2, o3 from (select *, row_number() over (partition by product_key, retailer order by price_aud is null, " + _ORD + ") as rn from v_offer) where rn = 1")
def tile_accumulation(spark, sf_dir):
    v = view(spark, sf_dir, "offer").select("*", F.col("product_key").alias("source_url"), F.col("retailer").alias("name_raw"), F.col("price_aud").alias("price_raw"))
    return dedupe.accumulate_tiles(v, OFFER_ORDER).select("product_key", "retailer", "o1", "o2", "o3")


@query("select ord, coalesce(sort_order <> 'Newest', false) as biased from v_review")
def bias_flag(spark, sf_dir):
    return view(spark, sf_dir, "review").select("ord", T.is_biased(F.col("sort_order")).alias("biased"))


@query("with ranked as (select *, count(*) over (partition by source) as n, row_number() over (partition by source order by ord desc) as rn from v_review) select source, ord from ranked where rn <= case when n >= 200 then 50 when n > 20 then 20 else n end")
def sample_newest(spark, sf_dir):
    return sampling.sample_newest(view(spark, sf_dir, "review"), "source", [F.desc("ord")]).select("source", "ord")


# --- resolution ----------------------------------------------------------------
_GTIN = """first_holder as (select gtin, product_key as canonical_key from (select *, row_number() over (partition by gtin order by ord) as rn from products where gtin is not null) where rn = 1),
gtin_alias as (select distinct p.product_key, canonical_key from products p join first_holder using (gtin) where p.product_key <> canonical_key)"""
_VOLUME = """known as (select bare_slug from products group by 1 having count(distinct volume_ml) = 1),
primary_of as (select bare_slug, product_key as canonical_key from (select *, row_number() over (partition by bare_slug order by ord) as rn from products join known using (bare_slug) where volume_ml is not null) where rn = 1),
volume_alias as (select distinct p.product_key, canonical_key from products p join primary_of using (bare_slug) where volume_ml is null and p.product_key <> canonical_key)"""


def _first_gtin_alias(products: DataFrame) -> DataFrame:
    return resolve.merge_gtin(products, ["ord"])


@query(f"with {_PRODUCTS}, {_GTIN} select * from gtin_alias")
def gtin_merge(spark, sf_dir):
    return _first_gtin_alias(_products(spark, sf_dir))


@query(f"with {_PRODUCTS}, {_VOLUME} select * from volume_alias")
def volume_merge(spark, sf_dir):
    return resolve.merge_missing_volume(_products(spark, sf_dir), "bare_slug", ["ord"])


# A walk from each key along the steps, nine at most, where the operator goes on to the end (REPLY_r03.md, F1); the second step's are those among the products
# that the first leaves.
@query(
    f"""with recursive {_PRODUCTS}, {_GTIN}, one as (select product_key, min(canonical_key) as canonical_key from gtin_alias group by 1),
left_over as (select * from products where product_key not in (select product_key from one)),
{_VOLUME.replace("from products", "from left_over").replace("products p", "left_over p").replace("products join", "left_over join")},
steps as (select * from one union all select product_key, min(canonical_key) from volume_alias group by 1),
walk(product_key, canonical_key, n) as (select product_key, canonical_key, 1 from steps union all select w.product_key, s.canonical_key, n + 1 from walk w join steps s on s.product_key = w.canonical_key where n < 9)
select product_key, max_by(canonical_key, n) as canonical_key from walk group by 1"""
)
def alias_closure(spark, sf_dir):
    return resolve.merge_products(_products(spark, sf_dir), "bare_slug", ["ord"])


@query("with a as (select distinct cast(l_partkey as varchar) as product_key, cast(l_partkey - l_partkey % 3 as varchar) as canonical_key from lineitem where l_partkey % 3 = 1) select coalesce(canonical_key, v.product_key) as product_key, count(*) as offers from v_offer v left join a on v.product_key = a.product_key group by 1")
def alias_offers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_partkey % 3 = 1").select(F.col("l_partkey").cast("string").alias("product_key"), (F.col("l_partkey") - F.col("l_partkey") % 3).cast("string").alias("canonical_key")).distinct()
    return resolve.apply_alias(view(spark, sf_dir, "offer"), li).groupBy("product_key").agg(F.count("*").alias("offers"))


def _review_names(spark, sf_dir) -> DataFrame:
    """Every listing as a review of it, its name written another way."""
    v = view(spark, sf_dir, "listing")
    name = F.concat(F.col("brand"), F.lit(" "), F.when(F.col("ord") % 2 == 0, F.col("name_raw")).otherwise(F.concat(F.regexp_replace("name_raw", "e", "ee"), F.lit(" tasting"))))
    return v.select(F.concat(F.lit("r"), F.col("ord").cast("string")).alias("review_key"), T.review_slug(name, YEAR).alias("slug"), T.parse_vintage(name, YEAR).alias("vintage"), F.when(F.col("ord") % 11 == 0, "retailer").alias("subject_type"))


_REVIEWS = f"""
rnamed as (select concat('r', ord) as review_key, case when ord % 11 = 0 then 'retailer' end as subject_type, name_raw from (select ord, concat(brand, ' ', case when ord % 2 = 0 then name_raw else concat(regexp_replace(name_raw, 'e', 'ee', 'g'), ' tasting') end) as name_raw from v_listing)),
rparsed as (select *, cast(null as varchar) as brand, {_VOLUME_SQL} as volume_ml, {_YEAR_SQL} as vintage from rnamed),
{sqltext.keyed("rparsed", "rkeyed", of="name_raw")},
reviews as (select review_key, subject_type, vintage, slug from rkeyed),
one_product as (select * from (select *, row_number() over (partition by product_key order by ord) as rn from products) where rn = 1)"""


def _unique_products(spark, sf_dir) -> DataFrame:
    return dedupe.keep_best(_products(spark, sf_dir), ["product_key"], ["ord"])


@query(f"with {_PRODUCTS}, {_REVIEWS} select review_key, product_key as linked_key, 1.0::double as match_score from reviews join (select slug, product_key from (select *, row_number() over (partition by slug order by ord) as rs from one_product where slug <> '') where rs = 1) using (slug)")
def exact_link(spark, sf_dir):
    return resolve.exact_link(_review_names(spark, sf_dir), _unique_products(spark, sf_dir), ["ord"]).select("review_key", "linked_key", "match_score")


_POSTINGS = """tokened as (select product_key, unnest(list_distinct(list_filter(string_split(slug, ' '), lambda t: length(t) > 2))) as token from one_product),
postings as (select token, product_key from tokened where token in (select token from tokened group by 1 having count(*) <= (select greatest(20, floor(count(*) / 20)) from one_product)))"""


@query(f"with {_PRODUCTS}, {_REVIEWS}, {_POSTINGS} select * from postings")
def token_postings(spark, sf_dir):
    return similarity.token_postings(_unique_products(spark, sf_dir))


_CANDIDATES = """rtoken as (select review_key, unnest(list_distinct(list_filter(string_split(slug, ' '), lambda t: length(t) > 2))) as token from reviews),
shared as (select review_key, product_key, count(*) as overlap from rtoken join postings using (token) group by 1, 2),
candidates as (select review_key, product_key, overlap from (select *, row_number() over (partition by review_key order by overlap desc, product_key) as rn from shared) where rn <= 40)"""


@query(f"with {_PRODUCTS}, {_REVIEWS}, {_POSTINGS}, {_CANDIDATES} select * from candidates")
def candidate_topk(spark, sf_dir):
    return similarity.candidates(_review_names(spark, sf_dir), similarity.token_postings(_unique_products(spark, sf_dir)))


@query(f"""with {_PRODUCTS}, {_REVIEWS}, {_POSTINGS}, {_CANDIDATES}, scored as (select c.review_key, c.product_key, overlap, 1 - levenshtein(r.slug, p.slug) / greatest(length(r.slug), length(p.slug)) as raw_score from candidates c join reviews r using (review_key) join one_product p on c.product_key = p.product_key),
  best as (select *, floor(raw_score * 10000 + 0.5) / 10000 as match_score, row_number() over (partition by review_key order by raw_score desc, overlap desc, product_key) as rn from scored) select review_key, product_key, overlap, match_score from best where rn = 1 and match_score >= 0.86""")
def fuzzy_link_levenshtein(spark, sf_dir):
    return similarity.fuzzy_link(_review_names(spark, sf_dir), _unique_products(spark, sf_dir), scorer="levenshtein")


def _ratio_sql(name: str, pairs: str) -> str:
    """Common table expressions that end in name(slug, cand, ratio): of different pairs the similarity by longest blocks. The longest string of a that b holds, first in a and
    then in b, is a block; what stands before it in both, and after it, is compared alike."""
    longest = "list_max(list_transform(range(1, length(a) + 1), lambda i: {'l': list_max(list_filter(range(0, length(a) - i + 2), lambda l: contains(b, substr(a, i, l)))), 'i': -i}))"
    return f"""{name}_seg(slug, cand, a, b, n) as (select slug, cand, slug, cand, 0::bigint from {pairs}
  union all select slug, cand, p.a, p.b, p.n from (
    select slug, cand, unnest([{{'a': substr(a, 1, here - 1), 'b': substr(b, 1, there - 1), 'n': long}}, {{'a': substr(a, here + long), 'b': substr(b, there + long), 'n': 0::bigint}}]) as p
    from (select slug, cand, a, b, m.l as long, -m.i as here, strpos(b, substr(a, -m.i, m.l)) as there from (select slug, cand, a, b, {longest} as m from {name}_seg where a <> '' and b <> '')) where long > 0)),
{name} as (select slug, cand, case when length(slug) + length(cand) = 0 then 1.0 else 2.0 * sum(n) / (length(slug) + length(cand)) end as ratio from {name}_seg group by slug, cand)"""


# What letters alone allow two names: pairs that cannot reach a score need not be compared.
_ALLOWED = """2.0 * list_sum(list_transform(list_distinct(string_split(r.slug, '')), lambda c: least(length(r.slug) - length(replace(r.slug, c, '')), length(p.slug) - length(replace(p.slug, c, ''))))) / (length(r.slug) + length(p.slug))"""
_NAMED = f"""named_pairs as (select c.review_key, c.product_key, c.overlap, r.slug, p.slug as cand, {_ALLOWED} as allowed from candidates c join reviews r using (review_key) join one_product p on c.product_key = p.product_key)"""


@query(f"""with recursive {_PRODUCTS}, {_REVIEWS}, {_POSTINGS}, {_CANDIDATES}, {_NAMED}, promising as (select distinct slug, cand from named_pairs where allowed >= 0.8599),
  {_ratio_sql("scored", "promising")},
  best as (select review_key, product_key, overlap, floor(ratio * 10000 + 0.5) / 10000 as match_score, row_number() over (partition by review_key order by ratio desc, overlap desc, product_key) as rn from named_pairs join scored using (slug, cand))
  select review_key, product_key, overlap, match_score from best where rn = 1 and match_score >= 0.86""")
def fuzzy_link_ratio(spark, sf_dir):
    return similarity.fuzzy_link(_review_names(spark, sf_dir), _unique_products(spark, sf_dir))


# The pair whose letters allow most is compared first; others only if theirs allow as much as it has.
@query(f"""with recursive {_PRODUCTS}, {_REVIEWS}, {_POSTINGS}, {_CANDIDATES}, {_NAMED},
  mine as (select * from reviews where coalesce(subject_type, 'product') <> 'retailer'),
  exact as (select review_key, product_key from mine join (select slug, min_by(product_key, ord) as product_key from one_product where slug <> '' group by slug) using (slug)),
  open_pairs as (select * from named_pairs where review_key in (select review_key from mine) and review_key not in (select review_key from exact)),
  likeliest as (select distinct slug, max_by(cand, (allowed, cand)) over (partition by slug) as cand from open_pairs),
  {_ratio_sql("likely", "likeliest")},
  rest as (select distinct o.slug, o.cand from open_pairs o join likely l on o.slug = l.slug where o.allowed >= l.ratio),
  {_ratio_sql("scored", "rest")},
  best as (select * from (select review_key, product_key, floor(ratio * 10000 + 0.5) / 10000 as match_score, row_number() over (partition by review_key order by ratio desc, overlap desc, product_key) as rn from open_pairs join scored using (slug, cand)) where rn = 1)
  select review_key, product_key, 1.0::double as match_score, null as match_reason from exact
  union all select m.review_key, b.product_key, b.match_score, case when b.product_key is null then 'no candidate' when m.vintage <> p.vintage then 'vintage conflict' when b.match_score < 0.86 then 'below threshold' end
  from mine m left join best b using (review_key) left join one_product p on p.product_key = b.product_key where m.review_key not in (select review_key from exact)""")
def link_reviews(spark, sf_dir):
    """Linked and queued reviews with score and reason."""
    linked, queue = resolve.link(_review_names(spark, sf_dir), _unique_products(spark, sf_dir), ["ord"])
    return linked.select("review_key", "product_key", "match_score", F.lit(None).cast("string").alias("match_reason")).unionByName(queue.select("review_key", F.col("match_candidate").alias("product_key"), "match_score", "match_reason"))


@query(f"with {_PRODUCTS}, {_REVIEWS}, r as (select * from reviews where coalesce(subject_type, 'product') <> 'retailer'), hit as (select count(*) as linked from r where slug in (select slug from one_product where slug <> '')), al as (select count(*) as n from r) select linked, n - linked as queued, linked * 100 // nullif(n, 0) as rate_pct from hit, al")
def link_rate(spark, sf_dir):
    mine = _review_names(spark, sf_dir).where("coalesce(subject_type, 'product') <> 'retailer'")
    linked = resolve.exact_link(mine, _unique_products(spark, sf_dir), ["ord"])
    return resolve.link_rate(linked, mine.join(linked.select("review_key"), "review_key", "left_anti"))


# --- catalogue -----------------------------------------------------------------
_AGG = """agg as (select product_key, min(price_aud) as min_price_aud, max(price_aud) as max_price_aud, array_to_string(list_sort(list_distinct(list(pack_size))), ',') as pack_sizes, count(distinct pack_size) > 1 as pack_size_mismatch, count(distinct retailer) as retailer_count, count(*) as offer_count from v_offer group by 1)"""


@query(f"with {_AGG} select * from agg")
def catalogue_aggregates(spark, sf_dir):
    return catalogue.offer_aggregates(view(spark, sf_dir, "offer")).withColumn("pack_sizes", F.array_join(F.transform("pack_sizes", lambda x: x.cast("string")), ","))


@query("select source as product_key, count(*) as review_count, floor(avg(case when rating_raw is not null and rating_scale is not null then floor(greatest(0.0, least(1.0, rating_raw / rating_scale)) * 10000 + 0.5) / 10000 end) * 10000 + 0.5) / 10000 as mean_rating_norm, bool_or(coalesce(sort_order <> 'Newest', false)) as reviews_biased_sample from v_review group by 1")
def review_aggregates(spark, sf_dir):
    v = view(spark, sf_dir, "review")
    return catalogue.review_aggregates(v.select(F.col("source").alias("product_key"), T.norm_rating(F.col("rating_raw"), F.col("rating_scale")).alias("rating_norm"), "sort_order"))


def _catalogue(spark, sf_dir) -> DataFrame:
    offers = view(spark, sf_dir, "offer").select("product_key", "retailer", "pack_size", "price_aud", F.col("o1").alias("ord"))
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("product_key"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))
    v = view(spark, sf_dir, "review")
    reviews = v.select((F.col("ord") % 500).cast("string").alias("product_key"), F.coalesce(F.length("text"), F.lit(0)).alias("length"), T.norm_rating(F.col("rating_raw"), F.col("rating_scale")).alias("rating_norm"), "sort_order")
    return catalogue.build_catalogue(products, offers, reviews, offer_order=["ord", "retailer"])


@query("""with c as (select cast(p_partkey as varchar) as product_key from part),
  o as (select product_key, count(*) as offer_count, count(distinct retailer) as retailer_count, string_agg(concat(o1, '/', retailer, '/', pack_size, '/', coalesce(cast(floor(price_aud * 100 + 0.5) as bigint), -1)), ',' order by o1, retailer, pack_size, price_aud nulls first) as listed from v_offer group by 1),
  r as (select cast(ord % 500 as varchar) as product_key, count(*) as review_count, string_agg(cast(coalesce(length(text), 0) as varchar), ',' order by coalesce(length(text), 0)) as lengths from v_review group by 1)
  select product_key, coalesce(offer_count, 0) as offers, coalesce(review_count, 0) as reviews, coalesce(retailer_count, 0) as retailers, md5(coalesce(listed, '')) as offers_md5, md5(coalesce(lengths, '')) as reviews_md5 from c left join o using (product_key) left join r using (product_key)""")
def catalogue_nested(spark, sf_dir):
    offer = lambda o: F.concat_ws("/", o["ord"].cast("string"), o["retailer"], o["pack_size"].cast("string"), F.coalesce(F.floor(o["price_aud"] * 100 + 0.5).cast("string"), F.lit("-1")))
    listed, lengths = F.array_join(F.transform("offers", offer), ","), F.array_join(F.transform("reviews", lambda r: r["length"].cast("string")), ",")
    return _catalogue(spark, sf_dir).select("product_key", F.size("offers").cast("long").alias("offers"), F.size("reviews").cast("long").alias("reviews"), F.col("retailer_count").alias("retailers"), F.md5(listed).alias("offers_md5"), F.md5(lengths).alias("reviews_md5"))


@query("with " + _SAME_PACK + "," + _UNIT + """, best as (select * from same_pack union all select * from unit_price where product_key not in (select product_key from same_pack)),
  o as (select product_key, min(price_aud) as lo, count(distinct retailer) as n from v_offer group by 1), r as (select cast(ord % 500 as varchar) as product_key, count(*) as n, bool_or(coalesce(sort_order <> 'Newest', false)) as biased from v_review group by 1)
  select count(*) as products, count_if(o.lo is not null)::bigint as with_price, count_if(o.n > 1)::bigint as multi_retailer, count_if(compare_basis is not null and not compare_suspect)::bigint as trusted, count_if(compare_suspect)::bigint as suspect, count_if(r.biased)::bigint as biased, coalesce(sum(r.n), 0)::bigint as reviews
  from (select cast(p_partkey as varchar) as product_key from part) c left join o using (product_key) left join best using (product_key) left join r using (product_key)""")
def catalogue_report(spark, sf_dir):
    return catalogue.report(_catalogue(spark, sf_dir))


@query("with " + _SAME_PACK + " select median(compare_spread_pct) as median_gap_pct from same_pack where not compare_suspect")
def median_gap(spark, sf_dir):
    return catalogue.median_gap(compare.compare_same_pack(view(spark, sf_dir, "offer")))


@query("""with s as (select cast(o_custkey as varchar) as page, max_by(floor(o_totalprice), o_orderkey) as total_reviews from orders group by 1), o as (select product_key, cast(o1 % 3000 as varchar) as page, o1, o2, o3, o4 from v_offer)
  select product_key, min_by(total_reviews, (o1, o2, o3, o4))::bigint as site_review_count from o join s using (page) group by 1""")
def summary_first_match(spark, sf_dir):
    offers = view(spark, sf_dir, "offer").select("product_key", F.concat((F.col("o1") % 3000).cast("string"), F.lit("?x=1")).alias("url"), "o1", "o2", "o3", "o4")
    summaries = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("source_url"), F.lit(None).cast("double").alias("average_rating_norm"), F.floor("o_totalprice").alias("total_reviews"), F.col("o_orderkey").alias("ord"))
    return catalogue.first_summary(offers, summaries, ["o1", "o2", "o3", "o4"], "ord").select("product_key", "site_review_count")


@query("select l_partkey, string_agg(concat(star, '=', n), ';' order by star) as histogram, sum(n)::bigint as total from (select l_partkey, cast(l_linenumber as varchar) as star, count(*) as n from lineitem group by 1, 2) group by 1")
def rating_histogram(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_partkey", F.col("l_linenumber").cast("string").alias("star")).agg(F.count("*").alias("n"))
    maps = n.groupBy("l_partkey").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("star", "n")))).alias("distribution"))
    return maps.select("l_partkey", F.array_join(F.transform(F.array_sort(F.map_entries("distribution")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";").alias("histogram"), catalogue.histogram_total().alias("total"))


# --- queues and state -----------------------------------------------------------
_QUEUE = """counted as (select product_key, retailer, concat('https://', retailer, '.example/product/', cast(o1 % 2000 as varchar)) as url, cast(o5 as integer) * 10 as n, """ + _ORD + """ from v_offer),
eligible as (select * from counted where (n >= 100 or retailer in ('s3')) and retailer in ('s1', 's2', 's3')),
queue as (select url, product_key, retailer, n as expected_reviews, case when n >= 200 then 50 when n > 20 then 20 else n end as max_reviews from (select *, row_number() over (partition by url order by n desc, product_key, """ + _ORD + """) as rn from eligible) where rn = 1)"""


def _queue(spark, sf_dir, **more) -> DataFrame:
    v = view(spark, sf_dir, "offer")
    rows = v.select("product_key", F.lit(None).cast("string").alias("name"), "retailer", F.concat(F.lit("https://"), "retailer", F.lit(".example/product/"), (F.col("o1") % 2000).cast("string"), F.lit("?isFromSearch=1")).alias("url"), (F.col("o5").cast("int") * 10).alias("aggregate_review_count"), *OFFER_ORDER)
    return sampling.rank_queue(rows, min_reviews=100, supported=("s1", "s2", "s3"), countless=("s3",), order=["product_key", *OFFER_ORDER], **more)


@query(f"with {_QUEUE} select * from queue")
def review_queue_rank(spark, sf_dir):
    return _queue(spark, sf_dir).drop("name")


@query(f"with {_QUEUE} select * from queue order by expected_reviews desc, url limit 25")
def review_queue_top(spark, sf_dir):
    return _queue(spark, sf_dir, limit=25).drop("name")


@query(f"with {_QUEUE}, p as (select *, least(expected_reviews, coalesce(nullif(max_reviews, 0), expected_reviews)) as take from queue) select count(*) as targets, sum(expected_reviews)::bigint as advertised, sum(take)::bigint as planned, sum(ceil(take / 4))::bigint as pages, floor((sum(ceil(take / 4)) * 2.0 + count(*) * 11.0) / 3600 * 100 + 0.5) / 100 as hours from p")
def queue_plan(spark, sf_dir):
    return sampling.queue_plan(_queue(spark, sf_dir))


@query("with c as (select *, nullif(regexp_extract(url, '/product/(\\d+)$', 1), '') as code from (select 'offer' as kind, concat('/product/', o1 % 1000) as url, cast(o5 as integer) - 1 as n, cast(null as varchar) as name, o1 as ord from v_offer union all select 'product', concat('/product/', ord), null, name_raw, ord from v_listing)), n as (select code, max(n) as expected_reviews from c where kind = 'offer' and code is not null group by 1 having max(n) > 0), m as (select code, min_by(name, ord) as name from c where kind = 'product' and code is not null group by 1) select code, expected_reviews, name from n left join m using (code)")
def scan_targets(spark, sf_dir):
    offers = view(spark, sf_dir, "offer").select(F.lit("offer").alias("record_type"), F.concat(F.lit("/product/"), (F.col("o1") % 1000).cast("string")).alias("url"), (F.col("o5").cast("int") - 1).alias("aggregate_review_count"), F.lit(None).cast("string").alias("name"), F.col("o1").alias("ord"))
    products = view(spark, sf_dir, "listing").select(F.lit("product").alias("record_type"), F.concat(F.lit("/product/"), F.col("ord").cast("string")).alias("url"), F.lit(None).cast("int").alias("aggregate_review_count"), F.col("name_raw").alias("name"), "ord")
    return sampling.scan_targets(offers.unionByName(products), r"/product/(\d+)$")


@query("select p_partkey from part where cast(p_partkey as varchar) not in (select product_key from v_offer where retailer = 's1' and price_aud > 1200)")
def enrich_only_missing(spark, sf_dir):
    products = table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("product_key"))
    return sampling.missing_only(products, view(spark, sf_dir, "offer").where("retailer = 's1' and price_aud > 1200")).select("p_partkey")


@query("select cast(p_partkey as varchar) as product_key, o1, o2, o3, floor(price_aud * 100 + 0.5) / 100 as price_aud, 6 as pack_size, floor(price_aud / 6 * 100 + 0.5) / 100 as unit_price_aud from v_offer join part on cast(o3 as varchar) = cast(p_partkey as varchar) where price_aud is not null")
def enrich_lookup(spark, sf_dir):
    rows = view(spark, sf_dir, "offer").select(F.col("o3").cast("string").alias("stockcode"), F.concat_ws("|", F.col("o1").cast("string"), F.col("o2").cast("string"), F.col("o3").cast("string")).alias("url"), F.format_string("%.2f", "price_aud").alias("price"), F.lit(None).cast("string").alias("member_price"), F.lit("pack (6)").alias("unit"), F.lit(None).cast("double").alias("rating"), F.lit(0).alias("reviews"), F.lit(True).alias("in_stock"), "price_aud").where("price_aud is not null")
    index = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("stockcode"), F.col("p_partkey").cast("string").alias("product_key"))
    got = sampling.enrich_offers(rows, index, "any")
    part = F.split("url", r"\|")
    return got.select("product_key", part[0].cast("long").alias("o1"), part[1].cast("int").alias("o2"), part[2].cast("long").alias("o3"), "price_aud", "pack_size", "unit_price_aud")


@query("select distinct target from v_attempt t where target not in (select target from v_attempt where kind = 'done' and value > 60) and target in (select target from v_attempt where kind in ('handout', 'partial'))")
def stalled_targets(spark, sf_dir):
    v = view(spark, sf_dir, "attempt")
    return state.stalled(v.select("target").distinct(), v.where("kind = 'done' and value > 60"), v.where("kind in ('handout', 'partial')"))


@query("select distinct target from v_attempt where target not in (select target from v_attempt where kind = 'done' and value > 60)")
def resume_antijoin(spark, sf_dir):
    v = view(spark, sf_dir, "attempt")
    return state.resume(v.select("target").distinct(), v.where("kind = 'done' and value > 60"))


_AS_OF = "2024-01-20 00:00:00"
_LEASE = f"""live as (select *, case when kind = 'done' and value <= 60 then 'partial' else kind end as k from v_attempt where ts <= timestamp '{_AS_OF}'),
folded as (select target, count_if(k = 'handout')::bigint as attempts, max(ts) filter (k = 'handout') as handed, max(ts) filter (k = 'partial') as delivered, max(ts) filter (k = 'done') as finished, max(ts) filter (k = 'fail') as failed, coalesce(sum(n) filter (k in ('partial', 'done')), 0)::bigint as harvested from live group by 1),
leased as (select *, case when delivered >= handed then delivered else handed end as alive from folded),
state as (select target, attempts, harvested, finished is not null as done, coalesce(alive > timestamp '{_AS_OF}' - interval 86400 seconds and not coalesce(failed >= alive, false) and finished is null, false) as in_flight from leased),
leases as (select *, not done and not in_flight and attempts < 5 as eligible from state)"""


def _leases(spark, sf_dir) -> DataFrame:
    v = view(spark, sf_dir, "attempt").withColumn("kind", F.when((F.col("kind") == "done") & (F.col("value") <= 60), "partial").otherwise(F.col("kind")))
    return state.lease_state(v, _AS_OF, timeout_s=86400)


@query(f"with {_LEASE} select * from leases")
def lease_state(spark, sf_dir):
    return _leases(spark, sf_dir)


@query(f"with {_LEASE} select target, case when done then attempts else 0 end as attempts, done and in_flight as in_flight, not done as eligible from leases")
def requeue(spark, sf_dir):
    return state.requeue(_leases(spark, sf_dir)).select("target", "attempts", "in_flight", "eligible")


@query(f"with {_LEASE} select concat('t', c_custkey) as target, c_custkey as position from customer left join leases on target = concat('t', c_custkey) where coalesce(eligible, true) order by c_custkey limit 1")
def next_target(spark, sf_dir):
    queue = table(spark, sf_dir, "customer").select(F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("target"), F.col("c_custkey").alias("position"))
    return state.next_target(_leases(spark, sf_dir), queue)


@query(f"with {_LEASE} select count(*) as total, count_if(done)::bigint as done, greatest(0, count(*) - count_if(done))::bigint as remaining, coalesce(sum(harvested), 0)::bigint as harvested from leases")
def progress_totals(spark, sf_dir):
    return state.progress(_leases(spark, sf_dir))


_SNAPS = "snaps as (select user_id, event_id, cast(floor(value / 50) as bigint) as n from events)"


@query(f"with {_SNAPS}, g as (select *, n - lag(n) over (partition by user_id order by event_id) as gained from snaps), r as (select *, count_if(coalesce(gained <> 0, true)) over (partition by user_id order by event_id) as run from g) select user_id, event_id, n, gained, case when coalesce(gained = 0, false) then (row_number() over (partition by user_id, run order by event_id) - 1)::integer else 0 end as stalls from r")
def stall_runs(spark, sf_dir):
    snaps = table(spark, sf_dir, "events").select("user_id", "event_id", F.floor(F.col("value") / 50).alias("n"))
    return state.stall_runs(snaps, "event_id", "n", ["user_id"])


@query("with s as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hours then 0 else 1 end as new from events), g as (select user_id, ts, sum(new) over (partition by user_id order by ts) as k from s) select user_id, min(ts) as start, max(ts) + interval 6 hours as \"end\", count(*) as events from g group by user_id, k")
def idle_sessions(spark, sf_dir):
    return state.idle_sessions(table(spark, sf_dir, "events"), "user_id", "ts", "6 hours")


@query("select target, seq, cast(floor((row_number() over (partition by target order by seq) - 1) / 40) as bigint) as batch from v_attempt")
def batch_ids(spark, sf_dir):
    return sampling.batch_ids(view(spark, sf_dir, "attempt"), 40, ["seq"], ["target"]).select("target", "seq", "batch")


@query("select conv_id, count(*) as turns, min_by(role, turn) as first_role, max_by(role, turn) as last_role, string_agg(role, ',' order by turn) as roles from conversations group by 1")
def nest_turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return c.groupBy("conv_id").agg(F.count("*").alias("turns"), F.min_by("role", "turn").alias("first_role"), F.max_by("role", "turn").alias("last_role"), F.array_join(F.transform(turns, lambda t: t["role"]), ",").alias("roles"))


# --- unions and the rest ------------------------------------------------------------
@query("with l as (select n_nationkey as ord, case when n_nationkey % 5 = 0 then '# off' when n_nationkey % 2 = 0 then concat('https://shop.example/', lower(n_name), '?x=1 | pages=', n_nationkey % 4) else concat('https://shop.example/', lower(n_name), '?y=2') end as value from nation), k as (select ord, split_part(trim(split_part(value, '|', 1)), '?', 1) as base, coalesce(try_cast(nullif(regexp_extract(value, 'pages=(\\d+)', 1), '') as integer), 0) as pages from l where value not like '#%'), e as (select ord, base, pages, unnest(range(1, greatest(pages, 1) + 1)) as page from k) select case when page = 1 then base else concat(base, '?page=', page) end as url, cast(case when min(pages) > 0 then 0 else 60 end as integer) as clicks from e group by 1")
def seed_expand(spark, sf_dir):
    k = F.col("n_nationkey")
    page = F.concat(F.lit("https://shop.example/"), F.lower("n_name"))
    value = F.when(k % 5 == 0, "# off").when(k % 2 == 0, F.concat(page, F.lit("?x=1 | pages="), (k % 4).cast("string"))).otherwise(F.concat(page, F.lit("?y=2")))
    return readers.expand_seeds(table(spark, sf_dir, "nation").select(value.alias("value"), k.alias("ord"))).select("url", "clicks")


def _lanes(spark, sf_dir) -> DataFrame:
    a = table(spark, sf_dir, "region").select(F.lit("region").alias("record_type"), F.col("r_regionkey").cast("long").alias("key"), F.col("r_name").alias("name"))
    b = table(spark, sf_dir, "nation").select(F.lit("nation").alias("record_type"), F.col("n_nationkey").cast("long").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("parent"))
    c = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("record_type"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


_LANES = "lanes as (select 'region' as record_type, r_regionkey::bigint as key, r_name as name, null::bigint as parent, null::double as balance from region union all select 'nation', n_nationkey, n_name, n_regionkey, null from nation union all select 'supplier', s_suppkey, null, null, s_acctbal from supplier)"


@query(f"with {_LANES} select * from lanes")
def lane_union(spark, sf_dir):
    return _lanes(spark, sf_dir)


@query(f"with {_LANES} select record_type, count(*) as n from lanes group by 1")
def record_counts(spark, sf_dir):
    return _lanes(spark, sf_dir).groupBy("record_type").agg(F.count("*").alias("n"))


@query(f"with {_LANES} select key, name from lanes where record_type = 'nation'")
def route_kind(spark, sf_dir):
    return _lanes(spark, sf_dir).where(F.col("record_type") == "nation").select("key", "name")


@query("select max_by(s_suppkey, (n, -s_suppkey)) as store, max(n) as items from (select l_suppkey as s_suppkey, count(*) as n from lineitem group by 1)")
def store_argmax(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s")).agg(F.count("*").alias("n"))
    return n.agg(F.max_by("s", F.struct("n", -F.col("s"))).alias("store"), F.max("n").alias("items"))


@query("select count(*) as missing from (select distinct p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 45))")
def set_difference(spark, sf_dir):
    asked = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"))
    return state.returned_difference(asked, table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("code")), "code")


@query("select p_partkey, case when s > 0 and (p is null or s < p) then s else p end as price, coalesce(s > 0 and (p is null or s < p), false) as special from (select p_partkey, case when p_size % 7 = 0 then null else floor(floor(p_retailprice * 100) / 100.0 * 100 + 0.5) / 100 end as p, case when p_size % 2 = 0 then floor((floor(p_retailprice * 100) - p_size * 10 + 200) / 100.0 * 100 + 0.5) / 100 end as s from part)")
def price_of_cents(spark, sf_dir):
    cents = F.floor(F.col("p_retailprice") * 100)
    p = T.price_of_cents(F.when(F.col("p_size") % 7 != 0, cents), F.when(F.col("p_size") % 2 == 0, cents - F.col("p_size") * 10 + 200))
    return table(spark, sf_dir, "part").select("p_partkey", p.alias("p")).select("p_partkey", "p.price", "p.special")


# --- one order of a whole table -----------------------------------------------------
@query("select event_id, cast((row_number() over (order by ts, event_id) - 1) // 48 as bigint) as batch from events")
def batch_ids_whole(spark, sf_dir):
    return sampling.batch_ids(table(spark, sf_dir, "events"), 48, ["ts", "event_id"]).select("event_id", "batch")


@query("with s as (select event_id, cast(floor(value / 50) as bigint) as n from events), g as (select *, n - lag(n) over (order by event_id) as gained from s), r as (select *, count_if(coalesce(gained <> 0, true)) over (order by event_id) as run from g) select event_id, n, gained, case when coalesce(gained = 0, false) then (row_number() over (partition by run order by event_id) - 1)::integer else 0 end as stalls from r")
def stall_runs_whole(spark, sf_dir):
    """All events as one sweep."""
    snaps = table(spark, sf_dir, "events").select("event_id", F.floor(F.col("value") / 50).alias("n"))
    return state.stall_runs(snaps, "event_id", "n")


@query(f"""with {_LEASE}, asked as (select s_suppkey as worker, s_nationkey as since, row_number() over (order by s_nationkey, s_suppkey) as n from supplier),
  free as (select concat('t', c_custkey) as target, c_custkey as position, row_number() over (order by c_custkey) as n from customer left join leases on target = concat('t', c_custkey) where coalesce(eligible, true))
  select worker, since, target, position from asked join free using (n)""")
def hand_out(spark, sf_dir):
    """Every supplier asks for a target at once; each gets another one, in the order in which they ask."""
    queue = table(spark, sf_dir, "customer").select(F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("target"), F.col("c_custkey").alias("position"))
    requests = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("worker"), F.col("s_nationkey").alias("since"))
    return state.hand_out(_leases(spark, sf_dir), queue, requests, ["since", "worker"])


@query("""with e as (select user_id, ts, event_id, ts + case when event_type = 'view' then interval 900 minutes else interval 240 minutes end as until from events),
  s as (select *, case when ts <= max(until) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) then 0 else 1 end as new from e),
  g as (select *, sum(new) over (partition by user_id order by ts, event_id) as k from s) select user_id, min(ts) as start, max(until) as "end", count(*) as events from g group by user_id, k""")
def silence_sessions(spark, sf_dir):
    """Silence of another length after each kind of event; the tables' events are minutes and hours apart, so minutes stand for seconds."""
    gap = F.when(F.col("event_type") == "view", "900 minutes").otherwise("240 minutes")
    return state.idle_sessions(table(spark, sf_dir, "events"), "user_id", "ts", gap)


# --- addresses -------------------------------------------------------------------------
_REFS = {0: "'a/b;c?d=1#e'", 1: "'../up/./x/..'", 2: "'/root?q#f'", 3: "'//cdn.example/p'", 4: "'#frag'", 5: "'?only=q'", 6: "''", 7: "'mailto:x@y'"}
_REF_SQL = "case page_id % 8 " + " ".join(f"when {k} then {v}" for k, v in _REFS.items()) + " end"


@query(f"""with u as (select page_id, url, {_REF_SQL} as ref, regexp_extract(url, '^([a-z]+)://', 1) as scheme, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as path, regexp_extract(url, '\\?([^#]*)', 1) as asked from pages),
  d as (select *, regexp_extract(path, '^(.*/)[^/]*$', 1) as folder from u), p as (select *, concat(scheme, '://', host) as site, regexp_replace(folder, '[^/]*/$', '') as up from d)
  select page_id, case page_id % 8 when 0 then concat(site, folder, 'a/b;c?d=1#e') when 1 then concat(site, case when up in ('', '/') then '/' else up end, 'up/') when 2 then concat(site, '/root?q#f') when 3 then concat(scheme, '://cdn.example/p')
    when 4 then concat(site, path, case when asked <> '' then concat('?', asked) else '' end, '#frag') when 5 then concat(site, path, '?only=q') when 6 then url else 'mailto:x@y' end as absolute from p""")
def absolute_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.expr(_REF_SQL).alias("ref"))
    return pages.select("page_id", T.absolute_url(F.col("url"), F.col("ref")).alias("absolute"))
