import json

from pyspark.sql import functions as F

from stemma.operators.compare import compare_offers
from stemma.sources import adapters, jsonld, readers, sinks

AS_OF = "2026-01-02T00:00:00+00:00"


def test_seeds(spark):
    lines = [(0, "# no"), (1, ""), (2, "https://s/wine | pages=3"), (3, "https://s/beer?x=1"), (4, "https://s/beer")]
    got = readers.expand_seeds(spark.createDataFrame(lines, "ord int, value string"))
    assert {(r.url, r.clicks) for r in got.collect()} == {("https://s/wine", 0), ("https://s/wine?page=2", 0), ("https://s/wine?page=3", 0), ("https://s/beer", 60)}


def test_records_round_trip(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"record_type":"product","product_key":"k","name":"x"}\n\nnot json\n{"record_type":"offer","product_key":"k","price_aud":2.5}\n')
    (tmp_path / "catalogue.jsonl").write_text('{"record_type":"product","product_key":"no"}\n')
    df = readers.read_records(spark, str(tmp_path))
    assert readers.of_kind(df, "product").count() == 1
    assert readers.of_kind(df, "offer").first()["price_aud"] == 2.5
    sinks.write_records(readers.of_kind(df, "offer").drop("ord"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_storefront(spark):
    row = (1, "h", "Red Ale 375ml", "Maker", "beer", ["a"], "5.5% alc", [("http://i",)], [("Default Title", "8.00", "9.00", True, "93101234"), ("Case of 24", "150.00", None, False, None)])
    df = spark.createDataFrame([row], "id int, handle string, title string, vendor string, product_type string, tags array<string>, body_html string, images array<struct<src string>>, variants array<struct<title string, price string, compare_at_price string, available boolean, barcode string>>").withColumn("ord", F.lit(1))
    products, offers = adapters.storefront(df, AS_OF, "shop", "Shop", "https://s")
    assert products.count() == 1
    got = {r.pack_size: r for r in offers.collect()}
    assert got[1].was_price_aud == 9.0 and got[24].unit_price_aud == 6.25 and got[24].in_stock is False


def test_product_api(spark):
    row = ("12", "Maker Shiraz", None, "750mL", 20.0, 25.0, True, True, 4.5, 10, [("productname", "Maker Shiraz 750ML 2021"), ("alcohol%", "14.5%"), ("image1", "a.png"), ("productcopy", "<b>Good</b> &amp; red"), ("brand_name", "Maker")], "u")
    df = spark.createDataFrame([row], "Stockcode string, Name string, BrandName string, PackageSize string, Price double, WasPrice double, IsOnSpecial boolean, IsAvailable boolean, OverallRating double, NumberOfReviews int, AdditionalDetails array<struct<Name string, Value string>>, url string").withColumn("ord", F.lit(1))
    products, offers = adapters.product_api(df, AS_OF, "s", "S", "https://i/")
    p, o = products.first(), offers.first()
    assert (p.volume_ml, p.vintage, p.abv, p.brand, p.description, p.image_url) == (750, 2021, 14.5, "Maker", "Good & red", "https://i/a")
    assert (o.price_aud, o.was_price_aud, o.promo, o.aggregate_rating_norm) == (20.0, 25.0, "special", 0.9)


def _page(node) -> str:
    return f'<html><script type="application/ld+json">{json.dumps(node)}</script><script type="application/ld+json">broken</script></html>'


def test_jsonld(spark):
    product = {"@type": "Product", "name": "O&#x27;Leary Gin (700ml)", "brand": {"name": "O&#x27;Leary"}, "sku": "s1", "gtin13": "E06C4B2E", "offers": [{"price": 60, "availability": "http://x/InStock"}, {"price": 70}], "aggregateRating": {"ratingValue": 4.5, "reviewCount": 9}, "review": [{"@type": "Review", "reviewBody": "Very good gin indeed", "author": {"name": "A"}, "reviewRating": {"ratingValue": 5, "bestRating": 5}}]}
    pages = spark.createDataFrame([("u1", _page({"@graph": [{"x": {"y": product}}]})), ("u2", _page([{"@type": "Thing"}, product])), ("u3", "<html></html>")], "url string, html string").withColumn("ord", F.col("url"))
    found = jsonld.nodes(pages, "url", "html", ["Product"])
    assert sorted(r.url for r in found.select("url").collect()) == ["u1", "u2"]
    assert jsonld.product_offers(found, "url").count() == 4
    assert jsonld.summaries(found, "url").first()["total_reviews"] == 9
    assert {r.author for r in jsonld.review_arrays(found, "url").collect()} == {"A"}
    assert jsonld.nodes(pages, "url", "html", ["Review"]).count() == 2
    products, offers = adapters.jsonld_pages(pages, AS_OF, "n", "N")
    p, o = products.collect(), offers.collect()
    assert len(p) == 1 and p[0].brand == "O'Leary" and p[0].volume_ml == 700 and p[0].gtin is None
    assert o[0].price_aud == 60.0 and o[0].in_stock is True


def test_store_and_posts(spark):
    item = ("Pale Ale 6pk 375ml", None, "375", 4, ["x", "93101234"], "Beer", "pale", "9", 2300, 2000, "st")
    df = spark.createDataFrame([item], "fullName string, name string, unitSize string, packQty int, barcodes array<string>, group string, slug string, id string, price_cents bigint, special_cents bigint, store string").withColumn("ord", F.lit(1))
    products, offers = adapters.store_items(df, AS_OF, "t", "T", "https://t/product/")
    assert products.first()["carton_qty"] == 4 and offers.first()["price_aud"] == 20.0 and offers.first()["pack_size"] == 6
    df = spark.createDataFrame([("<b>Shiraz</b>", "<p>" + "long note " * 6 + "</p>", "95", "l", "2025-01-02T00"), ("T", "short", None, "l", None)], "title string, content string, points string, link string, date string")
    got = adapters.posts(df, AS_OF, "w").collect()
    assert len(got) == 1 and got[0].rating_norm == 0.95 and got[0].review_date == "2025-01-02"


def test_api_reviews(spark):
    a = "array<struct<LongDesc string, Name string, Rating double, Title string, DateSubmitted string, IsRecommended boolean, Likes int, SyndReviewSource string>>"
    b = "array<struct<description string, displayName string, rating double, title string, date string, wouldRecommend boolean, helpful_yes int, SourceClient string>>"
    df = spark.createDataFrame([("u", "p", [("A fine bottle of wine", "N", 4.0, "t", "29 August 2026", True, 2, None)], None), ("v", "q", None, [("Another fine bottle", "M", 5.0, None, "2026-08-29T10:00:00+10:00", None, None, "c"), ("short", "x", 1.0, None, None, None, None, None)])], f"url string, product_name string, Reviews {a}, reviews_b {b}")
    got = {r.source_url: r for r in adapters.api_reviews(df, AS_OF, "s").collect()}
    assert got["u"].review_date == got["v"].review_date == "2026-08-29" and got["u"].rating_norm == 0.8


def test_tiles(spark):
    a = spark.createDataFrame([("Maker", "Red", "$20.00", "Non-Member: $22.50 member offer 2 for $40", "pack (6)", "u", "(12)")], "brand string, subtitle string, shown string, full string, unit string, url string, reviews_text string")
    r = adapters.tiles_a(a).first()
    assert (r.name_raw, r.price_raw, r.member_price_raw, r.promo_raw, r.aggregate_review_count) == ("Maker Red", "22.50", "20.00", "2 for $40", 12)
    b = spark.createDataFrame([("Maker", "Red", "20", None, "25", "50", "/red/x_991")], "brand string, name string, dollars string, cents string, was_dollars string, was_cents string, href string")
    r = adapters.tiles_b(b).first()
    assert (r.price_raw, r.was_price_raw, r.source_product_id) == ("20.00", "25.50", "991")


def test_unit_comparison(spark):
    offers = spark.createDataFrame([("k", "a", 1, 8.0), ("k", "b", 4, 22.99)], "product_key string, retailer string, pack_size int, price_aud double")
    r = compare_offers(offers).first()
    assert r.compare_basis == "unit_price" and r.compare_prices == {"a": 8.0, "b": 5.75} and r.compare_cheapest == "b"


def test_jsonld_at_any_depth(spark):
    """One walk: no join, no union, and blocks as deep as a reader takes."""
    deep = '{"inner":' * 900 + '[{"@type":["Thing","Pro\\u0064uct"],"name":"x}{\\"],","list":[1,{"@type":"Product"}]}]' + "}" * 900
    pages = spark.createDataFrame([("u", f'<script type="application/ld+json">{deep}</script>'), ("v", '<script type="application/ld+json">{"@type":"Product"</script>'), ("w", None)], "url string, html string")
    found = jsonld.nodes(pages, "url", "html", ["Product"])
    rows = sorted((r.path, r.json) for r in found.select("path", F.to_json("node").alias("json")).collect())
    assert [len(p) for p, _ in rows] == [902, 904] and rows[0][0][-1] == 0 and rows[1][0][-2:] == [2, 1]
    assert json.loads(rows[0][1])["name"] == 'x}{"],' and json.loads(rows[1][1]) == {"@type": "Product"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Exchange" not in plan
    assert jsonld.typed_objects('[1, "Product", {"a": "Product", "@type": "Other", "b": {"@type": "Product"}}]', frozenset(["Product"])) == [([2, 2], '{"@type": "Product"}')]


def test_reviews_of_two_products(spark):
    review = lambda n: {"@type": "Review", "reviewBody": f"Body number {n}"}
    pages = spark.createDataFrame([("u", _page([{"@type": "Product", "name": "one", "review": [review(1)]}, {"@type": "Product", "name": "two", "reviews": [review(2), review(3) | {"itemReviewed": {"name": "three"}}]}]))], "url string, html string")
    got = jsonld.review_arrays(jsonld.nodes(pages, "url", "html", ["Product"]), "url").collect()
    assert sorted((r.text, r.product_name_raw) for r in got) == [("Body number 1", "one"), ("Body number 2", "two"), ("Body number 3", "three")]


def test_repeated_stars(spark):
    df = spark.createDataFrame([("u", "p", [(5, 1), (4, 2), (5, 7)], 4.5, 0, 12, 90, None)], "url string, product_name string, RatingDistribution array<struct<RatingValue int, Count bigint>>, OverallRating double, TotalReviewCount int, TotalResults int, RecommendedPercentage int, overall struct<rating double, totalReviews int, percentageRecommending string>")
    r = adapters.api_summaries(df, AS_OF, "s").first()
    assert r.distribution == {"5": 7, "4": 2} and r.total_reviews == 12


def test_malformed_cards(spark):
    """Unknown declarations, comments and tags that never end, and end tags of nothing cost no more than others."""
    import time

    from stemma.sources.cards import _Cards

    card = '<div class="card"><p class="t">Text &amp; more</p></div>'

    def read(page):
        began = time.perf_counter()
        parser = _Cards("card", {"t": "t"})
        parser.feed(page)
        parser.close()
        parser.finish()
        assert time.perf_counter() - began < 10
        return [c.get("t") for c in parser.cards]

    assert read(f"<![foo[x]]>{card}<!ELEMENT x><?pi x>{card}") == ["Text & more"] * 2
    assert read(card + "</i>" * 200_000 + card) == ["Text & more"] * 2
    assert read("<b>" * 100_000 + "</i>" * 100_000 + card) == ["Text & more"]
    assert read(card + "<!-- " * 200_000 + card) == ["Text & more"]
    assert read(card + "<a " * 100_000) == ["Text & more"]
    assert read(card + "<!x " * 200_000) == ["Text & more"]
    assert read('<div class="card"><p class="t">' + "a <i>b</i> " * 100_000)[0][:9] == "a b a b a"
    assert read("") == read("<") == read("</") == []


def test_addresses(spark):
    """Against the standard library, but for pages without an address of the web."""
    import itertools
    from urllib.parse import urljoin

    from stemma.functions import text as T

    bases = ["http://h", "https://H.x/", "HTTP://h/a", "http://h/a/b", "http://h/a/b/", "http://h/a/b;p?q=1#f", "http://u@h:80/a/../b/./c", "http://h//x//y", " http://h/a\n/b", "http://h?q", "http://h/;p"]
    paths = ["", "x", "x/", "./x", "../x", "../../../x", "/x/../y", "/", ".", "..", "./", "../", "x//y", "x/./y/..", "//g/x/../y", "//g", "///x", "x;y=1", ";p", "x;", "http:x", "HTTPS://z/..", "mailto:a@b", "javascript:void(0)", "a:b", "x:80", " x y ", "\tx\n", "é/ü", "%2e%2e/x"]
    refs = [p + q + f for p, q, f in itertools.product(paths, ["", "?r=2&s", "?"], ["", "#frag/../x", "#"])]
    rows = [(b, r) for b in bases for r in refs] + [("", "x"), (None, "x"), ("http://h/", None), ("ftp://h/", "x")]
    df = spark.createDataFrame(rows, "base string, ref string").withColumn("got", T.absolute_url(F.col("base"), F.col("ref")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        if not r.base or r.ref is None or r.base.startswith("ftp"):
            assert r.got is None
        else:
            assert r.got == urljoin(r.base, r.ref), (r.base, r.ref)
