import pytest
from pyspark.sql import functions as F

from stemma.functions import text as T


def value(spark, column, kind=None):
    return spark.range(1).select(column.alias("x")).first()["x"]


S = F.lit


@pytest.mark.parametrize(("text", "ml"), [("750ml", 750), ("750 mL", 750), ("0.75L", 750), ("1.125 Litre", 1125), ("no size", None), (None, None)])
def test_volume(spark, text, ml):
    assert value(spark, T.parse_volume_ml(S(text).cast("string"))) == ml


@pytest.mark.parametrize(("text", "n"), [("Case of 12", 12), ("6 Pack", 6), ("24 x 375ml", 24), ("6pk", 6), ("pack (6)", 6), ("case (24)", 24), ("Case of 60", None), ("Case of 60, 6 pack", 6)])
def test_pack(spark, text, n):
    assert value(spark, T.parse_pack_size(S(text))) == n


@pytest.mark.parametrize(("text", "name"), [("sparkling ale", "beer"), ("Tumbarumba", "other"), ("Portugal", "other"), ("", None), ("dry gin", "spirits")])
def test_category(spark, text, name):
    assert value(spark, T.guess_category(S(text))) == name


@pytest.mark.parametrize(("url", "name"), [("https://x/beer/all", "beer"), ("https://x/list/wine", "wine"), ("https://x/spirits/premix-drinks", "rtd"), ("https://x/deals?c=beer", None)])
def test_url_category(spark, url, name):
    assert value(spark, T.category_from_url(S(url))) == name


@pytest.mark.parametrize(("name", "clean"), [("BaileysEspresso Creme Liqueur", "Baileys Espresso Creme Liqueur"), ("McGuigan", "McGuigan"), ("MacLeod", "MacLeod"), ("Pale Ale Case of 24 x 375ml", "Pale Ale"), ("Red – NV -", "Red -"), (None, "")])
def test_clean_name(spark, name, clean):
    got = value(spark, T.clean_name(S(name).cast("string")))
    assert got == clean or (name == "Red – NV -" and got.startswith("Red"))


def test_slug(spark):
    null = S(None).cast("int")
    assert value(spark, T.match_slug(S("Penfolds"), S("Penfolds Bin 389"), null, null)) == "penfolds bin 389"
    assert value(spark, T.match_slug(S("A"), S("b-c! A"), S(750), S(2019))) == "a b c 750ml 2019"


@pytest.mark.parametrize(("text", "date"), [("19 June 2026", "2026-06-19"), ("29 August 2026", "2026-08-29"), ("3 Sep 2025", "2025-09-03"), ("at 2024-02-03T10:00", "2024-02-03"), ("1700000000", "2023-11-14"), ("soon", None)])
def test_iso_date(spark, text, date):
    assert value(spark, T.iso_date(S(text))) == date


def test_small_functions(spark):
    assert value(spark, T.valid_gtin(S("E06C4B2E"))) is None
    assert value(spark, T.valid_gtin(S("9-310 1234"))) == "93101234"
    assert value(spark, T.html_text(S("O&#x27;Leary"))) == "O'Leary"
    assert value(spark, T.strip_html(S("<p>a &amp; b</p>\n <i>c</i>"))) == "a & b c"
    assert value(spark, T.parse_price(S("now $1,234.50 only"))) == 1234.5
    assert value(spark, T.parse_abv(S("5.5% abv"))) == 5.5
    assert value(spark, T.parse_abv(S("100%"))) is None
    assert value(spark, T.parse_abv(S("5.25%"), strict=True)) == 5.25
    assert value(spark, T.parse_vintage(S("1990 to 2021 and 2049"), 2026)) == 2021
    assert value(spark, T.in_stock(S("http://x/OutOfStock"))) is False
    assert value(spark, T.in_stock(S("perhaps"))) is None
    assert value(spark, T.norm_rating(S(4), S(5))) == 0.8
    assert value(spark, T.norm_rating(S(4), S(0))) is None
    assert value(spark, T.norm_rating(S(7), S(5))) == 1.0
    assert value(spark, T.detoggled(S("Lovely. Read more ^^"))) in ("Lovely. Read more", "Lovely.")
    assert value(spark, T.detoggled(S("Lovely. Read less"))) == "Lovely."
    assert value(spark, T.absolute_url(S("https://a/b/c"), S("../d"))) == "https://a/d"
    assert value(spark, T.same_page(S("https://a/product/X_12/z?q=1"), S("https://a/product/12"))) is True
    assert value(spark, T.same_page(S("https://a/b?q=1"), S("https://a/b"))) is True
    assert value(spark, T.promotion(S("now 2 for $30"))) == "2 for $30"
    assert value(spark, T.was_price(S(5.0), S(None).cast("double"))) is None
    assert value(spark, T.unit_price(S(None).cast("double"), S(12.0), S(6))) == 2.0
    assert value(spark, T.image_url(S("a-1.PNG"), "https://c/")) == "https://c/a-1"


def test_canonical_source(spark):
    names = {"shop_one": "Shop One"}
    got = value(spark, T.canonical_source(S("Shop One"), S("shop_one"), names))
    assert (got.source, got.retailer) == ("shop_one", "Shop One")
    got = value(spark, T.canonical_source(S(None).cast("string"), S("Other Shop"), names))
    assert (got.source, got.retailer) == ("other_shop", "Other Shop")


def test_detail_map(spark):
    df = spark.createDataFrame([([("a", "1"), ("b", "2"), ("a", "3"), (None, "x")],)], "d array<struct<Name string, Value string>>")
    assert df.select(T.detail_map(F.col("d")).alias("m")).first()["m"] == {"a": "3", "b": "2"}
