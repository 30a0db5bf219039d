"""Canonicalisation of messy listing text as Column expressions: nothing here leaves the JVM but ``html_text``.

Absent input is null; patterns that do not match give null. Numbers are rounded half up for money and ratings (floor(x * 10^n + 0.5) / 10^n).
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that tell a category, tested in this order.
CATEGORY_WORDS = {
    "rtd": ["premix", "ready to drink", "rtd", "seltzer", "canned cocktail"],
    "cider": ["cider", "perry"],
    "sake": ["sake", "shochu"],
    "beer": ["beer", "ale", "lager", "ipa", "stout", "pilsner", "porter", "sour", "gose", "saison"],
    "spirits": ["whisky", "whiskey", "bourbon", "scotch", "gin", "vodka", "rum", "tequila", "brandy", "cognac", "liqueur", "mezcal", "absinthe", "single malt"],
    "wine": ["wine", "shiraz", "cabernet", "chardonnay", "pinot", "riesling", "merlot", "sauvignon", "grenache", "champagne", "prosecco", "sparkling", "rose", "rosé", "semillon", "tempranillo", "syrah", "moscato", "port", "sherry"],
}
# Parts of a URL's path that hint at a category, tested in this order.
URL_CATEGORY_PARTS = {
    "rtd": ["premix", "rtd", "seltzer"],
    "cider": ["cider"],
    "beer": ["beer"],
    "wine": ["wine", "champagne", "sparkling"],
    "spirits": ["spirit", "whisky", "whiskey", "gin", "vodka", "rum", "tequila", "liqueur"],
}
# Named character references that expressions decode; html_text knows them all.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#x27;": "'", "&apos;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&ndash;": "–", "&mdash;": "—", "&amp;": "&"}
# Lengths of a GTIN.
GTIN_LENGTHS = (8, 12, 13, 14)

# Patterns of sizes, strengths, years, prices, names, amounts, other members' prices, promotions and the labels of expanders, as the sources write them.
ML_PATTERN = r"(?i)(\d+(?:\.\d+)?)\s*(?:ml|mls|millilitre?s?)\b"
LITRE_PATTERN = r"(?i)(\d+(?:\.\d+)?)\s*(?:l|lt|ltr|litre?s?|liter?s?)\b"
PACK_PATTERNS = (
    r"(?i)\bcase\s+of\s+(\d+)\b",
    r"(?i)\b(\d+)\s*(?:x|×)\s*\d+\s*ml\b",
    r"(?i)\b(\d+)\s*[- ]?(?:pack|pk)\b",
    r"(?i)\b(?:pack|case|pk)\s*\(\s*(\d+)\s*\)",
)
ABV_PATTERN = r"(\d{1,2}(?:\.\d)?)\s*%"
YEAR_PATTERN = r"\b(19[5-9]\d|20[0-4]\d)\b"
PRICE_PATTERN = r"(\d+(?:,\d{3})*(?:\.\d{1,2})?)"
SIZES_PATTERN = r"(?i)\b(?:case of \d+|\d+\s*(?:x|×)\s*\d+\s*ml|\d+\s*[- ]?(?:pack|pk)|\d+(?:\.\d+)?\s*(?:ml|l|lt|ltr|litre?s?)|nv|non[- ]vintage)\b"
RUN_ON_PATTERN = r"(?<=[a-z])(?=[A-Z][a-z])"
SCOTS_PATTERN = r"\b(Ma?c)\s+([A-Z])"
ORPHAN_PATTERN = r"(?i)(?:^|\s)[x×](?=\s|$)"
LAST_SIGN_PATTERN = r"\s*[-|,/]\s*$"
_MONEY = r"\$\s*([\d,]+(?:\.\d{2})?)"
_NON_MEMBER = r"(?i)Non-?Member:?\s*\$\s*([\d,]+(?:\.\d{2})?)"
_PROMOTION = r"(?i)(buy one get one free|\d+ for \$?\d+|save \$?[\d.]+)"
_TOGGLE = r"(?i)\s*Read (?:more|less)\s*$"


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """First match's group, null for none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def rounded(x: Column, digits: int) -> Column:
    scale = 10**digits
    return F.floor(x * scale + 0.5) / scale


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(stripped(text), F.lit(""))


def collapsed(text: Column) -> Column:
    """White space runs to single blanks, none at the ends; empty is null."""
    return blank_to_null(F.regexp_replace(text, r"(?U)\s+", " "))


def parse_volume_ml(text: Column) -> Column:
    """Millilitres, from a figure in them or else in litres."""
    ml = found(text, ML_PATTERN).try_cast("double")
    litres = found(text, LITRE_PATTERN).try_cast("double") * 1000
    return F.bround(F.coalesce(ml, litres), 0).cast("int")


def parse_pack_size(text: Column) -> Column:
    """First of the patterns whose figure lies in 1 to 48."""
    sizes = [found(text, p).try_cast("int") for p in PACK_PATTERNS]
    return F.coalesce(*[F.when(n.between(1, 48), n) for n in sizes])


def parse_abv(text: Column, strict: bool = False) -> Column:
    """Percentage in (0, 80]; strict wants a whole figure before the sign, with any decimals."""
    pattern = r"(?<![\d.])(\d{1,2}(?:\.\d+)?)\s*%" if strict else ABV_PATTERN
    v = found(text, pattern).try_cast("double")
    return F.when((v > 0) & (v <= 80), v)


def parse_vintage(text: Column, as_of_year: int) -> Column:
    """Latest year from 1950 on in the text, none after as_of_year."""
    years = F.transform(F.regexp_extract_all(text, F.lit(YEAR_PATTERN), F.lit(1)), lambda y: y.cast("int"))
    return F.array_max(F.filter(years, lambda y: y <= as_of_year))


def guess_category(*texts: Column) -> Column:
    blob = F.lower(F.array_join(F.filter(F.array(*texts), lambda t: t.isNotNull() & (t != "")), " "))
    out = F.when(F.length(blob) == 0, F.lit(None).cast("string"))
    for name, words in CATEGORY_WORDS.items():
        out = out.when(blob.rlike(r"(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])"), name)
    return out.otherwise("other")


def category_from_url(url: Column) -> Column:
    path = F.lower(strip_query(url))
    rules = [(name, reduce(lambda a, b: a | b, [path.contains(p) for p in parts])) for name, parts in URL_CATEGORY_PARTS.items()]
    out = F.when(rules[0][1], rules[0][0])
    for name, rule in rules[1:]:
        out = out.when(rule, name)
    return out


def resolve_category(guessed: Column, hinted: Column) -> Column:
    """The name's category unless it says nothing, then the URL's."""
    return F.coalesce(F.nullif(guessed, F.lit("other")), hinted, guessed, F.lit("other"))


def parse_price(text: Column) -> Column:
    """Of a string: first figure, with thousands and two decimals at most."""
    figure = found(F.regexp_replace(text, r"\$", ""), PRICE_PATTERN)
    return rounded(F.regexp_replace(figure, ",", "").try_cast("double"), 2)


def price_number(value: Column) -> Column:
    return rounded(value.cast("double"), 2)


def split_run_on(name: Column) -> Column:
    """A blank where a capitalised word runs on from a small letter, but for names in Mc and Mac."""
    return F.regexp_replace(F.regexp_replace(name, RUN_ON_PATTERN, " "), SCOTS_PATTERN, "$1$2")


def clean_name(name: Column) -> Column:
    """Without sizes, packs and orphaned signs; null is empty."""
    s = split_run_on(F.regexp_replace(F.coalesce(name, F.lit("")), SIZES_PATTERN, " "))
    s = F.regexp_replace(s, "[–—]", "-")
    s = F.regexp_replace(s, ORPHAN_PATTERN, " ")
    s = F.regexp_replace(s, LAST_SIGN_PATTERN, "")
    return stripped(F.regexp_replace(s, r"\s{2,}", " "))


def match_slug(brand: Column, name: Column, volume_ml: Column, vintage: Column) -> Column:
    """Identity string: the cleaned words once each, then volume and vintage."""
    words = F.regexp_replace(F.lower(F.concat_ws(" ", clean_name(brand), clean_name(name))), r"[^a-z0-9\s]", " ")
    base = F.array_join(F.array_distinct(F.filter(F.split(words, r"\s+"), lambda t: t != "")), " ")
    volume = F.when(F.coalesce(volume_ml, F.lit(0)) != 0, F.concat(F.lit(" "), volume_ml.cast("string"), F.lit("ml"))).otherwise("")
    year = F.when(F.coalesce(vintage, F.lit(0)) != 0, F.concat(F.lit(" "), vintage.cast("string"))).otherwise("")
    return F.concat(base, volume, year)


def short_sha1(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


def product_key(brand: Column, name: Column, volume_ml: Column, vintage: Column) -> Column:
    return short_sha1(match_slug(brand, name, volume_ml, vintage))


def review_key(source: Column, url: Column, author: Column, text: Column) -> Column:
    return short_sha1(F.concat(source, F.lit("|"), url, F.lit("|"), F.coalesce(author, F.lit("")), F.lit("|"), F.substring(F.coalesce(text, F.lit("")), 1, 200)))


def norm_rating(raw: Column, scale: Column) -> Column:
    """0 to 1, to four places; null without a value or a scale."""
    x = F.try_divide(raw.cast("double"), F.nullif(scale.cast("double"), F.lit(0.0)))
    return rounded(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) + F.when(x.isNull(), F.lit(None).cast("double")).otherwise(0.0), 4)


def in_stock(text: Column) -> Column:
    """Of words for availability: false, true, or null where they tell neither."""
    s = F.lower(text)
    packed = F.replace(s, F.lit(" "), F.lit(""))
    return F.when(packed.contains("outofstock") | s.contains("sold out") | s.contains("unavailable"), False).when(packed.contains("instock") | s.contains("available"), True)


def _worded_date(text: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ("d MMMM yyyy", "d MMM yyyy")]).cast("date")


def iso_date(text: Column) -> Column:
    """First ISO date within the text, else a day with a month's name, else epoch seconds."""
    iso = found(text, r"(\d{4}-\d{2}-\d{2})")
    worded = _worded_date(F.regexp_replace(F.initcap(found(text, r"(\d{1,2}\s+[A-Za-z]+\s+\d{4})")), r"\s+", " "))
    epoch = F.date_format(F.timestamp_seconds(F.when(text.rlike(r"^\s*-?\d{1,11}\s*$"), stripped(text).try_cast("long"))), "yyyy-MM-dd")
    return F.coalesce(iso, worded.cast("string"), epoch)


def parse_date(text: Column) -> Column:
    """The whole text as a date: a day with a month's name, ISO, or ISO with time and offset."""
    s = blank_to_null(text)
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))
    return F.coalesce(_worded_date(F.initcap(s)), iso).cast("string")


def decode_entities(text: Column) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), ENTITIES.items(), text)


def strip_html(text: Column) -> Column:
    """Tags to blanks, common character references decoded, white space collapsed; empty is null."""
    return collapsed(decode_entities(F.regexp_replace(text, r"<[^>]+>", " ")))


@F.pandas_udf(StringType())
def html_text(s: pd.Series) -> pd.Series:
    """All character references decoded, for texts with rare ones."""
    import html

    return s.map(html.unescape, na_action="ignore")


def joined_text(values: Column) -> Column:
    """An array's strings joined, null where nothing is left."""
    return blank_to_null(F.array_join(values, " "))


def as_float(text: Column) -> Column:
    return F.regexp_replace(stripped(text), "%+$", "").try_cast("double")


def image_url(name: Column, prefix: str) -> Column:
    """Absolute addresses as they are, bare file names below the prefix without their extension."""
    s = blank_to_null(name)
    return F.when(s.startswith("http"), s).otherwise(F.concat(F.lit(prefix), F.regexp_replace(s, r"(?i)\.(png|jpe?g|webp)$", "")))


def tokens(slug: Column) -> Column:
    """Different words of more than two letters."""
    return F.array_distinct(F.filter(F.split(slug, " "), lambda t: F.length(t) > 2))


def review_slug(name: Column, as_of_year: int) -> Column:
    return match_slug(F.lit(None).cast("string"), name, parse_volume_ml(name), parse_vintage(name, as_of_year))


def informativeness(*columns: Column) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])


def detail_map(pairs: Column) -> Column:
    """array<struct<Name, Value>> to a map; of repeated names the last counts."""
    named = F.filter(pairs, lambda p: p["Name"].isNotNull() & (p["Name"] != ""))
    names = F.array_distinct(F.transform(named, lambda p: p["Name"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(named, lambda p: p["Name"] == n), -1)["Value"]))


def price_of_cents(cents: Column, special_cents: Column) -> Column:
    """Price of whole cents; a special price counts only where it is lower. struct<price, special>"""
    plain = F.when(cents > 0, rounded(cents / 100.0, 2))
    special = F.when(special_cents > 0, rounded(special_cents / 100.0, 2))
    use = special.isNotNull() & (plain.isNull() | (special < plain))
    return F.struct(F.when(use, special).otherwise(plain).alias("price"), F.coalesce(use, F.lit(False)).alias("special"))


def unit_price(price: Column, member: Column, pack: Column) -> Column:
    base = F.coalesce(price, member)
    return F.when(pack > 1, rounded(base / pack, 2)).otherwise(base)


def was_price(was: Column, price: Column) -> Column:
    """The earlier price where it was higher; without a present price there is none to compare."""
    return F.when(was > price, was)


def detoggled(text: Column) -> Column:
    """Review text without the label of its own expander and trailing carets."""
    return stripped(F.regexp_replace(F.regexp_replace(text, _TOGGLE, ""), r"[\s^]+$", ""))


def money(text: Column) -> Column:
    return found(text, _MONEY)


def non_member_price(text: Column) -> Column:
    return found(text, _NON_MEMBER)


def promotion(text: Column) -> Column:
    return found(text, _PROMOTION)


def review_count(text: Column) -> Column:
    return F.nullif(found(text, r"(\d+)").try_cast("int"), F.lit(0))


# Fixed value: the parts of an address, scheme, host, path, query, fragment.
_URI = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _resolved(path: Column, directory: Column) -> Column:
    """A path that is not empty, below an array of segments unless it begins with a slash, without dots."""
    own = F.split(path, "/")
    every = F.when(path.startswith("/"), own).otherwise(F.concat(directory, own))
    # Empty segments count at both ends alone.
    kept = F.filter(every, lambda s, i: (s != "") | (i == 0) | (i == F.size(every) - 1))
    none = F.expr("cast(array() as array<string>)")
    step = lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.concat(done, F.array(s)))
    walked = F.aggregate(kept, none, step)
    walked = F.when(F.element_at(kept, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    joined = F.array_join(walked, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def absolute_url(base: Column, ref: Column) -> Column:
    """A reference resolved against its page's address. An empty reference is the page, one of another scheme stands as it is; null for pages that have no http or https address."""
    tidy = lambda u: F.regexp_replace(F.regexp_replace(u, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    part = lambda u, k: F.regexp_extract(u, _URI, k)
    # What stands behind a semicolon in the last segment is no part of it.
    last = r"(?s)^((?:.*/)?[^/;]*)(;[^/]*)?$"
    b, r = tidy(base), tidy(ref)
    scheme, host, folder = F.lower(part(b, 1)), part(b, 2), F.regexp_extract(part(b, 3), last, 1)
    own_scheme, own_host, path, query = F.lower(part(r, 1)), part(r, 2), part(r, 3), part(r, 4)
    plain = F.regexp_extract(path, last, 1)
    extra = lambda p: F.regexp_replace(F.regexp_extract(p, last, 2), "^;$", "")
    pieces = F.split(folder, "/")
    directory = F.when(folder == "", F.array(F.lit(""))).otherwise(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(1))))
    here = (plain == "") & (extra(path) == "")
    same = F.concat(host, F.when((folder == "") & (extra(part(b, 3)) != ""), "/").otherwise(""), folder, extra(part(b, 3)))
    there = F.when(own_host != "", F.concat(own_host, plain, extra(path))).when(here, same).otherwise(F.concat(host, _resolved(plain, directory), extra(path)))
    asked = F.when((own_host == "") & here & (query == ""), part(b, 4)).otherwise(query)
    tail = lambda sign, x: F.when(x != "", F.concat(F.lit(sign), x)).otherwise("")
    met = F.concat(scheme, F.lit("://"), there, tail("?", asked), tail("#", part(r, 5)))
    usable = scheme.isin("http", "https") & (host != "")
    return F.when(usable, F.when(ref == "", base).when((own_scheme != "") & (own_scheme != scheme), ref).otherwise(met))


def url_product_id(url: Column) -> Column:
    """The figure after /product/ (behind capitals and an underscore, if any), or after the path's last underscore."""
    path = strip_query(url)
    return F.coalesce(found(path, r"/product/(?:[A-Z]+_)?(\d+)"), found(path, r"_(\d+)$"))


def strip_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def bare_host(url: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", ""), F.lit(""))


def host_slug(url: Column) -> Column:
    """A host as a source's name: whatever is not a word character becomes an underscore."""
    return F.regexp_replace(bare_host(url), r"\W+", "_")


def slugified(text: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "_"), r"^_|_$", ""), F.lit(""))


def canonical_source(source: Column, retailer: Column, names: dict[str, str]) -> Column:
    """struct<source, retailer>: names maps sources to what they display; swapped arguments are put right, unknown displays make their own source."""
    by_display = {v: k for k, v in names.items()}
    to_display = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else F.expr("map()").cast("map<string,string>")
    to_source = F.create_map(*[F.lit(x) for kv in by_display.items() for x in kv]) if names else F.expr("map()").cast("map<string,string>")
    swapped = F.try_element_at(to_source, source).isNotNull() & F.try_element_at(to_display, retailer).isNotNull()
    s, r = F.when(swapped, retailer).otherwise(source), F.when(swapped, source).otherwise(retailer)
    display = F.coalesce(F.try_element_at(to_display, s), r)
    return F.struct(F.coalesce(F.when(F.try_element_at(to_display, s).isNotNull(), s), F.try_element_at(to_source, r), slugified(s), slugified(r)).alias("source"), display.alias("retailer"))


def valid_gtin(text: Column) -> Column:
    digits = F.regexp_replace(text, r"\D", "")
    return F.when(F.length(digits).isin(*GTIN_LENGTHS), digits)


def first_valid_gtin(values: Column) -> Column:
    """Of an array: the first that is all digits and of a GTIN's length."""
    return F.get(F.filter(values, lambda v: v.rlike(r"^\d+$") & F.length(v).isin(*GTIN_LENGTHS)), 0)


def is_biased(sort_order: Column) -> Column:
    """Sampled in an order other than newest first."""
    return F.coalesce(sort_order != "Newest", F.lit(False))


def same_page(a: Column, b: Column) -> Column:
    """Addresses of one product: equal ids where both have one, else equal without queries."""
    x, y = url_product_id(a), url_product_id(b)
    return F.when(x.isNotNull() & y.isNotNull(), x == y).otherwise(strip_query(a) == strip_query(b))
