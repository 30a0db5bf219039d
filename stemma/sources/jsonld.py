"""JSON-LD in pages: nodes of wanted types anywhere in the tree, and the records that they give."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as T

# Fixed value: how pages hold such data.
_BLOCK = r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'


def blocks(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, block, node variant) of each well-formed block."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(_BLOCK), F.lit(1))).alias("block", "json"))
    return found.select(key, "block", F.try_parse_json("json").alias("node")).where("node is not null")


_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s"{}\[\]:,]+', re.S)


def _plain(string: str) -> str:
    return json.loads(string) if "\\" in string else string[1:-1]


def typed_objects(text: str, types: frozenset[str]) -> list[tuple[list[int], str]]:
    """Of a well-formed document every object whose @type is, or holds, one of the types: its places in what holds it, outermost first, and its text."""
    out, path = [], []
    stack: list[list] = []  # is it an object, where it begins, place of the present member, its name, whether the type is one, whether a name is next
    for m in _TOKEN.finditer(text):
        t = m.group()
        if t in "{[":
            if stack:
                path.append(stack[-1][2])
            stack.append([t == "{", m.start(), 0, None, False, True])
        elif t in "}]":
            is_object, start, _, _, wanted, _ = stack.pop()
            if is_object and wanted:
                out.append((path.copy(), text[start : m.end()]))
            if stack:
                path.pop()
        elif not stack:
            continue
        elif t == ",":
            stack[-1][2] += 1
            stack[-1][5] = True
        elif t == ":":
            stack[-1][5] = False
        elif t[0] == '"':
            top = stack[-1]
            if top[0] and top[5]:
                top[3] = _plain(t)
                continue
            owner = top if top[0] else stack[-2] if len(stack) > 1 and stack[-2][0] else None
            if owner and owner[3] == "@type" and _plain(t) in types:
                owner[4] = True
    return out


def nodes(pages: DataFrame, key: str, html: str, types: list[str]) -> DataFrame:
    """(key, path array<int>, node): every object of one of the types, in document order by path, at any depth. A block is walked once, with a stack of its own."""
    wanted = frozenset(types)
    found = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(_BLOCK), F.lit(1))).alias("block", "json"))
    found = found.where(F.try_parse_json("json").isNotNull())

    def walk(batches):
        for b in batches:
            rows = [(i, [block, *path], text) for i, (block, json_) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)) for path, text in typed_objects(json_, wanted)]
            keys = b.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array([r[1] for r in rows], pa.list_(pa.int32())), pa.array([r[2] for r in rows], pa.string())], names=[key, "path", "json"])

    schema = found.select(key, F.array("block").alias("path"), "json").schema
    return found.mapInArrow(walk, schema).select(key, "path", F.parse_json("json").alias("node"))


def first_products(pages: DataFrame, key: str, html: str) -> DataFrame:
    """The first product among a page's top-level nodes: (key, node)."""
    top = blocks(pages, key, html)
    listed = top.sparkSession.sql(f"select {key}, block, e.pos as pos, e.value as node from {{top}}, lateral variant_explode(node) as e where schema_of_variant(node) like 'ARRAY%'", top=top)
    every = top.where(~F.schema_of_variant("node").startswith("ARRAY")).select(key, "block", F.lit(0).alias("pos"), "node").unionByName(listed)
    kept = every.where(F.coalesce(F.try_variant_get("node", "$['@type']", "string") == "Product", F.lit(False)))
    # Variants do not order or group, so the choice is made on their text.
    first = kept.withColumn("json", F.to_json("node")).groupBy(key).agg(F.min_by("json", F.struct("block", "pos")).alias("json"))
    return first.select(key, F.parse_json("json").alias("node"))


def _text(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "string")


def product_fields(node: Column) -> dict[str, Column]:
    brand = F.coalesce(_text(node, "$.brand.name"), F.when(~F.coalesce(_text(node, "$.brand"), F.lit("{")).startswith("{"), _text(node, "$.brand")))
    image = F.coalesce(_text(node, "$.image[0]"), _text(node, "$.image.url"), F.when(~F.coalesce(_text(node, "$.image"), F.lit("[")).rlike(r"^[\[{]"), _text(node, "$.image")))
    return {
        "name_raw": T.html_text(_text(node, "$.name")),
        "brand_raw": T.html_text(brand),
        "description_raw": _text(node, "$.description"),
        "source_product_id": F.coalesce(_text(node, "$.sku"), _text(node, "$.productID")),
        "gtin": F.coalesce(_text(node, "$.gtin13"), _text(node, "$.gtin12"), _text(node, "$.gtin")),
        "image_url": image,
        "subcategory_raw": _text(node, "$.category"),
    }


def product_offers(products: DataFrame, key: str, node: str = "node") -> DataFrame:
    """One raw product of each offer, one without a price where there is none; a low price stands in, a high one is the earlier price."""
    offers = F.coalesce(F.try_variant_get(node, "$.offers", "array<variant>"), F.when(F.try_variant_get(node, "$.offers", "variant").isNotNull(), F.array(F.try_variant_get(node, "$.offers", "variant"))))
    rows = products.withColumns(product_fields(F.col(node))).where("name_raw is not null").select("*", F.posexplode_outer(offers).alias("offer_at", "__offer"))
    o = F.col("__offer")
    return rows.select(
        key, "offer_at", "name_raw", "brand_raw", "description_raw", "source_product_id", "gtin", "image_url", "subcategory_raw",
        F.coalesce(_text(o, "$.price"), _text(o, "$.lowPrice")).alias("price_raw"), _text(o, "$.highPrice").alias("was_price_raw"), _text(o, "$.availability").alias("availability_raw"), F.coalesce(_text(o, "$.priceCurrency"), F.lit("AUD")).alias("currency"),
    )


def reviews(found: DataFrame, key: str, node: str = "node", also: list[str] | None = None) -> DataFrame:
    """Raw reviews of review nodes with a body, with the columns ``also``."""
    n = F.col(node)
    author = F.coalesce(_text(n, "$.author.name"), F.when(~F.coalesce(_text(n, "$.author"), F.lit("{")).startswith("{"), _text(n, "$.author")))
    return found.select(
        key, *(also or []), _text(n, "$.itemReviewed.name").alias("product_name_raw"), author.alias("author"), _text(n, "$.name").alias("title"), F.coalesce(_text(n, "$.reviewBody"), _text(n, "$.description")).alias("text"),
        _text(n, "$.reviewRating.ratingValue").try_cast("double").alias("rating_raw"), _text(n, "$.reviewRating.bestRating").try_cast("double").alias("rating_scale"), _text(n, "$.datePublished").alias("review_date"),
    ).where("coalesce(text, '') <> ''")


def review_arrays(products: DataFrame, key: str, node: str = "node") -> DataFrame:
    """Raw reviews in the review arrays of product nodes; those that don't name what they are about are about their own product."""
    arrays = F.coalesce(F.try_variant_get(node, "$.review", "array<variant>"), F.try_variant_get(node, "$.reviews", "array<variant>"))
    each = products.select(key, _text(F.col(node), "$.name").alias("__name"), F.explode(arrays).alias("node"))
    return reviews(each, key, also=["__name"]).withColumn("product_name_raw", F.coalesce("product_name_raw", "__name")).drop("__name")


def summaries(products: DataFrame, key: str, node: str = "node") -> DataFrame:
    """Published ratings of product nodes that have any."""
    n = F.col(node)
    count = F.coalesce(_text(n, "$.aggregateRating.reviewCount"), _text(n, "$.aggregateRating.ratingCount")).try_cast("int")
    rows = products.select(key, _text(n, "$.name").alias("product_name_raw"), _text(n, "$.aggregateRating.ratingValue").try_cast("double").alias("average_rating"), F.coalesce(F.nullif(_text(n, "$.aggregateRating.bestRating").try_cast("double"), F.lit(0.0)), F.lit(5.0)).alias("rating_scale"), F.nullif(count, F.lit(0)).alias("total_reviews"), F.try_variant_get(node, "$.aggregateRating", "variant").alias("__a"))
    return rows.where("__a is not null").drop("__a")
