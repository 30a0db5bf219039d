"""Repeated parts of pages (tiles, review cards, chart rows) by the classes of their elements.

Pages are read in one pass: what opens and never closes (a comment, a declaration, a tag) takes the rest of the page, declarations that HTML does not know are
comments, and an end tag costs what it closes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as T

# HTML elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Cards(HTMLParser):
    """fields: name -> class (text of the first such element), class@attribute (of the first that has it), or class# (how many)."""

    def __init__(self, item: str, fields: dict[str, str]):
        super().__init__(convert_charrefs=True)
        self.item = frozenset(item.split("."))
        self.fields = [(name, frozenset(spec.rstrip("#").split("@")[0].split(".")), spec.split("@")[1] if "@" in spec else "", spec.endswith("#")) for name, spec in fields.items()]
        self.open: list[str] = []
        self.times: Counter[str] = Counter()
        self.cards: list[dict] = []
        self.card: dict[str, list[str]] | None = None
        self.depth = 0
        self.reading: list[tuple[str, int]] = []

    def _to(self, mark: str, i: int) -> int:
        """Where what begins at i has ended, at the next mark or with the page."""
        at = self.rawdata.find(mark, i)
        return len(self.rawdata) if at < 0 else at + len(mark)

    def parse_comment(self, i, report=1):
        return self._to("-->", i + 4)

    def parse_html_declaration(self, i):
        return self._to("-->", i + 4) if self.rawdata.startswith("<!--", i) else self._to(">", i + 2)

    def parse_pi(self, i):
        return self._to(">", i + 2)

    def parse_starttag(self, i):
        at = super().parse_starttag(i)
        return len(self.rawdata) if at < 0 else at

    def parse_endtag(self, i):
        at = super().parse_endtag(i)
        return len(self.rawdata) if at < 0 else at

    def handle_starttag(self, tag, attrs):
        values = {k: v or "" for k, v in attrs}
        classes = frozenset(values.get("class", "").split()) | {tag} | {f"[{k}]" for k in values} | {f"[itemprop={v}]" for v in values.get("itemprop", "").split()}
        if tag not in VOID:
            self.open.append(tag)
            self.times[tag] += 1
        if self.card is None and self.item <= classes:
            self.card, self.depth = {}, len(self.open)
        if self.card is None:
            return
        for name, wanted, attribute, count in self.fields:
            if not wanted <= classes:
                continue
            if count:
                self.card[name] = [str(int(self.card.get(name, ["0"])[0]) + 1)]
            elif attribute:
                if attribute in values:
                    self.card.setdefault(name, [values[attribute]])
            elif name not in self.card and tag not in VOID:
                self.card[name] = []
                self.reading.append((name, len(self.open)))

    def handle_endtag(self, tag):
        if not self.times[tag]:
            return
        while self.open:
            last = self.open.pop()
            self.times[last] -= 1
            if last == tag:
                break
        self.reading = [(n, d) for n, d in self.reading if d <= len(self.open)]
        if self.card is not None and len(self.open) < self.depth:
            self.finish()

    def handle_data(self, data):
        for name, _ in self.reading:
            self.card[name].append(data)

    def finish(self):
        if self.card is not None:
            told = {k: " ".join("".join(v).split()) for k, v in self.card.items()}
            self.cards.append({k: v for k, v in told.items() if v})
            self.card, self.reading = None, []


def cards(pages: DataFrame, key: str, html: str, item: str, fields: dict[str, str]) -> DataFrame:
    """(key, position, one string column of each field) for every element of the item's classes, in page order. Classes of one element stand with dots
    between (``rating-icon.checked``); an element's name counts as one, and so do its attributes (``[data-rating]``) and properties (``[itemprop=author]``)."""
    names = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, page in zip(b[key], b[html], strict=True):
                parser = _Cards(item, fields)
                parser.feed(page or "")
                parser.close()
                parser.finish()
                rows += [(k, i, *(c.get(n) for n in names)) for i, c in enumerate(parser.cards)]
            yield pd.DataFrame(rows, columns=[key, "position", *names])

    schema = pages.select(key, F.lit(0).alias("position"), *[F.lit(None).cast("string").alias(n) for n in names]).schema
    return pages.select(key, html).mapInPandas(run, schema)


def review_cards(found: DataFrame, source: str, subject: str = "product") -> DataFrame:
    """Cards with text, author, title, rating and review_date as raw reviews; an expander's label goes, and cards without text."""
    has = lambda c: F.col(c) if c in found.columns else F.lit(None).cast("string")
    body = T.detoggled(F.col("text"))
    rating = T.found(has("rating"), r"(\d+(?:\.\d+)?)").try_cast("double")
    return found.select("*", body.alias("__body"), rating.alias("rating_raw")).where("coalesce(__body, '') <> ''").drop("text", "rating").withColumnRenamed("__body", "text").withColumns({"source": F.lit(source), "subject_type": F.lit(subject), "rating_scale": F.lit(5.0)})


def star_summary(rows: DataFrame, key: str) -> DataFrame:
    """rows(key, star, count, position) of a chart: the distribution, and its total. Of rows that tell of one star the last counts, by position, or without that the greatest."""
    n = F.coalesce(F.regexp_replace("count", r"[^\d]", "").try_cast("bigint"), F.lit(0))
    at = F.col("position") if "position" in rows.columns else F.lit(0)
    last = rows.where("star is not null and count is not null").groupBy(key, "star").agg(F.max_by(n, F.struct(at, n)).alias("n"))
    out = last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("star", "n")))).alias("distribution"), F.sum("n").alias("total_reviews"))
    return out.withColumn("total_reviews", F.nullif("total_reviews", F.lit(0)))


# How pages word what they publish.
AVERAGE_PATTERN = r"(?i)average customer rating:?\s*([\d.]+)"
RECOMMEND_PATTERN = r"(?i)(\d+)%\s*of reviewers would recommend"


def published_average(text: Column) -> Column:
    """struct<average_rating, pct_recommend> of a summary's text."""
    average = T.found(text, AVERAGE_PATTERN).try_cast("double")
    return F.struct(average.alias("average_rating"), T.found(text, RECOMMEND_PATTERN).try_cast("double").alias("pct_recommend"))


@dataclass(frozen=True)
class Setup:
    """How a kind of site lays out its reviews: the element of one, its fields as for cards(), and what it is about."""

    item: str
    fields: dict[str, str]
    subject: str = "product"


# Layouts of review pages, by the names and classes of their elements.
SETUPS = {
    "cards": Setup("review-card", {"title": "review-card__title", "author": "review-card__sdesc", "text": "review-card__ldesc", "review_date": "review-card__info", "rating": "rating-icon.checked#"}),
    "activity": Setup("item", {"product_name_raw": "beer", "author": "user", "text": "comment-text", "rating": "[data-rating]@data-rating", "review_date": "time@datetime"}),
    "service": Setup("article.[data-service-review-card-paper]", {"title": "[data-service-review-title-typography]", "author": "[data-consumer-name-typography]", "text": "[data-service-review-text-typography]", "rating": "img@alt", "review_date": "time@datetime"}, "retailer"),
    "property": Setup("div.[itemprop=review]", {"title": "[itemprop=name]", "author": "[itemprop=author]", "text": "[itemprop=reviewBody]", "rating": "[itemprop=ratingValue]@content", "review_date": "time@datetime"}, "retailer"),
    "article": Setup("html", {"title": "h1", "product_name_raw": "h1", "author": "author-name", "text": "article-body", "review_date": "time@datetime"}),
}


def site_reviews(pages: DataFrame, key: str, html: str, source: str, layout: str | None = None) -> DataFrame:
    """Raw reviews of a site's pages: those of its layout, and those that its structured data hold; one of each text and author."""
    from stemma.operators.dedupe import keep_best
    from stemma.sources import jsonld

    names = ("product_name_raw", "author", "title", "text", "rating_raw", "rating_scale", "review_date")
    subject = SETUPS[layout].subject if layout else "product"
    out = jsonld.reviews(jsonld.nodes(pages, key, html, ["Review", "UserReview"]), key).select(F.lit(1).alias("__at"), key, *names)
    if layout:
        mine = review_cards(cards(pages, key, html, SETUPS[layout].item, SETUPS[layout].fields), source, subject)
        has = lambda c: F.col(c) if c in mine.columns else F.lit(None).cast("string")
        shown = mine.select(F.lit(0).alias("__at"), key, *[(F.nullif(F.col(c), F.lit(0.0)) if c == "rating_raw" else has(c)).alias(c) for c in names])
        if layout == "article":  # a page of its own, where it is one
            shown = shown.where(F.length("text") > 200)
        out = shown.unionByName(out)
    out = out.withColumns({"source": F.lit(source), "subject_type": F.lit(subject), "source_url": F.col(key)})
    # Of a review that both hold, the shown one.
    return keep_best(out.where(F.length("text") >= 15), [key, F.substring("text", 1, 120), F.coalesce("author", F.lit(""))], ["__at", "title", "text"]).drop("__at")


def page_summaries(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, average_rating, pct_recommend, distribution, total_reviews): what a page itself shows of its ratings, or else what its structured data say."""
    from stemma.operators.dedupe import keep_best
    from stemma.sources import jsonld

    rows = cards(pages, key, html, "rating-chart__row", {"star": "rating-chart__rating", "count": "rating-chart__review-count"})
    shown = pages.select(key, published_average(T.strip_html(F.col(html))).alias("a")).join(star_summary(rows, key), key, "left").select(key, "a.average_rating", "a.pct_recommend", "distribution", F.col("total_reviews").cast("int").alias("total_reviews"))
    shown = shown.where("average_rating is not null or distribution is not null")
    found = jsonld.nodes(pages, key, html, ["Product"]).where(F.try_variant_get("node", "$.aggregateRating", "variant").isNotNull())
    first = keep_best(found, [key], ["path"])
    told = jsonld.summaries(first, key).select(key, "average_rating", F.lit(None).cast("double").alias("pct_recommend"), F.lit(None).cast("map<string,bigint>").alias("distribution"), "total_reviews")
    return shown.unionByName(told.join(shown.select(key), key, "left_anti"))
