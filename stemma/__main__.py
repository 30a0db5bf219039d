"""Jobs over landed records: ``python -m stemma JOB --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


REVIEW_PAYLOAD = (
    "url string, product_name string, Reviews array<struct<LongDesc: string, Name: string, Rating: double, Title: string, DateSubmitted: string, IsRecommended: boolean, Likes: int, SyndReviewSource: string>>, "
    "reviews_b array<struct<description: string, displayName: string, rating: double, title: string, date: string, wouldRecommend: boolean, helpful_yes: int, SourceClient: string>>, "
    "RatingDistribution array<struct<RatingValue: int, Count: bigint>>, OverallRating double, TotalReviewCount int, TotalResults int, RecommendedPercentage int, overall struct<rating: double, totalReviews: int, percentageRecommending: string>"
)


def _records(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    from stemma.schemas import KINDS
    from stemma.sources.readers import of_kind, read_records

    records = read_records(spark, path)
    return {kind: of_kind(records, kind) for kind in KINDS}


def resolve(spark: SparkSession, a) -> None:
    """Records to the catalogue and the queue of reviews that nobody could link."""
    from stemma.functions import text as T
    from stemma.operators import catalogue, dedupe, resolve as R
    from stemma.sources.sinks import write_array, write_catalogue, write_queue

    got = _records(spark, a.records)
    c = F.col
    products = R.products_by_key(got["product"], ["ord"]).withColumns({"slug": T.match_slug(c("brand"), c("name"), c("volume_ml"), c("vintage")), "__bare": T.match_slug(c("brand"), c("name"), F.lit(None).cast("int"), c("vintage"))})
    # A map of keys, read at four places.
    alias = R.merge_products(products, "__bare", ["ord"]).persist()
    kept = products.join(alias, "product_key", "left_anti")
    informative = T.informativeness(*[c(x) for x in ("member_price_aud", "was_price_aud", "promo", "in_stock", "aggregate_rating_norm")])
    offers = dedupe.dedupe_offers_resolve(R.apply_alias(got["offer"], alias), informative, ["ord"])
    reviews = dedupe.dedupe_reviews(got["review"], ["ord"]).withColumns({"slug": T.review_slug(c("product_name_raw"), a.year), "vintage": T.parse_vintage(c("product_name_raw"), a.year)}).drop("product_key", "match_score")
    linked, queue = R.link(reviews, kept, ["ord"], threshold=a.threshold)
    built = catalogue.build_catalogue(kept.drop("slug", "__bare", "record_type"), offers, linked.drop("slug", "vintage"), got["review_summary"], ["ord"])
    write_catalogue(built, f"{a.out}/catalogue")
    write_queue(queue.drop("slug"), f"{a.out}/unlinked_reviews")
    written = spark.read.schema(built.schema).json(f"{a.out}/catalogue")
    write_array(written, f"{a.out}/catalogue.json", catalogue.catalogue_order())
    catalogue.report(written).show(vertical=True)


def queue(spark: SparkSession, a) -> None:
    """Catalogue to the ranked queue of pages whose reviews to collect."""
    from stemma.operators.sampling import queue_plan, rank_queue
    from stemma.sources.sinks import write_queue

    offers = spark.read.json(a.catalogue).select("product_key", "name", F.explode("offers").alias("o")).select("product_key", "name", "o.retailer", "o.url", F.col("o.aggregate_review_count").cast("int").alias("aggregate_review_count"))
    ranked = rank_queue(offers, a.min_reviews, a.limit or None, a.retailer, tuple(a.supported), tuple(a.countless))
    write_queue(ranked, a.out)
    queue_plan(ranked).show(vertical=True)


def enrich(spark: SparkSession, a) -> None:
    """Products whose price is to be asked for."""
    from stemma.operators.sampling import missing_only
    from stemma.sources.sinks import write_queue

    got = _records(spark, a.records)
    products = got["product"].where("source_product_id is not null").select("product_key", "source_product_id").distinct()
    write_queue(missing_only(products, got["offer"]) if a.only_missing else products, a.out)


def listing(spark: SparkSession, a) -> None:
    """Seed lines to listing pages, but for those that are done if progress is kept."""
    from stemma.operators.state import resume
    from stemma.sources.readers import expand_seeds
    from stemma.sources.sinks import write_queue

    lines = spark.read.text(a.seeds, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("ord", "value"))
    pages = expand_seeds(lines, a.clicks)
    if a.keep_progress:
        pages = resume(pages, spark.read.json(a.keep_progress).select("url"), "url")
    write_queue(pages.orderBy("position"), a.out)


def reviews(spark: SparkSession, a) -> None:
    """Payloads of a review service to records: the newest reviews of the products that have most, and what the service says of each."""
    from stemma.operators.sampling import sample_newest
    from stemma.sources.adapters import api_reviews, api_summaries
    from stemma.sources.sinks import write_records

    payloads = spark.read.schema(REVIEW_PAYLOAD).json(a.payloads)
    if a.limit:
        count = F.coalesce(F.nullif("TotalReviewCount", F.lit(0)), "TotalResults", "overall.totalReviews", F.lit(0))
        payloads = payloads.orderBy(count.desc(), "url").limit(a.limit)
    found = api_reviews(payloads, a.as_of, a.source)
    newest = sample_newest(found, "source_url", [F.col("review_date").desc_nulls_last(), "review_key"], full=a.full, cap=a.cap or None)
    write_records(newest, f"{a.out}/review")
    write_records(api_summaries(payloads, a.as_of, a.source), f"{a.out}/review_summary")


def watch(spark: SparkSession, a) -> None:
    """A snapshot of a sweep's progress from its event log, and how long it has gained nothing."""
    from stemma.operators.state import lease_state, progress, stall_runs
    from stemma.sources.sinks import write_progress

    events = spark.read.schema("target string, ts timestamp, kind string, n bigint").json(a.events)
    now = progress(lease_state(events, a.as_of)).select(F.lit(a.as_of).alias("at"), "total", "done", "remaining", "harvested")
    write_progress(now, a.out)
    # The whole history is one short line of snapshots.
    seen = stall_runs(spark.read.schema(now.schema).json(a.out).withColumn("sweep", F.lit(1)), "at", "harvested", ["sweep"])
    seen.drop("sweep").orderBy(F.desc("at")).limit(a.last).show(truncate=False)


def replay(spark: SparkSession, a) -> None:
    """Archived raw batches to records, anew."""
    from stemma.streaming.ingest import replay as run

    run(spark, a.archive, a.out, a.as_of, dict(x.split("=", 1) for x in a.source))


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="stemma")
    jobs = p.add_subparsers(required=True)

    def job(f, *options):
        j = jobs.add_parser(f.__name__, help=f.__doc__)
        for flag, kind in options:
            j.add_argument(flag, **kind)
        j.set_defaults(run=f)

    need = {"required": True}
    job(resolve, ("--records", need), ("--out", need), ("--threshold", {"type": float, "default": 0.86}), ("--year", {"type": int, "required": True}))
    job(queue, ("--catalogue", need), ("--out", need), ("--min-reviews", {"type": int, "default": 1}), ("--limit", {"type": int, "default": 0}), ("--retailer", {}), ("--supported", {"nargs": "*", "default": []}), ("--countless", {"nargs": "*", "default": []}))
    job(enrich, ("--records", need), ("--out", need), ("--only-missing", {"action": "store_true"}))
    job(listing, ("--seeds", need), ("--out", need), ("--clicks", {"type": int, "default": 60}), ("--keep-progress", {"help": "JSON lines with the url of each page that is done"}))
    job(reviews, ("--payloads", need), ("--out", need), ("--as-of", need), ("--source", need), ("--full", {"action": "store_true"}), ("--cap", {"type": int, "default": 0}), ("--limit", {"type": int, "default": 0}))
    job(watch, ("--events", need), ("--out", need), ("--as-of", need), ("--last", {"type": int, "default": 10}))
    job(replay, ("--archive", need), ("--out", need), ("--as-of", need), ("--source", {"nargs": "*", "default": [], "help": "name=display"}))
    a = p.parse_args(args)
    a.run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
