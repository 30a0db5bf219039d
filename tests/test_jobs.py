import json

from pyspark.sql import functions as F

from stemma.__main__ import main
from stemma.sources import cards


def test_cards(spark):
    page = '<h1>N</h1><div class="review-card x"><p class="t">Good &amp; red</p><span class="d"> Very nice <b>indeed</b>. Read more</span><i class="star on"></i><i class="star on"></i><i class="star"></i><a class="l" href="/u?1">x</a></div><div class="review-card"><p class="t">Empty</p></div>'
    df = spark.createDataFrame([("p", page), ("q", None)], "k string, html string")
    got = cards.cards(df, "k", "html", "review-card", {"title": "t", "text": "d", "rating": "star.on#", "href": "l@href"})
    rows = got.orderBy("position").collect()
    assert [tuple(r) for r in rows] == [("p", 0, "Good & red", "Very nice indeed. Read more", "2", "/u?1"), ("p", 1, "Empty", None, None, None)]
    r = cards.review_cards(got, "s").collect()
    assert len(r) == 1 and r[0].text == "Very nice indeed." and r[0].rating_raw == 2.0


def test_site_reviews(spark):
    ld = '<script type="application/ld+json">{"@type":"Review","name":"LD","reviewBody":"A review that only the data hold.","author":{"name":"Z"},"reviewRating":{"ratingValue":"4","bestRating":"5"}}</script>'
    pages = {
        "cards": '<div class="review-card"><b class="review-card__title">T</b><i class="review-card__sdesc">A</i><p class="review-card__ldesc">A text that is long enough. Read more</p><u class="rating-icon checked"></u><u class="rating-icon checked"></u><u class="rating-icon"></u></div>',
        "activity": '<div class="item"><a class="user">A</a><a class="beer">Pale</a><p class="comment-text">A text that is long enough.</p><div data-rating="3.75"></div><time datetime="2025-01-02">x</time></div>',
        "service": '<article data-service-review-card-paper="true"><h2 data-service-review-title-typography="x">T</h2><span data-consumer-name-typography="y">A</span><img alt="Rated 4 out of 5"><p data-service-review-text-typography="z">A text that is long enough.</p></article>',
        "property": '<div itemprop="review"><span itemprop="author">A</span><b itemprop="name">T</b><meta itemprop="ratingValue" content="2"><p itemprop="reviewBody">A text that is long enough.</p></div>',
    }
    want = {"cards": (2.0, "T"), "activity": (3.75, None), "service": (4.0, "T"), "property": (2.0, "T")}
    for layout, page in pages.items():
        df = spark.createDataFrame([("p", f"<html>{page}{page}{ld}</html>"), ("q", None)], "k string, html string")
        got = {r.author: r for r in cards.site_reviews(df, "k", "html", "s", layout).collect()}
        assert set(got) == {"A", "Z"} and (got["A"].rating_raw, got["A"].title) == want[layout] and got["A"].text == "A text that is long enough."
        assert got["Z"].rating_raw == 4.0 and got["A"].subject_type == ("retailer" if layout in ("service", "property") else "product")
    long = "Words about it. " * 20
    df = spark.createDataFrame([("p", f'<html><h1>Head</h1><div class="article-body"><p>{long}</p></div></html>'), ("q", '<html><h1>H</h1><div class="article-body">Short.</div></html>')], "k string, html string")
    assert [(r.k, r.title, r.text) for r in cards.site_reviews(df, "k", "html", "s", "article").collect()] == [("p", "Head", long.strip())]


def test_page_summaries(spark):
    ld = '<script type="application/ld+json">{"x":{"@type":"Product","name":"N","aggregateRating":{"ratingValue":"4.5","reviewCount":"12"}}}</script>'
    chart = "".join(f'<div class="rating-chart__row"><span class="rating-chart__rating">{s}</span><span class="rating-chart__review-count">{n}</span></div>' for s, n in ((5, "1,000"), (4, "20")))
    rows = [("both", f"<p>Average customer rating: 4.6 and 91% of reviewers would recommend</p>{chart}{ld}"), ("data", ld), ("none", "<p>x</p>")]
    got = {r.k: r for r in cards.page_summaries(spark.createDataFrame(rows, "k string, html string"), "k", "html").collect()}
    assert set(got) == {"both", "data"}
    assert (got["both"].average_rating, got["both"].pct_recommend, got["both"].distribution, got["both"].total_reviews) == (4.6, 91.0, {"5": 1000, "4": 20}, 1020)
    assert (got["data"].average_rating, got["data"].total_reviews) == (4.5, 12)


def test_star_summary(spark):
    df = spark.createDataFrame([("p", "5", "1,200"), ("p", "4", "30")], "k string, star string, count string")
    r = cards.star_summary(df, "k").first()
    assert r.distribution == {"5": 1200, "4": 30} and r.total_reviews == 1230
    again = spark.createDataFrame([("p", 0, "5", "9"), ("p", 1, "5", "3"), ("p", 2, "4", "1")], "k string, position int, star string, count string")
    assert cards.star_summary(again, "k").first().distribution == {"5": 3, "4": 1}
    x = spark.createDataFrame([("Average customer rating: 4.6 and 91% of reviewers would recommend",)], "t string").select(cards.published_average(F.col("t")).alias("a")).first()["a"]
    assert (x.average_rating, x.pct_recommend) == (4.6, 91.0)


def test_resolve_and_queue(spark, tmp_path):
    lines = [
        {"record_type": "product", "product_key": "a", "name": "Bin 389 Cabernet", "brand": "Maker", "volume_ml": 750, "gtin": "93101234"},
        {"record_type": "product", "product_key": "b", "name": "Bin 389 Cabernet", "brand": "Maker"},
        {"record_type": "product", "product_key": "c", "name": "Other Thing Entirely", "brand": "X", "gtin": "93101234"},
        {"record_type": "offer", "product_key": "b", "retailer": "r1", "url": "https://s/product/1?x", "price_aud": 50.0, "pack_size": 1, "aggregate_review_count": 300, "scraped_at": "2026-01-01"},
        {"record_type": "offer", "product_key": "c", "retailer": "r2", "url": "https://s/product/2", "price_aud": 60.0, "pack_size": 1, "aggregate_review_count": 5, "scraped_at": "2026-01-01"},
        {"record_type": "review", "review_key": "r", "source": "s", "product_name_raw": "Maker Bin 389 Cabernet 750ml", "text": "a long enough text", "rating_norm": 0.9},
        {"record_type": "review", "review_key": "q", "source": "s", "product_name_raw": "Nothing of the kind", "text": "another long enough text"},
        {"record_type": "review_summary", "source_url": "https://s/product/1", "average_rating_norm": 0.8, "total_reviews": 300},
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "all.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    main(["resolve", "--records", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--year", "2026"])
    cat = spark.read.json(str(tmp_path / "out" / "catalogue")).collect()
    assert len(cat) == 1 and cat[0].product_key == "a" and cat[0].offer_count == 2 and cat[0].review_count == 1
    assert cat[0].compare_spread_pct == 20.0 and cat[0].site_review_count == 300
    assert spark.read.json(str(tmp_path / "out" / "unlinked_reviews")).count() == 1
    assert [x["product_key"] for x in json.loads((tmp_path / "out" / "catalogue.json").read_text())] == ["a"]
    main(["queue", "--catalogue", str(tmp_path / "out" / "catalogue"), "--out", str(tmp_path / "queue"), "--min-reviews", "10"])
    q = spark.read.json(str(tmp_path / "queue")).collect()
    assert [(x.url, x.expected_reviews, x.max_reviews) for x in q] == [("https://s/product/1", 300, 50)]


def test_listing(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("# x\nhttps://s/a | pages=2\nhttps://s/b\n")
    main(["listing", "--seeds", str(tmp_path / "seeds.txt"), "--out", str(tmp_path / "q")])
    assert spark.read.json(str(tmp_path / "q")).count() == 3
    (tmp_path / "done.json").write_text('{"url": "https://s/b"}\n')
    main(["listing", "--seeds", str(tmp_path / "seeds.txt"), "--out", str(tmp_path / "q2"), "--keep-progress", str(tmp_path / "done.json")])
    assert {r.url for r in spark.read.json(str(tmp_path / "q2")).collect()} == {"https://s/a", "https://s/a?page=2"}


def test_reviews(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [
        {"url": f"u{k}", "product_name": "P", "TotalReviewCount": n, "OverallRating": 4.0, "RatingDistribution": [{"RatingValue": 5, "Count": n}], "Reviews": [{"LongDesc": f"A text that is long enough, number {i}.", "Name": "N", "Rating": 5.0, "DateSubmitted": f"{1 + i % 28} June 2025"} for i in range(n)]}
        for k, n in (("a", 30), ("b", 5), ("c", 1))
    ]
    (tmp_path / "in" / "p.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    for flags, want in (([], {"ua": 20, "ub": 5, "uc": 1}), (["--full"], {"ua": 30, "ub": 5, "uc": 1}), (["--cap", "3", "--limit", "2"], {"ua": 3, "ub": 3})):
        out = str(tmp_path / "-".join(["out", *flags]))
        main(["reviews", "--payloads", str(tmp_path / "in"), "--out", out, "--as-of", "2026-01-01", "--source", "s", *flags])
        got = {r.source_url: r.n for r in spark.read.json(f"{out}/review").groupBy("source_url").agg(F.count("*").alias("n")).collect()}
        assert got == want and spark.read.json(f"{out}/review_summary").count() == len(want)


def test_watch(spark, tmp_path):
    (tmp_path / "log.json").write_text("".join(json.dumps({"target": t, "ts": f"2026-01-01T00:0{m}:00Z", "kind": k, "n": n}) + "\n" for t, m, k, n in (("a", 0, "enqueue", 0), ("a", 1, "handout", 0), ("a", 2, "done", 7), ("b", 0, "enqueue", 0))))
    for minute in (1, 3, 4):
        main(["watch", "--events", str(tmp_path / "log.json"), "--out", str(tmp_path / "progress"), "--as-of", f"2026-01-01T00:0{minute}:30Z"])
    got = spark.read.json(str(tmp_path / "progress")).orderBy("at").collect()
    assert [(r.total, r.done, r.remaining, r.harvested) for r in got] == [(2, 0, 2, 0), (2, 1, 1, 7), (2, 1, 1, 7)]
