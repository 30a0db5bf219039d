"""Every registered catalogue query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from stemma.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v.isoformat() if hasattr(v, "isoformat") else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    got = rows(df.columns, df.collect())
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert got == rows(want.columns, want.fetchall())
    else:
        assert got[1]


def best_by_hand(target, products):
    """The best candidate of a name, by the rules in words: rare tokens, the forty that share most of them, the standard library's ratio, ties by tokens then key."""
    from difflib import SequenceMatcher

    tokens = {k: {t for t in slug.split(" ") if len(t) > 2} for k, slug in products.items()}
    counts = {}
    for mine in tokens.values():
        for t in mine:
            counts[t] = counts.get(t, 0) + 1
    rare = {t for t, n in counts.items() if n <= max(20, len(products) // 20)}
    shared = {k: len({t for t in target.split(" ") if len(t) > 2} & mine & rare) for k, mine in tokens.items()}
    ranked = sorted(((-n, k) for k, n in shared.items() if n))[:40]
    scored = [(-SequenceMatcher(None, target, products[k]).ratio(), n, k) for n, k in ranked]
    return min(scored, default=None)


def test_fuzzy_links_by_hand(spark):
    from stemma.plans.queries import _review_names, _unique_products

    products = {r.product_key: r.slug for r in _unique_products(spark, DIR).select("product_key", "slug").collect()}
    reviews = {r.review_key: r.slug for r in _review_names(spark, DIR).collect()}
    want = {}
    for key, slug in reviews.items():
        best = best_by_hand(slug, products)
        if best and math.floor(-best[0] * 10_000 + 0.5) / 10_000 >= 0.86:
            want[key] = (best[2], -best[1], math.floor(-best[0] * 10_000 + 0.5) / 10_000)
    got = {r.review_key: (r.product_key, r.overlap, r.match_score) for r in QUERIES["fuzzy_link_ratio"](spark, DIR).collect()}
    assert len(want) > 20 and got == want


def test_links_and_queue_by_hand(spark):
    from stemma.plans.queries import _review_names, _unique_products

    rows = _unique_products(spark, DIR).collect()
    products, vintages = {r.product_key: r.slug for r in rows}, {r.product_key: r.vintage for r in rows}
    exact = {}
    for r in sorted(rows, key=lambda r: r.ord):
        exact.setdefault(r.slug, r.product_key)
    want = {}
    for r in _review_names(spark, DIR).collect():
        if r.subject_type == "retailer":
            continue
        if r.slug and r.slug in exact:
            want[r.review_key] = (exact[r.slug], 1.0, None)
            continue
        best = best_by_hand(r.slug, products)
        if not best:
            want[r.review_key] = (None, None, "no candidate")
            continue
        key, score = best[2], math.floor(-best[0] * 10_000 + 0.5) / 10_000
        conflict = r.vintage and vintages[key] and r.vintage != vintages[key]
        want[r.review_key] = (key, score, "vintage conflict" if conflict else "below threshold" if score < 0.86 else None)
    got = {r.review_key: (r.product_key, r.match_score, r.match_reason) for r in QUERIES["link_reviews"](spark, DIR).collect()}
    assert got == want


def test_aliases_are_closed(spark):
    """What the barcode step leads to, the volume step may not lead away from a key that is kept."""
    from stemma.operators import resolve

    rows = [("a", "s", None, None, 1), ("b", "s", 750, "g", 2), ("c", "t", 700, "g", 0), ("d", "t", None, None, 3), ("e", "u", None, "h", 5), ("f", "u", 375, None, 6), ("i", "v", None, "h", 4)]
    df = spark.createDataFrame(rows, "product_key string, slug string, volume_ml int, gtin string, ord int")
    alias = {r.product_key: r.canonical_key for r in resolve.merge_products(df, "slug", ["ord"]).collect()}
    assert alias == {"b": "c", "d": "c", "e": "i"}
    assert not set(alias) & set(alias.values())


def test_aliases_lead_to_the_end(spark):
    """Chains of any length, keys with several barcodes, and circles."""
    from stemma.operators import resolve

    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(37)]
    circle = [("x1", "x2"), ("x2", "x3"), ("x3", "x1"), ("w", "x3"), ("a0", "w"), ("p", "q"), ("q", "p"), ("s", "s")]
    got = {r.product_key: r.canonical_key for r in resolve.followed(spark.createDataFrame(chain + circle, resolve.ALIAS)).collect()}
    assert got == {k: "c037" for k, _ in chain} | {"x2": "x1", "x3": "x1", "w": "x1", "a0": "x1", "q": "p"}
    rows = [("k1", "s", None, "g1", 2), ("k3", "t", None, "g1", 1), ("k3", "t", None, "g2", 4), ("k4", "u", None, "g2", 3)]
    df = spark.createDataFrame(rows, "product_key string, slug string, volume_ml int, gtin string, ord int")
    assert {r.product_key: r.canonical_key for r in resolve.merge_products(df, "slug", ["ord"]).collect()} == {"k1": "k4", "k3": "k4"}


def all_candidates(left, products, cutoff, k):
    counts = {}
    sets = {p: {t for t in s.split(" ") if len(t) > 2} for p, s in products}
    for mine in sets.values():
        for t in mine:
            counts[t] = counts.get(t, 0) + 1
    rare = {t for t, n in counts.items() if n <= cutoff}
    out = set()
    for r, s in left:
        mine = {t for t in (s or "").split(" ") if len(t) > 2} & rare
        shared = sorted((-len(mine & x), p) for p, x in sets.items() if mine & x)
        out |= {(r, p, -n) for n, p in shared[:k]}
    return out


@pytest.mark.parametrize(("short", "combined", "k"), [(200, 8, 40), (3, 8, 5), (3, 2, 5), (1, 1, 2), (0, 3, 7)])
def test_candidates_by_hand(spark, monkeypatch, short, combined, k):
    """Lists read whole, sets of tokens, and names of too many tokens on either side give the same rows."""
    import random

    from stemma.operators import similarity

    monkeypatch.setattr(similarity, "SHORT", short)
    monkeypatch.setattr(similarity, "COMBINED", combined)
    r = random.Random(4)
    words = [f"tok{i}" for i in range(14)]
    name = lambda most: " ".join(r.choice(words[: r.randint(2, 14)]) for _ in range(r.randint(0, most)))
    products = [(f"p{i:03}", name(6)) for i in range(150)]
    left = [(f"r{i}", name(5)) for i in range(60)] + [("n", None), ("copy1", products[3][1]), ("copy2", products[3][1]), ("all", " ".join(words))]
    postings = similarity.token_postings(spark.createDataFrame(products, "product_key string, slug string"), cutoff=70)
    got = similarity.candidates(spark.createDataFrame(left, "review_key string, slug string"), postings, k)
    assert {tuple(x) for x in got.collect()} == all_candidates(left, products, 70, k)


def test_best_by_letters_first(spark):
    """Of pairs that letters rule out none would have been the best."""
    import random
    from difflib import SequenceMatcher

    from stemma.operators import similarity

    r = random.Random(8)
    text = lambda: " ".join("".join(r.choice("abcdefé1") for _ in range(r.randint(1, 5))) for _ in range(3))
    rows = [(slug, f"p{j}", 1, text()) for slug in [text() for _ in range(25)] for j in range(12)]
    rows += [("same", "p1", 1, "same"), ("same", "p0", 1, "same"), ("", "p0", 1, "")]
    df = spark.createDataFrame(rows, "slug string, product_key string, overlap int, candidate string").withColumns({"mine": similarity.letter_counts(F.col("slug")), "theirs": similarity.letter_counts(F.col("candidate"))})
    kept = {(x.slug, x.product_key) for x in similarity.scorable(df, 0.0).collect()}
    assert len(kept) < len(rows)
    for slug in {x[0] for x in rows}:
        scores = {p: SequenceMatcher(None, slug, c).ratio() for s, p, _, c in rows if s == slug}
        assert {p for p, v in scores.items() if v == max(scores.values())} <= {p for s, p in kept if s == slug}
    bound = similarity.ratio_bound(similarity.letter_counts(F.col("slug")), similarity.letter_counts(F.col("candidate")))
    assert all(SequenceMatcher(None, x.slug, x.candidate).quick_ratio() == pytest.approx(x.b) or "é" in x.slug + x.candidate for x in df.withColumn("b", bound).collect())


def test_linked_and_queued_are_all(spark):
    from stemma.plans.queries import _review_names

    mine = _review_names(spark, DIR).where("coalesce(subject_type, 'product') <> 'retailer'").count()
    assert QUERIES["link_reviews"](spark, DIR).count() == mine
