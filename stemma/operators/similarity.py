"""Fuzzy matching by an inverted index: the products that share most rare tokens, found without reading long lists, and the best of them by score."""

from __future__ import annotations

from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from stemma.functions import text as T
from stemma.operators.staging import checkpointed

#: Products that a token may be in for its list to be read whole, and how many tokens of longer lists are combined.
SHORT, COMBINED = 40, 8


def token_postings(products: DataFrame, cutoff: int | None = None) -> DataFrame:
    """products(product_key, slug) -> (token, product_key), without tokens in more than max(20, products / 20) of them, which tell little."""
    products = checkpointed(products.select("product_key", "slug"))
    n = products.select(F.greatest(F.lit(20), F.floor(F.count("*") / 20)).alias("cutoff")) if cutoff is None else products.sparkSession.range(1).select(F.lit(cutoff).alias("cutoff"))
    each = products.select("product_key", F.explode(T.tokens(F.col("slug"))).alias("token"))
    # Counted before the join, map side first, so a token in all rows is one row here.
    rare = each.groupBy("token").count().join(F.broadcast(n), F.col("count") <= F.col("cutoff")).select("token")
    return each.join(rare, "token").select("token", "product_key")


def subsets(tokens: Column) -> Column:
    """Of an array of a few sorted tokens all its subsets but the empty one, as texts."""
    numbers = F.sequence(F.lit(1), F.pow(F.lit(2), F.size(tokens)).cast("int") - 1)
    return F.when(F.size(tokens) > 0, F.transform(numbers, lambda m: F.array_join(F.filter(tokens, lambda _, i: F.getbit(m, i) == 1), " ")))


def candidate_pairs(slugs: DataFrame, postings: DataFrame, k: int = 40) -> DataFrame:
    """(slug, product_key, overlap): pairs among which the k best of each slug are, by overlap and then by key.

    Lists of up to SHORT products are read whole. A product that shares only tokens of longer lists stands, with all products that have the very tokens that it shares,
    in the list of this set of tokens; if k of these come before it there, they come before it in the answer, too. So each set of tokens needs the k
    first products that have it, and pairs grow with the slugs alone. Names of over COMBINED such tokens, on either side, have too many sets; for them the lists are read whole.
    """
    # Both are read several times, and what they come from may be long.
    slugs, postings = checkpointed(slugs.select("slug")), checkpointed(postings)
    sizes = postings.groupBy("token").agg(F.count("*").alias("n"))
    posted = postings.join(sizes, "token")
    asked = slugs.select("slug", F.explode(T.tokens(F.col("slug"))).alias("token")).join(sizes, "token")
    long_ = F.col("n") > SHORT
    common = F.array_sort(F.collect_list(F.when(long_, F.col("token")))).alias("common")
    names = asked.groupBy("slug").agg(F.collect_list("token").alias("mine"), common)
    sets = posted.groupBy("product_key").agg(F.collect_list("token").alias("theirs"), common)
    few, many = F.size("common").between(1, COMBINED), F.size("common") > COMBINED
    first = Window.partitionBy("subset").orderBy("product_key")
    # The planner keeps k rows of each set before they are exchanged.
    lists = sets.where(few).select("product_key", F.explode(subsets(F.col("common"))).alias("subset")).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    pairs = [
        asked.where(~long_).join(posted.where(~long_).select("token", "product_key"), "token"),
        names.where(few).select("slug", F.explode(subsets(F.col("common"))).alias("subset")).join(lists, "subset"),
        asked.where(long_).join(sets.where(many).select("product_key", F.explode("common").alias("token")), "token"),
        names.where(many).select("slug", F.explode("common").alias("token")).join(posted.where(long_).select("token", "product_key"), "token"),
    ]
    every = pairs[0].select("slug", "product_key")
    for p in pairs[1:]:
        every = every.unionAll(p.select("slug", "product_key"))
    met = every.distinct().join(names.select("slug", "mine"), "slug").join(sets.select("product_key", "theirs"), "product_key")
    return met.select("slug", "product_key", F.size(F.array_intersect("mine", "theirs")).cast("long").alias("overlap"))


def candidates(left: DataFrame, postings: DataFrame, k: int = 40) -> DataFrame:
    """left(review_key, slug): the k products that share most tokens, ties by key. (review_key, product_key, overlap)

    Equal names are looked up once."""
    w = Window.partitionBy("slug").orderBy(F.desc("overlap"), "product_key")
    best = candidate_pairs(left.select("slug").distinct(), postings, k).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return left.select("review_key", "slug").join(best, "slug").select("review_key", "product_key", "overlap")


@F.pandas_udf(DoubleType())
def sequence_ratio(target: pd.Series, candidate: pd.Series) -> pd.Series:
    """The standard library's sequence similarity; the target comes first."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(target, candidate, strict=True)], dtype="float64")


_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def letter_counts(text: Column) -> Column:
    """How often each letter of identity strings stands in a text, and last how many other characters."""
    counts = F.transform(F.array(*map(F.lit, _LETTERS)), lambda c: F.length(text) - F.length(F.replace(text, c, F.lit(""))))
    return F.concat(counts, F.array(F.length(text) - F.aggregate(counts, F.lit(0), lambda a, c: a + c)))


def ratio_bound(target: Column, candidate: Column) -> Column:
    """Of two arrays of letter_counts: what the sequence similarity of their texts cannot exceed."""
    places = range(len(_LETTERS) + 1)
    total = reduce(add, [target[i] + candidate[i] for i in places])
    shared = reduce(add, [F.least(target[i], candidate[i]) for i in places])
    return F.when(total > 0, 2.0 * shared / total).otherwise(1.0)


def levenshtein_ratio(target: Column, candidate: Column) -> Column:
    longest = F.greatest(F.length(target), F.length(candidate))
    return F.when(longest > 0, 1 - F.levenshtein(target, candidate) / longest).otherwise(1.0)


def scorable(found: DataFrame, least: float) -> DataFrame:
    """found(slug, product_key, overlap, candidate, mine, theirs), the last two the names' letter_counts -> those that can be a slug's best by sequence similarity, with ``floor``, the
    score of the one whose letters promise most: another's letters have to allow as much, and least."""
    counted = checkpointed(found.withColumn("bound", ratio_bound(F.col("mine"), F.col("theirs"))).drop("mine", "theirs").where(F.col("bound") >= least))
    first = counted.groupBy("slug").agg(F.max_by("candidate", F.struct("bound", "overlap", "candidate")).alias("__first")).withColumn("floor", sequence_ratio("slug", "__first"))
    return counted.join(first.select("slug", "floor"), "slug").where(F.col("bound") >= F.col("floor"))


def fuzzy_link(left: DataFrame, right: DataFrame, threshold: float = 0.86, scorer: str = "ratio", k: int = 40, cutoff: int | None = None, prune: bool = False) -> DataFrame:
    """left(review_key, slug), right(product_key, slug) -> best candidate of each left row at or above the threshold: (review_key, product_key,
    overlap, match_score). Ties by overlap, then key. cutoff: products that a token may be in to tell anything, a twentieth of them unless given.
    prune: leave out pairs whose lengths alone keep them below the threshold. Equal names are matched once."""
    w = Window.partitionBy("slug").orderBy(F.desc("overlap"), "product_key")
    left, right = checkpointed(left.select("review_key", "slug")), checkpointed(right.select("product_key", "slug"))
    names = left.select("slug").distinct()
    found = candidate_pairs(names, token_postings(right, cutoff), k).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank")
    # Letters are counted once a name, not once a pair.
    theirs = right.select("product_key", F.col("slug").alias("candidate"), *([letter_counts(F.col("slug")).alias("theirs")] if scorer == "ratio" else []))
    found = found.join(theirs, "product_key")
    if prune:
        a, b = F.length("slug"), F.length("candidate")
        found = found.where(2 * F.least(a, b) >= threshold * (a + b))
    if scorer == "ratio":
        # Scores are rounded to four places before they are held against the threshold.
        found = found.join(names.withColumn("mine", letter_counts(F.col("slug"))), "slug")
        found = scorable(found, threshold - 0.00006).withColumn("raw_score", sequence_ratio("slug", "candidate"))
    else:
        found = found.withColumn("raw_score", levenshtein_ratio(F.col("slug"), F.col("candidate")))
    best = Window.partitionBy("slug").orderBy(F.desc("raw_score"), F.desc("overlap"), "product_key")
    kept = found.withColumn("rank", F.row_number().over(best)).where("rank = 1").withColumn("match_score", T.rounded(F.col("raw_score"), 4)).where(F.col("match_score") >= threshold)
    return left.select("review_key", "slug").join(kept.select("slug", "product_key", "overlap", "match_score"), "slug").select("review_key", "product_key", "overlap", "match_score")
