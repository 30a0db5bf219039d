"""Like-for-like price comparison of the retailers of a product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as T


def _usable(offers: DataFrame) -> DataFrame:
    return offers.where((F.coalesce("pack_size", F.lit(0)) != 0) & F.col("price_aud").isNotNull() & (F.coalesce("retailer", F.lit("")) != ""))


def _spread(groups: DataFrame, suspect_pct: float) -> DataFrame:
    """Of groups with entries (price, retailer): spread, cheapest, suspicion."""
    g = groups.withColumn("lo", F.array_min("entries")["price"]).withColumn("hi", F.array_max("entries")["price"])
    g = g.where("lo > 0").withColumn("compare_spread_pct", T.rounded((F.col("hi") - F.col("lo")) / F.col("lo") * 100, 1))
    g = g.withColumn("compare_cheapest", F.array_min("entries")["retailer"]).withColumn("compare_suspect", F.col("compare_spread_pct") > suspect_pct)
    return g.withColumn("compare_prices", F.map_from_entries(F.transform("entries", lambda e: F.struct(e["retailer"], e["price"]))))


def _cheapest(offers: DataFrame) -> DataFrame:
    """The least price of each retailer for each pack: all that either comparison needs. (product_key, pack_size, retailer, price)"""
    return _usable(offers).groupBy("product_key", "pack_size", "retailer").agg(F.min("price_aud").alias("price"))


def _same_pack(cheapest: DataFrame, suspect_pct: float, prefer_trusted: bool) -> DataFrame:
    packs = cheapest.groupBy("product_key", "pack_size").agg(F.collect_list(F.struct("price", "retailer")).alias("entries")).where(F.size("entries") >= 2)
    packs = _spread(packs, suspect_pct)
    # The widest spread, of equals the smallest pack.
    rank = F.struct(*([F.col("compare_suspect")] if prefer_trusted else []), -F.col("compare_spread_pct"), F.col("pack_size"))
    told = F.struct(F.lit("same_pack").alias("compare_basis"), F.col("pack_size").alias("compare_pack_size"), "compare_prices", "compare_spread_pct", "compare_cheapest", "compare_suspect")
    return packs.groupBy("product_key").agg(F.min_by(told, rank).alias("c"))


def _unit_price(cheapest: DataFrame, suspect_pct: float) -> DataFrame:
    # Rounding keeps order, so the least price of a pack gives its least price for one.
    unit = cheapest.withColumn("price", T.rounded(F.col("price") / F.col("pack_size"), 2))
    each = unit.groupBy("product_key", "retailer").agg(F.min("price").alias("price"), F.collect_set("pack_size").alias("packs"))
    whole = each.groupBy("product_key").agg(F.collect_list(F.struct("price", "retailer")).alias("entries"), F.size(F.array_distinct(F.flatten(F.collect_list("packs")))).alias("n_packs"))
    whole = _spread(whole.where("size(entries) > 1 and n_packs > 1"), suspect_pct)
    return whole.select("product_key", F.struct(F.lit("unit_price").alias("compare_basis"), F.lit(None).cast("int").alias("compare_pack_size"), "compare_prices", "compare_spread_pct", "compare_cheapest", "compare_suspect").alias("c"))


def compare_same_pack(offers: DataFrame, suspect_pct: float = 150, prefer_trusted: bool = False) -> DataFrame:
    """Of the packs that two retailers or more sell, that with the widest spread (the smallest of equals)."""
    return _same_pack(_cheapest(offers), suspect_pct, prefer_trusted).select("product_key", "c.*")


def compare_unit_price(offers: DataFrame, suspect_pct: float = 150) -> DataFrame:
    """Prices for one, where there are several retailers and several packs."""
    return _unit_price(_cheapest(offers), suspect_pct).select("product_key", "c.*")


def compare_offers(offers: DataFrame, suspect_pct: float = 150, prefer_trusted: bool = False) -> DataFrame:
    """A row for every product: the same-pack comparison, else that by unit, else an empty one.

    Offers are scanned and exchanged once: keys ride along as groups without a retailer, and what follows works on least prices, already dealt by product.
    """
    c = F.col
    usable = (F.coalesce("pack_size", F.lit(0)) != 0) & c("price_aud").isNotNull() & (F.coalesce("retailer", F.lit("")) != "")
    least = offers.select("product_key", F.when(usable, c("pack_size")).alias("pack_size"), F.when(usable, c("retailer")).alias("retailer"), F.when(usable, c("price_aud")).alias("price_aud"))
    least = least.groupBy("product_key", "pack_size", "retailer").agg(F.min("price_aud").alias("price"))
    every = least.groupBy("product_key").agg(F.collect_list(F.when(c("retailer").isNotNull(), F.struct("pack_size", "price", "retailer"))).alias("e"))
    pick = lambda entries: F.struct(F.array_min(entries)["price"].alias("lo"), F.array_max(entries)["price"].alias("hi"), F.array_min(entries)["retailer"].alias("cheapest"), entries.alias("entries"))
    packs = F.transform(F.array_distinct(F.transform("e", lambda x: x["pack_size"])), lambda p: F.struct(p.alias("pack"), F.transform(F.filter("e", lambda x: x["pack_size"] == p), lambda x: F.struct(x["price"].alias("price"), x["retailer"].alias("retailer"))).alias("entries")))
    same = F.transform(F.filter(packs, lambda g: F.size(g["entries"]) >= 2), lambda g: F.struct(g["pack"].alias("pack"), pick(g["entries"]).alias("x")))
    each = F.transform("e", lambda x: F.struct(T.rounded(x["price"] / x["pack_size"], 2).alias("price"), x["retailer"].alias("retailer")))
    shops = F.array_distinct(F.transform("e", lambda x: x["retailer"]))
    unit = F.transform(shops, lambda r: F.struct(F.array_min(F.filter(c("each"), lambda x: x["retailer"] == r))["price"].alias("price"), r.alias("retailer")))
    spread = lambda x: T.rounded((x["hi"] - x["lo"]) / x["lo"] * 100, 1)
    out = every.withColumn("each", each).withColumns({"same": F.filter(same, lambda g: g["x"]["lo"] > 0), "unit": pick(unit)})
    suspect = [lambda g: spread(g["x"]) > suspect_pct] if prefer_trusted else []
    ranked = F.transform("same", lambda g: F.struct(*[f(g).alias("s") for f in suspect], (-spread(g["x"])).alias("n"), g["pack"].alias("pack"), g["x"].alias("x")))
    many = (F.size(c("unit.entries")) > 1) & (F.size(F.array_distinct(F.transform("e", lambda x: x["pack_size"]))) > 1) & (c("unit.lo") > 0)
    best = F.when(F.size("same") > 0, F.array_min(ranked)).alias("best")
    out = out.select("product_key", best, F.when(many, c("unit")).alias("unit")).withColumn("x", F.coalesce("best.x", "unit"))
    found = F.when(c("best").isNotNull(), "same_pack").when(c("unit").isNotNull(), "unit_price")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    prices = F.coalesce(F.map_from_entries(F.transform("x.entries", lambda e: F.struct(e["retailer"], e["price"]))), empty)
    return out.select(
        "product_key", found.alias("compare_basis"), c("best.pack").alias("compare_pack_size"), prices.alias("compare_prices"), spread(c("x")).alias("compare_spread_pct"), c("x.cheapest").alias("compare_cheapest"),
        F.coalesce(spread(c("x")) > suspect_pct, F.lit(False)).alias("compare_suspect"),
    )


def prices_text(prices: str = "compare_prices"):
    """The map as sorted retailer=price pairs, for flat outputs."""
    return F.array_join(F.transform(F.array_sort(F.map_keys(prices)), lambda k: F.concat(k, F.lit("="), F.format_string("%.2f", F.element_at(prices, k)))), ";")
