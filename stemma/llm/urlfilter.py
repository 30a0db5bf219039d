"""URL filters as of the time of capture, in DataFrame functions only.

A list is a log of dated entries: a key (a host or a part of one from some dot on, or a host with leading parts of its path) is put on
a list or taken off. The log becomes validity intervals; each capture's URL is turned into the keys that could list it, and
meets the intervals of those keys that hold at its fetch time. Intervals are cut at the fixed stretches of time in which captures ask for their key, so the join is on
key and stretch with the bounds as a condition: a host with a third of all captures falls apart by time, and meets only the entries of its stretch. A
capture far out of time adds one stretch.

Nulls and the like: log rows without list, key or date are left out; a key both put on and taken off at one time is on; a capture with a null
or hostless URL, or without a time, meets nothing and passes; repeated rows come out as often as they came in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of one stretch.
STRETCH = 30 * 86400


def host(url: Column) -> Column:
    """Lower-case host without user, port, or leading www; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.nullif(F.regexp_replace(F.lower(bare), r"^www\.", ""), F.lit(""))


def keys(url: Column) -> Column:
    """All keys that could list a URL, without doubles: host suffixes of two labels or more (a host of one label by itself), and the
    host with each leading part of its path."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    prefixes = F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host(url).isNotNull(), F.array_distinct(F.concat(suffixes, prefixes)))


def intervals(log: DataFrame) -> DataFrame:
    """log(list, key, at long, added boolean) -> (list, key, since, until), until null while an entry still holds."""
    # At most one row for a key and time, combined before the shuffle, so a key's log is no longer than its distinct dates.
    log = log.dropna(subset=["list", "key", "at"]).groupBy("list", "key", "at").agg(F.coalesce(F.max("added"), F.lit(False)).alias("added"))
    order = Window.partitionBy("list", "key").orderBy("at")
    turns = log.withColumn("was", F.coalesce(F.lag("added").over(order), F.lit(False))).where("added <> was")
    return turns.withColumn("until", F.lead("at").over(order)).where("added").select("list", "key", F.col("at").alias("since"), "until")


def as_of(captures: DataFrame, spans: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """captures(id, url, fetched long, more...), spans from intervals() -> id, url, fetched, host, n_entries, lists, entry, blocked.

    entry: the longest key that lists the capture (of equally long ones the first); lists: their names, sorted, comma-joined.
    """
    ident, url, fetched = captures.columns[:3]
    caps = captures.select(F.col(ident).alias("id"), F.col(url).alias("url"), F.col(fetched).alias("fetched"))
    # Captures that are alike are judged once and come out as often as they came in.
    caps = caps.groupBy("id", "url", "fetched").agg(F.count("*").alias("copies"))
    caps = caps.withColumn("key", F.explode_outer(keys(F.col("url")))).withColumn("stretch", F.floor(F.col("fetched") / stretch))
    # Intervals are cut at those stretches alone in which a capture has their key.
    asked = caps.where("key is not null and stretch is not null").select(F.col("key").alias("listed"), F.col("stretch").alias("their_stretch")).distinct()
    held = spans.select(F.col("key").alias("listed"), "list", "since", "until")
    cut = held.join(asked, "listed").where((F.floor(F.col("since") / stretch) <= F.col("their_stretch")) & (F.col("until").isNull() | (F.col("their_stretch") * stretch < F.col("until"))))
    met = caps.join(cut, (F.col("key") == F.col("listed")) & (F.col("stretch") == F.col("their_stretch")) & (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))), "left")
    best = F.min(F.when(F.col("listed").isNotNull(), F.struct((-F.length("listed")).alias("n"), F.col("listed").alias("key"))))
    out = met.groupBy("id", "url", "fetched").agg(F.first("copies").alias("copies"), F.count("listed").alias("n_entries"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), best["key"].alias("entry"))
    out = out.withColumn("one", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return out.select(F.col("id").alias(ident), F.col("url").alias(url), F.col("fetched").alias(fetched), host(F.col("url")).alias("host"), "n_entries", "lists", "entry", (F.col("n_entries") > 0).alias("blocked"))


def dated_list(pages: DataFrame) -> DataFrame:
    """pages(page_id, url) -> a log with one dated row of each page: its host, the host without its first label, or leading parts of its path,
    put on or taken off one of three lists on a day that follows from page_id."""
    i, url = F.col("page_id"), F.col("url")
    labels = F.split(host(url), r"\.")
    every = keys(url)
    key = (
        F.when(i % 4 == 0, host(url))
        .when((i % 4 == 1) & (F.size(labels) > 3), F.array_join(F.slice(labels, F.lit(2), F.size(labels)), "."))
        .when(i % 4 == 2, F.element_at(F.filter(every, lambda k: k.contains("/")), 1))
        .otherwise(F.element_at(every, -1))
    )
    name = F.when(i % 5 < 2, "adult").when(i % 5 < 4, "malware").otherwise("spam")
    return pages.select(name.alias("list"), key.alias("key"), (F.lit(1704067200) + i * 37 % 360 * 86400).alias("at"), (i % 3 != 2).alias("added"))


def fetch_time(page_id: str = "page_id") -> Column:
    """Epoch seconds within the year of the dated list, by page_id."""
    return F.lit(1704067200) + F.col(page_id) * 101 % 360 * 86400 + F.col(page_id) * 977 % 86400
