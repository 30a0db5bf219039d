"""Work queues' state from their event log, and what watches over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.operators.order import numbered, stall_runs  # noqa: F401


def lease_state(events: DataFrame, as_of, timeout_s: int = 180, max_attempts: int = 5) -> DataFrame:
    """events(target, ts, kind, n): kinds enqueue, handout, partial, done, fail. -> target, attempts, partial, done, harvested, in_flight, eligible.

    A hand-out is in flight until timeout_s after it or the last partial delivery since; done closes it and adds up what came. A fail
    frees the target at once. eligible: may be handed out at as_of.
    """
    e = events.where(F.col("ts") <= F.lit(as_of).cast("timestamp"))
    last = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("ts")))
    out = e.groupBy("target").agg(
        F.count_if(F.col("kind") == "handout").alias("attempts"), last("handout").alias("handed"), last("partial").alias("delivered"), last("done").alias("finished"), last("fail").alias("failed"),
        F.coalesce(F.sum(F.when(F.col("kind").isin("partial", "done"), F.col("n"))), F.lit(0)).alias("came"),
    )
    alive = F.greatest("handed", F.when(F.col("delivered") >= F.col("handed"), F.col("delivered")))
    fresh = alive > F.lit(as_of).cast("timestamp") - F.make_interval(secs=F.lit(timeout_s))
    freed = F.coalesce(F.col("failed") >= alive, F.lit(False)) | F.coalesce(F.col("finished") >= F.col("handed"), F.lit(False))
    out = out.withColumn("done", F.col("finished").isNotNull()).withColumn("in_flight", F.coalesce(fresh & ~freed & F.col("finished").isNull(), F.lit(False)))
    return out.select("target", "attempts", F.col("came").alias("harvested"), "done", "in_flight", (~F.col("done") & ~F.col("in_flight") & (F.col("attempts") < max_attempts)).alias("eligible"))


def next_target(state: DataFrame, queue: DataFrame) -> DataFrame:
    """queue(target, position): the first that may be handed out."""
    return queue.join(state, "target", "left").where(F.coalesce("eligible", F.lit(True))).orderBy("position", "target").limit(1).select("target", "position")


def hand_out(state: DataFrame, queue: DataFrame, requests: DataFrame, asked: list) -> DataFrame:
    """queue(target, position), requests in the order of ``asked``, which are waiting at once: the n-th of them gets the n-th target that may be handed out, so no
    target goes out twice; requests beyond the last such target get none and are left out."""
    free = queue.join(state, "target", "left").where(F.coalesce("eligible", F.lit(True))).select("target", "position")
    served = numbered(requests, asked, "__n").join(numbered(free, ["position", "target"], "__n"), "__n")
    return served.select(*requests.columns, "target", "position")


def requeue(state: DataFrame) -> DataFrame:
    """Unfinished targets start afresh."""
    open_ = ~F.col("done")
    return state.withColumn("attempts", F.when(open_, 0).otherwise(F.col("attempts"))).withColumn("in_flight", F.when(open_, False).otherwise(F.col("in_flight"))).withColumn("eligible", open_)


def stalled(targets: DataFrame, done: DataFrame, tried: DataFrame) -> DataFrame:
    """Targets that are not done though they were handed out or tried."""
    return targets.join(done.select("target"), "target", "left_anti").join(tried.select("target"), "target", "left_semi")


def resume(targets: DataFrame, done: DataFrame, key: str = "target") -> DataFrame:
    return targets.join(done.select(key), key, "left_anti")


def find_listing(reports: DataFrame, column: str, targets: DataFrame) -> DataFrame:
    """reports(column), targets(url, position) -> reports with url and position of the target that each tells of: that of the very address, or else one
    without a query whose path it is; null where there is neither."""
    path = F.split_part(F.col(column), F.lit("?"), F.lit(1))
    exact = targets.select(F.col("url").alias("__same"), F.col("url").alias("__u1"), F.col("position").alias("__p1"))
    bare = targets.where(~F.col("url").contains("?")).select(F.col("url").alias("__path"), F.col("url").alias("__u2"), F.col("position").alias("__p2"))
    met = reports.join(exact, F.col(column) == F.col("__same"), "left").join(bare, path == F.col("__path"), "left")
    return met.select(*reports.columns, F.coalesce("__u1", "__u2").alias("url"), F.coalesce("__p1", "__p2").alias("position"))


def mark_by_path(reports: DataFrame, targets: DataFrame) -> DataFrame:
    """reports(url, n, kind: partial or done), targets(url, position) -> url, position, harvested, done of the targets told of. Queries of addresses
    don't count; of targets that share a path the first takes it all."""
    path = F.split_part("url", F.lit("?"), F.lit(1))
    first = targets.groupBy(path.alias("__path")).agg(F.min_by(F.struct("url", "position"), "position").alias("t"))
    came = reports.groupBy(path.alias("__path")).agg(F.sum("n").cast("long").alias("harvested"), F.bool_or(F.col("kind") == "done").alias("done"))
    return first.join(came, "__path").select("t.url", "t.position", "harvested", "done")


def url_or_default(codes: DataFrame, known: DataFrame, key: str, prefix: str) -> DataFrame:
    """codes(key), known(key, url): the known address, or one made of prefix and code."""
    return codes.join(known, key, "left").withColumn("url", F.coalesce("url", F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit("/"))))


def progress(state: DataFrame) -> DataFrame:
    return state.agg(F.count("*").alias("total"), F.count_if("done").alias("done"), F.greatest(F.lit(0), F.count("*") - F.count_if("done")).alias("remaining"), F.coalesce(F.sum("harvested"), F.lit(0)).alias("harvested"))


def idle_sessions(events: DataFrame, key: str, ts: str, gap: str | Column, late: str | None = None) -> DataFrame:
    """Stretches of activity that gaps part; end: when the gap after the last event is over. gap: a duration, or an expression that gives each event's own.

    Of a stream, late says how far its events may lie behind the latest: a stretch comes out, once, when nothing more can be part of it, which is the sign that its
    key has been silent; events that come later than that are left out."""
    events = events.withWatermark(ts, late) if late else events
    return events.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("events")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def silence(listing: Column) -> Column:
    """How long a target may be silent: 900 seconds while a list is being opened, else 240."""
    return F.when(listing, "900 seconds").otherwise("240 seconds")


def returned_difference(requested: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    """How many different keys were asked for and did not come back."""
    return requested.select(key).distinct().join(returned.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("missing"))
