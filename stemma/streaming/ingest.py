"""Incremental twins: batches of raw files to records, each key once by state with a time to live, keyed lease state, and rows of what queries report."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from stemma.functions.text import category_from_url
from stemma.operators.dedupe import keep_best
from stemma.schemas import KINDS, RAW_BATCH, REVIEW_SUMMARY, conform
from stemma.sources.adapters import parse_products, parse_reviews, summary_columns


def landing(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """Raw batches as they land, one JSON document to a file."""
    return spark.readStream.schema(RAW_BATCH).option("multiLine", True).option("maxFilesPerTrigger", per_trigger).json(path)


def _items(batches: DataFrame, column: str) -> DataFrame:
    """Payloads of raw batches, ord from a batch's time and address and the place in it."""
    stamped = batches.withColumn("__id", F.struct(F.coalesce("captured_at", F.lit("")).alias("at"), F.coalesce("url", F.lit("")).alias("url")))
    return stamped.select("__id", "listing_url", F.posexplode(column).alias("__at", "x")).select(F.struct("__id", "__at").alias("ord"), F.coalesce("listing_url", F.lit("")).alias("__listing"), "x.*")


def parsed_records(batches: DataFrame, as_of: str, names: dict[str, str]) -> dict[str, DataFrame]:
    """All records of raw batches as they come, with __ord; for a stream or a table."""
    products, offers = parse_products(_items(batches, "products"), as_of, names, url_hint=category_from_url(F.col("__listing")))
    told = batches.where("review_summary is not null").select(F.struct(F.struct(F.coalesce("captured_at", F.lit("")).alias("at"), F.coalesce("url", F.lit("")).alias("url")).alias("__id"), F.lit(0).alias("__at")).alias("__ord"), "review_summary.*")
    summaries = conform(summary_columns(told, as_of), REVIEW_SUMMARY + ", __ord " + told.schema["__ord"].dataType.simpleString())
    return {"product": products, "offer": offers, "review": parse_reviews(_items(batches, "reviews"), as_of), "review_summary": summaries}


#: What makes a record the same as one that came before.
KEYS = {"product": ["product_key"], "offer": ["product_key", "retailer", "price_aud", "member_price_aud", "day"], "review": ["review_key"], "review_summary": ["source_url", "scraped_at"]}


def records_of(batches: DataFrame, as_of: str, names: dict[str, str]) -> dict[str, DataFrame]:
    """All records of raw batches, the first of each key; the same for a replay or everything at once as for a stream."""
    found = parsed_records(batches, as_of, names)
    return {kind: keep_best(df.withColumn("day", F.substring("scraped_at", 1, 10)), KEYS[kind], ["__ord"]).drop("day", "__ord") for kind, df in found.items()}


#: Keys are dealt to so many groups of state a kind of record.
SHARDS = 64
_SEEN = "kind string, value string"


class FirstSeen(StatefulProcessor):
    """Rows (kind, shard, key, at, url, place, value): the first of each key, by time, address and place within a batch. Each key that has come is kept in a map with a time to live, so
    the state holds the keys of one horizon and no more."""

    def __init__(self, horizon_s: int):
        self.horizon_ms = horizon_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "key string", "at string", ttlDurationMs=self.horizon_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows)).sort_values(["at", "url", "place"], kind="stable").drop_duplicates("key")
        came = came[[not self.seen.containsKey((k,)) for k in came["key"]]]
        for k, at in zip(came["key"], came["at"], strict=True):
            self.seen.updateValue((k,), (at,))
        yield came[["kind", "value"]]

    def close(self) -> None:
        pass


def new_records(stream: DataFrame, as_of: str, names: dict[str, str], horizon_s: int = 30 * 86400) -> DataFrame:
    """Records of a stream of raw batches as (kind, value), value the record's JSON: each key once within the horizon, by state of a row a key. Needs the RocksDB state store."""
    rows = None
    for kind, df in parsed_records(stream, as_of, names).items():
        df = df.withColumn("day", F.substring("scraped_at", 1, 10))
        key = F.md5(F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in KEYS[kind]])))
        value = F.to_json(F.struct(*[c for c in df.columns if c not in ("__ord", "day")]))
        each = df.select(F.lit(kind).alias("kind"), key.alias("key"), F.col("__ord.__id.at").alias("at"), F.col("__ord.__id.url").alias("url"), F.col("__ord.__at").alias("place"), value.alias("value"))
        rows = each if rows is None else rows.unionByName(each)
    return first_of(rows, horizon_s)


def first_of(rows: DataFrame, horizon_s: int) -> DataFrame:
    """Rows (kind, key, at, url, place, value) of a stream -> (kind, value), each key of a kind once within the horizon."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(SHARDS)))
    return dealt.groupBy("kind", "shard").transformWithStateInPandas(FirstSeen(horizon_s), outputStructType=_SEEN, outputMode="Append", timeMode="ProcessingTime")


def ingest(stream: DataFrame, out: str, checkpoint: str, as_of: str, names: dict[str, str], horizon_s: int = 30 * 86400) -> StreamingQuery:
    """Writes new records below out/kind=..., by the file sink's own log, so a batch that runs again adds nothing twice. ``ingested`` reads them."""
    found = new_records(stream, as_of, names, horizon_s)
    return found.writeStream.partitionBy("kind").format("text").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def ingested(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """What the stream has committed of one kind of record."""
    lines = spark.read.format("text").load(out).where(F.col("kind") == kind)
    return lines.select(F.from_json("value", KINDS[kind]).alias("r")).select("r.*")


def archive(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Raw batches as they came, by day of capture, as a stream of its own; what is archived once is not archived again."""
    dated = stream.withColumn("day", F.coalesce(F.substring("captured_at", 1, 10), F.lit("unknown")))
    return dated.writeStream.partitionBy("day").format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class LeaseProcessor(StatefulProcessor):
    """Keyed state of one target: attempts, what came, whether it is done; a timer frees a lease that went quiet."""

    def __init__(self, timeout_s: int = 180, max_attempts: int = 5):
        self.timeout_ms, self.max_attempts = timeout_s * 1000, max_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("lease", "attempts int, harvested bigint, done boolean, in_flight boolean")

    def _row(self, key, attempts, harvested, done, in_flight) -> pd.DataFrame:
        eligible = not done and not in_flight and attempts < self.max_attempts
        return pd.DataFrame({"target": [key[0]], "attempts": [attempts], "harvested": [harvested], "done": [done], "in_flight": [in_flight], "eligible": [eligible]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        attempts, harvested, done, in_flight = self.state.get() if self.state.exists() else (0, 0, False, False)
        events = pd.concat(list(rows)).sort_values("ts", kind="stable")
        for kind, n in zip(events["kind"], events["n"].fillna(0), strict=True):
            if kind == "handout":
                attempts, in_flight = attempts + 1, not done
            elif kind == "partial":
                harvested, in_flight = harvested + int(n), not done
            elif kind == "done":
                harvested, done, in_flight = harvested + int(n), True, False
            elif kind == "fail":
                in_flight = False
        self.state.update((int(attempts), int(harvested), bool(done), bool(in_flight)))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if in_flight:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)
        yield self._row(key, attempts, harvested, done, in_flight)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempts, harvested, done, _ = self.state.get()
        self.state.update((attempts, harvested, done, False))
        yield self._row(key, attempts, harvested, done, False)

    def close(self) -> None:
        pass


LEASES = "target string, attempts int, harvested bigint, done boolean, in_flight boolean, eligible boolean"


def lease_stream(events: DataFrame, timeout_s: int = 180, max_attempts: int = 5) -> DataFrame:
    """events(target, ts, kind, n) as a stream: the state of each target after each batch, and when its lease runs out. Needs the RocksDB state store."""
    return events.groupBy("target").transformWithStateInPandas(LeaseProcessor(timeout_s, max_attempts), outputStructType=LEASES, outputMode="Update", timeMode="ProcessingTime")


def replay(spark: SparkSession, archive: str, out: str, as_of: str, names: dict[str, str], index: DataFrame | None = None, retailer: str = "") -> None:
    """Rebuilds all records from the archived batches, enriched prices included."""
    from stemma.operators.sampling import enrich_offers
    from stemma.sources.readers import read_batches
    from stemma.sources.sinks import write_records

    batches = read_batches(spark, archive).drop("ord")
    records = records_of(batches, as_of, names)
    if index is not None:
        rows = batches.select(F.explode("enriched").alias("x")).select("x.*")
        records["offer"] = records["offer"].unionByName(enrich_offers(rows, index, retailer).withColumn("scraped_at", F.lit(as_of)), allowMissingColumns=True)
    for kind, df in records.items():
        write_records(df, f"{out}/{kind}")


class ProgressRows(StreamingQueryListener):
    """Turns what streaming queries report into rows: one JSON line for each batch of each query, appended below a path, by the session's own writer."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        row = (str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond), p.durationMs.get("triggerExecution"), sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state))
        self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").json(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


PROGRESS = "id string, run_id string, name string, batch bigint, at string, rows bigint, rows_per_second double, took_ms bigint, state_rows bigint, late_rows bigint"


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """What ProgressRows has written; a batch that ran again counts as it ran last."""
    rows = spark.read.schema(PROGRESS).json(path)
    return keep_best(rows, ["id", "batch"], [F.desc("at"), F.desc("run_id")])
