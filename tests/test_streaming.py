import json
import time

from pyspark.sql import functions as F

from stemma.sources.readers import read_batches
from stemma.streaming import ingest as I

AS_OF = "2026-01-02T00:00:00+00:00"
NAMES = {"shop_one": "Shop One"}


def _batch(n, price):
    return {"url": f"https://s/{n}", "host": "s", "captured_at": f"2026-01-0{n}", "listing_url": "https://s/beer/all", "products": [{"source": "shop_one", "retailer": "Shop One", "name_raw": "Pale Thing 375ml", "price_raw": price, "unit_raw": "pack (6)"}], "reviews": [{"source": "shop_one", "source_url": "u", "text": "A text that is long enough", "rating_raw": 4}]}


def _land(folder, *batches):
    folder.mkdir(exist_ok=True)
    for n, price in batches:
        (folder / f"{n}.json").write_text(json.dumps(_batch(n, price)))


def test_stream_equals_batch_and_replay(spark, tmp_path):
    landing, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    _land(landing, (1, "$10.00"), (2, "$10.00"))
    I.ingest(I.landing(spark, str(landing)), out, cp, AS_OF, NAMES).awaitTermination(300)
    assert [I.ingested(spark, out, k).count() for k in ("product", "offer", "review")] == [1, 1, 1]
    # Another run goes on from the state of the first.
    _land(landing, (3, "$12.00"), (4, "$10.00"))
    I.ingest(I.landing(spark, str(landing)), out, cp, AS_OF, NAMES).awaitTermination(300)
    whole = I.records_of(read_batches(spark, str(landing)).drop("ord"), AS_OF, NAMES)
    for k in ("product", "offer", "review"):
        got = I.ingested(spark, out, k)
        assert got.columns == whole[k].columns and sorted(map(str, got.collect())) == sorted(map(str, whole[k].collect()))
    assert I.ingested(spark, out, "offer").count() == 2 and I.ingested(spark, out, "product").first()["category"] == "beer"
    # The state holds a row for each key that came, and no more.
    state = spark.read.format("statestore").option("operatorName", "transformWithStateInPandasExec").option("stateVarName", "seen").load(cp)
    assert state.count() == 4
    I.replay(spark, str(landing), str(tmp_path / "again"), AS_OF, NAMES)
    assert spark.read.json(str(tmp_path / "again" / "offer")).count() == 2


def test_keys_are_forgotten_after_the_horizon(spark, tmp_path):
    rows = "kind string, key string, at string, url string, place int, value string"

    def run(some, horizon):
        spark.createDataFrame(some, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        found = I.first_of(spark.readStream.schema(rows).parquet(str(tmp_path / "in")), horizon)
        found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
        return sorted((r.kind, r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run([("a", "k", "2", "u", 0, "later"), ("a", "k", "1", "u", 0, "first"), ("b", "k", "1", "u", 0, "other kind")], 2) == [("a", "first"), ("b", "other kind")]
    time.sleep(3)
    assert run([("a", "k", "3", "u", 0, "again")], 2) == [("a", "again"), ("a", "first"), ("b", "other kind")]


def test_archive(spark, tmp_path):
    _land(tmp_path / "in", (1, "$10.00"), (2, None))
    for _ in range(2):
        I.archive(I.landing(spark, str(tmp_path / "in")), str(tmp_path / "raw"), str(tmp_path / "cp")).awaitTermination(120)
    raw = spark.read.json(str(tmp_path / "raw"))
    assert raw.count() == 2 and sorted(str(r.day) for r in raw.select("day").collect()) == ["2026-01-01", "2026-01-02"]


def test_silence_as_a_stream(spark, tmp_path):
    """One row for each stretch that a target was silent after, equal to the batch's; what comes too late is left out."""
    from stemma.operators.state import idle_sessions, silence

    rows = [("a", 0, False), ("a", 200, False), ("a", 500, False), ("b", 0, True), ("b", 800, True), ("b", 900, False), ("b", 1100, False), ("a", 300, False), ("a", 900, False), ("z", 20_000, False)]
    make = lambda some: spark.createDataFrame(some, "target string, s int, listing boolean").select("target", F.timestamp_seconds("s").alias("ts"), "listing")
    make(rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    schema = make(rows).schema

    def run():
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        found = idle_sessions(s, "target", "ts", silence(F.col("listing")), late="10 minutes")
        found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
        return sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect()))

    batch = [r for r in idle_sessions(make(rows), "target", "ts", silence(F.col("listing"))).collect() if r.target != "z"]
    assert run() == sorted(map(str, batch)) and len(batch) == 3
    # An hour behind the latest event: no row of its own, and none changed. The last target is heard of when the time has gone on.
    make([("a", 400, False), ("y", 40_000, False)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    after = run()
    assert len(after) == 4 and set(map(str, batch)) < set(after)


def test_progress_as_rows(spark, tmp_path):
    listener = I.ProgressRows(spark, str(tmp_path / "rows"))
    spark.streams.addListener(listener)
    try:
        spark.range(10).write.parquet(str(tmp_path / "in"))
        s = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        q = s.writeStream.format("noop").queryName("told").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        until = time.time() + 30
        while time.time() < until and not (tmp_path / "rows" / "_SUCCESS").exists():
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    got = [r for r in I.progress_rows(spark, str(tmp_path / "rows")).collect() if r.id == str(q.id)]
    assert [(r.name, r.batch, r.rows) for r in got] == [("told", 0, 10)]


def test_leases(spark, tmp_path):
    rows = [("t1", 1, "handout", 0), ("t1", 2, "partial", 3), ("t1", 3, "done", 4), ("t2", 1, "handout", 0)] + [("t3", i, k, 0) for i, k in enumerate(["handout", "fail"] * 5)]
    df = spark.createDataFrame(rows, "target string, s int, kind string, n bigint").select("target", F.timestamp_seconds("s").alias("ts"), "kind", "n")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = I.lease_stream(s).writeStream.format("memory").queryName("leases").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.target: r for r in spark.table("leases").collect()}
    assert got["t1"].done and got["t1"].harvested == 7
    assert got["t2"].in_flight and not got["t2"].eligible
    assert got["t3"].attempts == 5 and not got["t3"].eligible
