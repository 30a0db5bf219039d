"""Numbers and runs over the order of a whole table, whatever the ranges."""

import json
import random

import pytest
from pyspark.sql import functions as F

from stemma.operators import order as O
from stemma.operators import sampling, state
from stemma.sources.sinks import write_array


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbers(spark, parts):
    rows = [(i * 7919 % 1000 // 3, i) for i in range(1000)] + [(None, 5000), (None, 5001)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = O.numbered(df, [F.desc_nulls_last("a"), "b"], "n", parts)
    assert got.columns == ["a", "b", "n"]
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.a, r.b) for r in sorted(got.collect(), key=lambda r: r.n)] == want
    assert sorted(r.n for r in got.collect()) == list(range(len(rows)))
    assert O.numbered(df.where("false"), ["b"], "n").count() == 0


def test_batches_of_a_whole_table(spark):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("id"))
    got = sampling.batch_ids(df, 48, ["id"])
    assert all(r.batch == r.id // 48 for r in got.collect())
    assert "Window" not in got._jdf.queryExecution().toString()


def runs_by_hand(rows):
    out, last = [], {}
    for k, at, v in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        before, run = last.get(k, (None, 0))
        gained = None if before is None or v is None else v - before
        run = run + 1 if gained == 0 else 0
        out.append((k, at, v, gained, run))
        last[k] = (v, run)
    return out


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
@pytest.mark.parametrize("keyed", [True, False])
def test_runs(spark, parts, keyed):
    r = random.Random(parts)
    rows = [("k" if not keyed else r.choice("abc"), i, r.choice([1, 1, 1, 1, 2, None]) if i < 200 else 5) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, at int, v long").repartition(3)
    got = state.stall_runs(df, "at", "v", ["k"] if keyed else None, parts)
    assert sorted(map(tuple, got.collect())) == sorted(runs_by_hand(rows))


def test_a_long_series_lies_in_many_tasks(spark):
    df = spark.range(1_000_000).select("id", F.when(F.col("id") < 400_000, F.floor(F.col("id") / 1000)).otherwise(7_000).alias("v"))
    got = state.stall_runs(df, "id", "v", parts=8)
    assert got.where("stalls > 0").agg(F.max("stalls"), F.count("*")).first() == (599_999, 400 * 999 + 599_999)
    rows = O.ranged(df, ["id"], 8)
    assert rows.groupBy("__part").count().agg(F.max("count")).first()[0] < 300_000


def test_hand_out(spark):
    """48 who ask at once get 48 different targets, in the queue's order."""
    queue = spark.createDataFrame([(f"t{i}", i) for i in range(200)], "target string, position int").repartition(7)
    leased = spark.createDataFrame([(f"t{i}", i % 3 != 0) for i in range(0, 60)], "target string, eligible boolean")
    asked = spark.createDataFrame([(f"w{i}", 1000 - i) for i in range(48)], "worker string, at int").repartition(4)
    got = {r.worker: r for r in state.hand_out(leased, queue, asked, ["at", "worker"]).collect()}
    free = [i for i in range(200) if i >= 60 or i % 3 != 0]
    assert [got[f"w{i}"].position for i in range(47, -1, -1)] == free[:48] and len({r.target for r in got.values()}) == 48
    assert state.hand_out(leased, queue.where("position < 5"), asked, ["at", "worker"]).count() == 3
    one = state.next_target(leased, queue).first()
    assert one.target == got["w47"].target


def test_array_in_order(spark, tmp_path):
    path = tmp_path / "whole.json"
    df = spark.range(1000).select((F.col("id") * 613 % 1000).alias("id"), F.array(F.struct(F.lit('a "b"\n,').alias("x"))).alias("l")).repartition(6)
    write_array(df, f"file://{path}", ["id"])
    got = json.loads(path.read_text())
    assert [r["id"] for r in got] == list(range(1000)) and got[5]["l"] == [{"x": 'a "b"\n,'}]
    # A run that fails leaves what was there, and nothing of its own.
    bad = df.withColumn("y", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        write_array(bad, f"file://{path}", ["id"])
    assert json.loads(path.read_text()) == got and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["whole.json"]
    write_array(df.where("false"), f"file://{path}", ["id"])
    assert json.loads(path.read_text()) == []
