"""How filters interact: what each of five filters removes at its place in every order of them, from one cube over their failure flags.

Every document fails some of the filters A to E. ``CUBE`` over the five flags and the part counts, of each set of filters, the documents that fail
none of the set: the grouping set's row in which all of the set's flags are false. A step of an order takes the set before it to the set with
its own filter as well, so all that it does is the difference of two such rows, joined by their sets.

Nulls and the like: a null text is empty; a null part is the empty string; documents without a label, or with a null one, are neither good nor toxic, and a
document with several labels is what any of them says; repeated rows of one document count each, and do not fail E for one another, as E asks for a
smaller id; rows without an id neither fail E nor make others fail it; an empty table has no parts and no rows. Equality of SHA-256 stands in for equality of texts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.llm.common import staged

FILTERS = "ABCDE"
_SPACE = " \t\n\x0b\x0c\r"
_COUNTS = ("n", "good", "toxic")


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails the filters that look at it alone: under 200 words, under half of the words distinct, over 2 % capitals, a forbidden character."""
    inner = F.btrim(text, F.lit(_SPACE))
    parts = F.split(inner, r"[\x20\x09-\x0D]+")
    words = F.when(inner == "", F.lit(0)).otherwise(F.size(parts))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": words < 200, "B": 100 * F.size(F.array_distinct(parts)) < 50 * words, "C": 100 * capitals.cast("long") > 2 * F.length(text), "D": text.rlike("[#$%&*|]")}


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, text, part), labels(doc_id, quality, toxic) -> (part, A, B, C, D, E, n, good, toxic), one row for each part and failures that occur.

    Rows are told by a digest of the text from the first exchange on, and combined before it. The least id of a text meets its rows by digest
    and id together, so that a text with very many copies is no key of a join."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    flags = failures(text)
    rows = docs.select("doc_id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), *(c.alias(k) for k, c in flags.items()))
    rows = rows.groupBy("digest", "doc_id", "part", *flags).agg(F.count("*").alias("n"))
    firsts = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    of = {"good": F.col("quality") == 1, "bad": F.col("toxic") == 1}
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(*(F.max(F.coalesce(c, F.lit(False))).alias(k) for k, c in of.items())).where("good or bad")
    rows = rows.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    rows = rows.withColumn("E", F.col("first").isNull() & F.col("doc_id").isNotNull())
    return rows.groupBy("part", *FILTERS).agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col(k), F.col("n")).otherwise(0)).alias(c) for k, c in (("good", "good"), ("bad", "toxic"))))


def survivors(flags: DataFrame) -> DataFrame:
    """(part, passed, n, good, toxic) for each part and each of the 32 sets of filters, as bits: how many documents fail none of the set."""
    cube = flags.cube(*FILTERS, "part").agg(*(F.sum(c).alias(c) for c in _COUNTS), *(F.grouping(c).alias(f"no_{c}") for c in (*FILTERS, "part")))
    clean = cube.where("no_part = 0").where(" and ".join(f"(no_{f} = 1 or not {f})" for f in FILTERS))
    passed = sum(((1 - F.col(f"no_{f}").cast("int")) * (1 << i) for i, f in enumerate(FILTERS)), F.lit(0))
    zeros = flags.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("passed"), *(F.lit(0).cast("long").alias(c) for c in _COUNTS))
    return clean.select("part", passed.alias("passed"), *_COUNTS).union(zeros).groupBy("part", "passed").agg(*(F.sum(c).alias(c) for c in _COUNTS))


def steps() -> list[tuple[str, int, int, int, int]]:
    """(order, step, filter's bit, set before, set after) of all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for k, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            out.append(("".join(order), k + 1, bit, before, before | bit))
            before |= bit
    return out


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, text, part), labels(doc_id, quality, toxic) -> one row per part, order of the filters and step."""
    spark = docs.sparkSession
    kept = staged(survivors(staged(flagged(docs, labels))))
    plan = F.broadcast(spark.createDataFrame(steps(), "filter_order string, step int, bit int, before int, after int"))  # 600 rows
    as_ = lambda name: kept.select("part", F.col("passed").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in _COUNTS))
    pairs = as_("before").join(plan, "before").join(as_("after"), ["part", "after"])
    # What a filter fails at all, and what it fails alone: the first and the last sets' own steps.
    single = as_("nothing").where("nothing = 0").select("part", "nothing_n")
    alone = as_("one").join(single, "part").where(F.col("one").isin([1 << i for i in range(5)])).select("part", F.col("one").alias("bit"), (F.col("nothing_n") - F.col("one_n")).alias("fails"))
    every = as_("every").where("every = 31").select("part", "every_n")
    rest = as_("others").join(every, "part").where(F.col("others").isin([31 - (1 << i) for i in range(5)])).select("part", (31 - F.col("others")).alias("bit"), (F.col("others_n") - F.col("every_n")).alias("unique_fails"))
    removed = F.col("before_n") - F.col("after_n")
    out = pairs.join(alone, ["part", "bit"]).join(rest, ["part", "bit"]).withColumn("removed", removed)
    return out.select(
        "part", "filter_order", "step", F.col("after_n").alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", (F.col("before_good") - F.col("after_good")).alias("good_lost"),
        (F.col("before_toxic") - F.col("after_toxic")).alias("toxic_lost"), F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley"),
    )


def brute_force(docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    """Every order run document by document; for tests."""
    import re

    rows, firsts = [], {}
    for i, t, _ in docs:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    for i, t, part in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and firsts[t] < i}
        rows.append((part or "", {f for f in fails if fails[f]}, any(j == i and q == 1 for j, q, _ in labels if i is not None), any(j == i and x == 1 for j, _, x in labels if i is not None)))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations(FILTERS):
            left = mine
            for k, f in enumerate(order):
                go = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out.append((part, "".join(order), k + 1, len(left), len(go), sum(f in r[1] for r in mine) - len(go), sum(r[1] == {f} for r in mine), sum(r[2] for r in go), sum(r[3] for r in go)))
    total = {}
    for r in out:
        total[r[0], r[1][r[2] - 1]] = total.get((r[0], r[1][r[2] - 1]), 0) + r[4]
    return {(*r, total[r[0], r[1][r[2] - 1]]) for r in out}
