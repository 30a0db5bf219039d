"""The pipeline's stages on the smallest tables, each against what its operator's own test holds."""

import corpus_pipeline as P
from stemma.llm import decontaminate, shingles, suffixes

DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} if name != "toxicity" else {}
        stage(spark, docs, DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if name == "simhash":
            # Five words, similarity of 0.8 or more: over all pairs.
            want = {i for i, c in shingles.brute_force(before).items() if i == c or not (before[i] or "").split()}
            assert set(kept[name]) == want
        if name == "suffixes":
            wanted = suffixes.brute_force(list(before.items()))
            assert {i: len(t.encode()) for i, t in kept[name].items() if len(t.encode()) == len(before[i].encode())} == {i: w[0] for i, w in zip(before, wanted, strict=True) if not w[1]}
        if name == "benchmark":
            items = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").select("item_id", "text").collect()]
            for i, t in kept[name].items():
                clean = decontaminate.brute_force(before[i], items)[1] == 0
                assert not clean or t == before[i]
            assert all(i in kept[name] for i in before if decontaminate.brute_force(before[i], items)[1] == 0)
    filled = [r[1] for r in docs.groupBy("sequence_id").sum("length").collect()]
    assert max(filled) <= 2048 and len(filled) <= 1.02 * -(-sum(filled) // 2048) + 1
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(kept["benchmark"])


def test_toxicity_stage(spark):
    """Against the labels, held-out ones among them; the other stages are tested on a table too small to learn from."""
    where = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{where}/documents.parquet")
    kept = {r.doc_id for r in P.toxicity(spark, docs, where).select("doc_id").collect()}
    labels = spark.read.parquet(f"{where}/labels.parquet").where("toxic is not null").join(docs.select("doc_id"), "doc_id").selectExpr("doc_id", "toxic", "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 as held").collect()
    for held in (True, False):
        toxic, clean = ([r.doc_id for r in labels if r.toxic == y and r.held == held] for y in (1, 0))
        assert sum(i not in kept for i in toxic) >= 0.8 * len(toxic) and sum(i in kept for i in clean) >= 0.99 * len(clean)


def test_registered(spark):
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(e.oracle_sql()) <= names
