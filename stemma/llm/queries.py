"""The operators of this subpackage as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm.common import table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.decontaminate import contamination, digest

    return digest(contamination(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark").select("item_id", "text"), window=10), "doc_id")


def op2_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists are derived from the pages themselves, as the tables hold none; fetch times likewise."""
    from stemma.llm.urlfilter import as_of, dated_list, fetch_time, intervals

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return as_of(pages.select("page_id", "url", fetch_time().alias("fetched_at")), intervals(dated_list(pages)))


def op3_grammar_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.grammar import round_trip

    return round_trip(_docs(spark, sf_dir))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.suffixes import digest, repeats

    return digest(repeats(_docs(spark, sf_dir), length=50))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.packing import Capacity, pack

    return pack(_docs(spark, sf_dir), Capacity(tokens=2048, documents=2048, attention=2048 * 2048))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.simhash import hex_fingerprint, near_duplicates

    found = near_duplicates(_docs(spark, sf_dir), most=3, size=3)
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), F.col("component_id"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.htmltext import extract

    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.hpylm import score_corpus

    return score_corpus(_docs(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.toxicity import fit, held_out, score

    docs = _docs(spark, sf_dir)
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out()), sample=20_000)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_mjpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.mjpeg import features, to_media

    return features(to_media(_docs(spark, sf_dir)))


def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.jaccard import linked_components

    return linked_components(_docs(spark, sf_dir), size=4, percent=85)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.audit import interactions

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("part"))
    return interactions(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stemma.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), most=32)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_urlfilter, op3_grammar_shards, op4_suffixes, op5_pack, op6_simhash, op7_html, op8_hpylm, op9_toxicity, op10_mjpeg, op11_jaccard, op12_filter_audit, op13_whitening)}
