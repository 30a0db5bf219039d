"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a frame that is written as Parquet and read again as
the next one's docs. All but the last return the columns of ``documents``; n_chars follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm.common import shared_dir, table
from stemma.llm.decontaminate import decontaminate
from stemma.llm.packing import Capacity, pack
from stemma.llm.simhash import keep_first
from stemma.llm.suffixes import deduplicate
from stemma.llm.toxicity import reject


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more for toxicity go."""
    return reject(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), threshold=0.7)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the least id stays. SimHash fingerprints join first, bands what they leave."""
    return keep_first(docs, size=5, least=0.8)


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes and more that a document with a smaller id has too are cut out."""
    return _sized(deduplicate(docs, length=50))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 10 and more words of test items are cut out; documents that consist of them for more than four fifths go."""
    return _sized(decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), window=10, max_coverage=0.8))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens in as few sequences as can be."""
    return pack(docs.select("doc_id", "text"), Capacity(tokens=2048, documents=2048, attention=2048 * 2048))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("simhash", simhash),
    ("suffixes", suffixes),
    ("benchmark", benchmark),
    ("packing", packing),
]

#: SQL can express neither the trained classifier nor the tokenizer; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = shared_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
