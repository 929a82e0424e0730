"""The corpus pipeline: each stage works on all that its predecessor kept, written as Parquet in between."""

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from tillwise.llm.common import durable, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
NEAR_WORDS, NEAR_LEAST = 5, Fraction(4, 5)  # of near copies: words of a shingle, least Jaccard similarity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine rejects go (operator 6)."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays (operator 4)."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (operator 8, on longer shingles and from a lower similarity)."""
    return jaccard_join.one_of_each(docs, NEAR_WORDS, NEAR_LEAST)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go (operator 3)."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of what is left, and the text decoded from them (operator 2)."""
    return bpe.encode_decode(docs, bpe.word_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

# models and tokenizers are beyond SQL; tests hold the stages against brute-force versions
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
