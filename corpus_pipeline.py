"""From raw documents to a mixed training corpus: five stages, each reading what the one before has kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from offeranalytics.llm import decontaminate, exact_dedup, langid, mixing, simhash
from offeranalytics.llm.common import cut, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a recognised language go. Split 2 of 4 is never learned from."""
    network = langid.train(docs.where(langid.split_number("doc_id", 4) != 2))
    return langid.keep_known(docs, network)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the smallest doc_id stays."""
    return simhash.keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every document gets its place in an order that mixes the sources to weight."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("benchmark decontamination", benchmarks),
    ("mixing sources to target weights", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage keeps is stored in the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot state the language and SimHash stages; tests hold them against brute force.
ORACLE_SQL = None
