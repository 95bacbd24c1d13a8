"""From raw documents to packed token windows: toxicity, exact copies, near copies, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is written as Parquet
and read again by the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, jaccard, mixing, packing, toxicity
from tidemark.llm.common import pin
from tidemark.llm.queries import tokenizer_path
from tidemark.sources.testdata import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half (trained on the labelled rows that aren't held out)."""
    return toxicity.score_documents(docs, table(spark, sf_dir, "labels"), keep=True)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by their five-word shingles."""
    return jaccard.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights; a document once per repeat that takes it."""
    return mixing.draw_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in windows of 1024."""
    return packing.pack_documents(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# The stages fit a classifier, compare sets of shingles and call a tokenizer: not SQL. tests/llm checks the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
