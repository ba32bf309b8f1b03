"""The corpus pipeline: documents without toxic ones, repeated lines, near copies and benchmark texts, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import written
from shelfcast.llm.decontaminate import without_contaminated
from shelfcast.llm.lines import keep_lines, line_bitmaps
from shelfcast.llm.packing import pack_documents
from shelfcast.llm.queries import table, tokenizer_file, toxic_labels
from shelfcast.llm.simhash import one_of_each_group
from shelfcast.llm.toxicity import score_toxicity

#: SQL has no fingerprints, nearest examples or tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under one half."""
    return score_toxicity(docs, toxic_labels(spark, sf_dir)).where("score < 0.5").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a larger id holds too; ``n_chars`` follows the text."""
    left = keep_lines(docs, line_bitmaps(docs))
    now = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return left.select(*[now.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 2 bits or fewer between 3-word fingerprints make: the smallest id."""
    return one_of_each_group(docs, width=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is benchmark text."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences that the documents fill."""
    return pack_documents(docs, tokenizer_file(), capacity=2048, end_id=1)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
