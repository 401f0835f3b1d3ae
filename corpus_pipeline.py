"""From raw documents to training tokens: toxicity, line dedup, near copies, benchmark passages, token ids.

Every stage reads what the one before it kept, as Parquet in the shared folder. All stages but the last return the columns of
``documents``; the last returns (doc_id, n_ids, ids). Rows with a NULL doc_id pass the filters, which go by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm import decontaminate, jaccard_join, line_dedup, pieces, toxicity
from shelfscope.llm.common import remainder, stored, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not reject. It learns from the labels of all folds but the held-out one."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, remainder("doc_id", 3) != 1)
    return toxicity.clean_only(docs, model)


def lines_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that five or more documents share, but for one holder each."""
    return line_dedup.deduplicated(docs)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean_only(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("toxicity", toxic_out),
    ("line dedup", lines_deduped),
    ("n-gram Jaccard join", near_copies_out),
    ("benchmark decontamination", leaks_out),
    ("piece encoding", token_ids),
]

# The stages learn, iterate and merge pieces, which SQL does not express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
