"""The training-data pipeline: five stages over `documents`, each written as Parquet and reread as the next one's input.

toxicity removes rejected documents; the n-gram Jaccard join keeps one document of each group of near copies;
decontamination removes documents that hold benchmark passages; mixing repeats or leaves out documents to meet the
sources' targets; sharding deals the rest into shuffled shards. The toxicity model learns from `labels`, those rows
whose crc32(doc_id) mod 5 is not 0, and the documents of its own input.

Defined results, for every stage: a null or empty text is a document without words (scored by the bias alone, in no group,
hit by nothing, taken 0 times by the mix); very long texts are judged whole; ties fall as each operator states; repeated rows
are judged alike, and of rows with equal shingles one stays; an empty table gives an empty table; other columns pass through,
those named `shard` or `slot` with `in_` before them in the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalith.llm import decontam, jaccard, mixing, queries, sharding, toxicity
from zonalith.session import staged


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    labels = queries.table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, eligible=~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, model)
    score = scored.columns[-1]
    return scored.where(F.col(f"`{score}`") < 0.5).drop(score)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group of near copies."""
    joined = staged(jaccard.join(docs), "joined")
    return jaccard.keep_one(docs, joined)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word in a benchmark window."""
    return decontam.drop_documents(decontam.scan(docs, queries.table(spark, sf_dir, "benchmark")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.emit(mixing.plan_copies(docs, docs.count()))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in shuffled shards: the columns of documents, shard and slot."""
    return sharding.external_shuffle(docs, queries.SHARDS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The toxicity model is trained, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
