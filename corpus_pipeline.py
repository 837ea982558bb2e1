"""A corpus from documents: safe, distinct, uncontaminated, mixed and sharded.

Every stage takes what its predecessor kept and returns the columns of documents;
the last returns where each document goes. Clean rows pass a filtering stage unchanged.

Null texts are empty: they are neither toxic nor contaminated, have no near-duplicates, and the mixture
repeats documents without words as often as whole passes over their source do. Null doc_ids are kept by every filter; of rows that repeat an id
one stays. Extra columns go through all stages but the last, whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.llm import decontaminate, minhash_dedup, mixing, sharding, toxicity
from feedmerge.llm.common import Scratch, aside, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the rejection threshold."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    hidden, back = aside(docs, "doc_id", "text")
    return back(toxicity.score_toxicity(hidden, model).where(F.col("toxicity") < toxicity.THRESHOLD))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id.

    Rows that repeat a kept document's id are dropped too; rows without an id stay.
    """
    kept = minhash_dedup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not cover up to the limit."""
    hidden, back = aside(docs, "doc_id", "text")
    marked = decontaminate.mark_spans(hidden, table(spark, sf_dir, "benchmark"))
    return back(decontaminate.verdict(marked).where("not contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return mixing.mixture(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, checksum, shard and place of every row of the mixture."""
    return sharding.assign_shards(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]

#: The stages learn models and run a knapsack, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table that the next stage reads."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
