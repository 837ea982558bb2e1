"""One query for each operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    collocations,
    decontaminate,
    embed_dedup,
    html_extract,
    langid,
    minhash_dedup,
    mixing,
    ngram_scores,
    pii,
    quality,
    sharding,
    toxicity,
    vector_codes,
)
from .common import table
from .oracle import SQL as SQL  # noqa: PLC0414

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.digest(table(spark, sf, "documents"))


def op3_html(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf, "pages"))


def op4_embedding(spark: SparkSession, sf: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf, "embeddings"))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(table(spark, sf, "documents"))


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf, "documents"))


def op8_minhash(spark: SparkSession, sf: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(table(spark, sf, "documents"))


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def op12_ngram_scores(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_scores.score_documents(table(spark, sf, "documents"))


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.digest(table(spark, sf, "embeddings"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_toxicity,
        op2_mixing,
        op3_html,
        op4_embedding,
        op5_decontamination,
        op6_language,
        op7_sharding,
        op8_minhash,
        op9_pii,
        op10_quality,
        op11_collocations,
        op12_ngram_scores,
        op13_vector_codes,
    )
}
