"""From raw documents to encoded training text: five stages, each stored before the next one reads it.

A stage returns the columns of documents; the last one adds the ids and the text they decode to. Tables that a stage stores on its
way are removed at its end, but for those its result reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchspan.llm import language_id, mixing, sentencepiece_codec, toxicity
from watchspan.llm.common import discard, small_batches, stored, tidied
from watchspan.llm.near_dedup import near_groups
from watchspan.llm.queries import PIECES

LEAST_TOXIC, LEAST_LANGUAGE = 0.7, 0.5
SHARES = {"good": 0.85, "poor": 0.15}


@tidied
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity, learned from the labelled ones, is below LEAST_TOXIC."""
    small_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).filter(F.col("toxic_score") < LEAST_TOXIC).select(*docs.columns)


@tidied
def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that is told with a share of LEAST_LANGUAGE or more; it fills the column lang where that is null."""
    small_batches(spark)
    found = language_id.identify(docs, language_id.train(docs))
    found = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


@tidied
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies. Rows that repeat an id are one document; rows without an id stay."""
    small_batches(spark)
    kept = near_groups(docs.select("doc_id", "text")).filter("kept").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi")
    unnamed = docs.filter("doc_id is null")
    return named.unionByName(unnamed).select(*docs.columns)


@tidied
def mix_to_shares(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that good and poor text have their shares and no document is lost."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    domain = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    mixed, _ = mixing.mix(docs, labels.select("doc_id", domain.alias("domain")), SHARES, lose_none=True)
    return mixed.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))).alias("_copy")).drop("_copy")


@tidied
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document and the text they decode to."""
    small_batches(spark)
    model = sentencepiece_codec.read_model(PIECES)
    return sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model), model)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix_to_shares),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[DataFrame] = []
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        for old in before:
            discard(old)
        before = [docs]
    return docs
