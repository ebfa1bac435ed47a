"""A training corpus from raw documents, in five stages; each works on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlift.llm import byte_bpe, minhash_dedup, mixing, pii, toxicity
from spotlift.llm.shared import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among them, does not reject."""
    return toxicity.clean(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return minhash_dedup.deduplicated(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by the name of its kind."""
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that expected tokens by source, language and topic have the tempered shares."""
    return mixing.mixed(docs, mixing.CORPUS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, token ids and the digests of ids and of the bytes they decode to."""
    tokens = byte_bpe.encoded_and_decoded(docs.select("doc_id", "source", "lang", "text"))
    return tokens.select(
        "doc_id", "source", "lang", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: A trained classifier and a tokenizer are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a Parquet table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
