"""Corpus preparation in stages; each stage's rows are written and read again before the next.

Documents of low quality go, one of each group of near duplicates stays, personal data are replaced, sources are mixed
to their target weights (a document comes as often as the mix takes it), and the texts are encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import bpe, jaccard, mixing, pii, quality
from skein.llm.common import fold_of, stored, table


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learnt = table(spark, sf_dir, "labels").where(fold_of("doc_id", 5) != 0)
    return quality.accepted(docs, quality.fit(docs, learnt))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def _pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast(clean.schema["n_chars"].dataType)) if "n_chars" in clean.columns else clean


def _mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def _encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs)


STAGES = [("quality", _quality), ("near_duplicates", _near_duplicates), ("pii", _pii), ("mixing", _mixed), ("bpe", _encoded)]
#: Trained models and byte-pair merges are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
