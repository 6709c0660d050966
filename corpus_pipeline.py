"""Corpus pipeline: language ID, exact dedup, n-gram Jaccard join, secret scans, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result as
Parquet in the shared folder of ``spark.checkpoint.dir`` and reads it back.

language_id     texts without a language (``und``) go; learns as operator 8 does
exact_dedup     of equal texts the row with the largest doc_id stays
jaccard_join    of each group of near copies the row with the smallest doc_id stays
secret_scans    secrets in the texts are masked; every row stays
packing         the rows' tokens in sequences of at most 2048
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.llm import exact_dedup, jaccard, langid, packing, secrets
from reelhouse.llm.queries import WORD_VOCABULARY, vocabulary
from reelhouse.llm.util import id_bucket, prepare, read_table
from reelhouse.session import ensure_checkpoint_dir


def language_id_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = langid.fit(docs.filter(id_bucket(F.col("doc_id"), 3) != 1))
    found = langid.classify(docs, model, pred="__lang", score="__score")
    return found.filter(F.col("__lang") != langid.UND).select(*docs.columns)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.drop_copies(docs, keep="largest")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard.drop_near_copies(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets.redact_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, vocabulary(WORD_VOCABULARY))


STAGES = [
    ("language_id", language_id_stage),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

#: Kernel regression, trie owners and packing order have no SQL form; tests hold the pipeline against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
