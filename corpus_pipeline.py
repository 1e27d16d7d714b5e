"""The corpus pipeline: documents in, token ids out, in five stages.

1. ``toxicity``: documents predicted toxic go.
2. ``near_duplicates``: one document of each group of near copies stays.
3. ``decontamination``: passages of benchmark items are cut out; a document that is mostly
   such passages goes.
4. ``secrets``: secrets are replaced by a mark.
5. ``encode``: texts become ids of the public SentencePiece model, with digests.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept.
``run`` writes each stage's result below the shared folder and reads it again as the
next one's documents, so a lost executor costs part of one stage. All but the last
return the columns they were given; ``n_chars``, where there is one, follows a changed text.
Empty tables stay empty, null texts pass as empty ones, repeated rows are one group of
copies. SQL cannot express the stages; tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, piece_bpe, secret_scan, simhash, toxicity
from tidemark.llm.common import fold, prepare
from tidemark.llm.queries import piece_model, table
from tidemark.session import discard, shared_dir

#: SQL has neither the trained classifiers nor the tokenizer.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; labels of two of three folds teach."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.filter(fold("doc_id") != 1), labels.filter(fold("doc_id") != 1))
    return toxicity.keep_clean(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of SimHash links."""
    prepare(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows; over half of the words hit, and the document goes."""
    prepare(spark)
    return _counted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret."""
    prepare(spark)
    return _counted(secret_scan.redact(docs, secret_scan.train(docs.select("doc_id", "text"))))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids, their number, and digests of the ids and of the decoded text."""
    prepare(spark)
    coded = piece_bpe.encode_documents(docs.select("doc_id", "text"), piece_model(), with_ids=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("encode", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    prepare(spark)
    docs, done = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = f"{shared_dir(spark, 'pipeline')}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if done:
            discard(spark, done)
        done = out
    return docs
