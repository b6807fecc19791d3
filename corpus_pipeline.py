"""From raw documents to token ids: toxic documents, near-duplicates and benchmark leaks go, personal data is masked.

Every stage takes any columns beside ``doc_id`` and ``text``, whatever their names, and gives the columns it was given
(the last one its own). A null text counts as empty; an empty table gives an empty one; texts are taken whole, however
long. Ids are meant to be distinct. Rows that share one stand or fall together where a stage decides by document
(near-duplicates, leaks); toxicity and masking judge each row by its own text. Rows without id are never
near-duplicates or leaks, and are scored, masked and tokenised like others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import bpe, decontaminate, neardup, pii, toxicity
from platewise.llm.stored import stored

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labels of two thirds of the ids.

    An empty text scores as no known words. Without labels of both classes all texts score alike, by their share.
    """
    taught = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(taught)
    return toxicity.keep_clean(docs, toxicity.train(docs, labels), TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; documents without id or words stay.

    Ties cannot occur, as the smallest id decides; repeated rows of one id stay together.
    """
    copies = neardup.near_duplicates(docs).where("NOT kept").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; documents without id or text stay."""
    leaks = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` is counted anew where there is such a column."""
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and digest of the text they decode to; a null text has no ids."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.round_trip(docs, path, public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", mask_personal_data),
    ("byte_bpe", tokenise),
]

# A fitted classifier decides in the first stage, so no SQL gives the same rows; tests/llm holds it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
