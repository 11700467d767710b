"""From raw documents to packed training sequences: each stage takes the documents that its predecessor kept.

Nulls, blank texts, repeated rows and extra columns go through as each operator's docstring says. Stages but the last return the
columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import saved
from tripkit.llm.langid import DIMENSIONS, UNKNOWN, language_column, learn_prototypes
from tripkit.llm.mixing import mix_sources, mixed_texts
from tripkit.llm.neardup import without_near_duplicates
from tripkit.llm.packing import pack_documents, public_tokenizer
from tripkit.llm.secret_scan import redact_secrets

MIN_SCORE = 0.2  # share of the cosine expected in the nearest language below which a text is in none of them
NOISE = 3 / DIMENSIONS**0.5  # three standard errors of a cosine of hypervectors
# Texts go to Python workers in batches of so many bytes; Spark's own limit of 10,000 rows takes 33 MB of texts of 3,300 bytes.
BATCH_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
ORACLE_SQL = None  # language profiles, sampling and tokenising can't be said in SQL


def _small_batches(spark: SparkSession) -> None:
    for key, value in BATCH_BYTES.items():
        spark.conf.set(key, value)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters or clearly in no learned language. With no labelled text at all, only the former go.

    The floor follows the cosine expected of an in-language text with as many n-grams, less the noise of the vectors: a
    text too short, or with too few different n-grams, to tell is kept.
    """
    _small_batches(spark)
    prototypes = learn_prototypes(docs)
    if not prototypes:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = docs.withColumn("__judged", language_column(F.col("text"), prototypes))
    language, score, expected = (F.col("__judged")[name] for name in ("lang_pred", "score", "expected"))
    floor = expected * MIN_SCORE - NOISE
    return judged.filter((language != UNKNOWN) & (score >= floor)).drop("__judged")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    _small_batches(spark)
    return without_near_duplicates(spark, docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; all documents stay."""
    _small_batches(spark)
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's share of the mix: documents once, twice, in part or not at all."""
    pieces, _ = mix_sources(spark, docs)
    return mixed_texts(docs, pieces)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    _small_batches(spark)
    return pack_documents(spark, docs, public_tokenizer())


STAGES = [
    ("language_id", identify_language), ("near_dedup", drop_near_duplicates), ("secret_scan", remove_secrets), ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
