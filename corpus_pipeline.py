"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

``STAGES`` lists them; each takes ``(spark, docs, sf_dir)`` and returns a DataFrame, and all but the
last return the columns of ``documents``. The classifiers learn from the ``labels`` table beside the
documents, leaving out the same held-out ids as their own queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.learning import held_out
from tallyworks.llm.near_dedup import drop_near_duplicates
from tallyworks.llm.packing import pack_documents
from tallyworks.llm.quality import fit_quality, score_quality
from tallyworks.llm.shared import scratch
from tallyworks.llm.substring_dedup import dedup_substrings
from tallyworks.llm.toxicity import fit_toxicity, score_toxicity

TOKENIZER = "byte_bpe_50k.json"
LEAST_QUALITY = 0.3
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being good is 0.3 or more."""
    model = fit_quality(docs, _labels(spark, sf_dir).filter(~held_out("doc_id", 5, 0)))
    return score_quality(docs, model).filter(F.col("quality_score") >= LEAST_QUALITY).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic at the threshold of their language."""
    model = fit_toxicity(docs, _labels(spark, sf_dir).filter(~held_out("doc_id", 4, 2)))
    return score_toxicity(docs, model).filter(~F.col("toxic")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, likeness 0.8."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that 13-word windows repeat from an earlier document; every document stays."""
    done = dedup_substrings(docs, window=13)
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2,048 ids; see ``packed_sequences`` for whole sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: The trained classifiers have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = scratch(docs)
    return docs
