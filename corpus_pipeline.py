"""A corpus made ready for training: language, near copies, secrets, mixture, token ids.

Each stage takes all documents that the one before kept, written as Parquet and read again."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.llm import byte_network, piece_codec, prefix_join, secret_scan, soft_mixing
from cohortica.llm.common import Written, table

# Rows of texts that pass to a Python worker at a time. Spark's 10,000 are some 30 MB of ordinary documents, held on both
# sides by every task.
BATCH_ROWS = "1500"
# Shares of tokens by domain in the mixture. Documents that are most likely good all stay.
WEIGHTS = {"good": 0.9, "poor": 0.08, "toxic": 0.02}


def in_small_batches(stage):
    """``stage`` in a session that hands Python workers ``BATCH_ROWS`` rows at a time, from then on."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or of a language that no label names go."""
    return byte_network.accepted(docs, byte_network.train(docs))


@in_small_batches
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar sets of five-word shingles the one with the smallest id."""
    return prefix_join.survivors(docs)


@in_small_batches
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars follows the text."""
    masked = secret_scan.redacted(docs)
    length = F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars"))
    return masked.withColumn("n_chars", length).select(*docs.columns)


@in_small_batches
def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to which the mixture gives a copy: poor and toxic ones thin out to their weights."""
    return soft_mixing.mixed(docs, table(spark, sf_dir, "labels"), WEIGHTS, protect=("good",))


@in_small_batches
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with digests of the ids and of the text decoded from them."""
    import public_tokenizers

    return piece_codec.digests(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("language_id", keep_language),
    ("ngram_join", keep_one_of_each_group),
    ("secret_scan", mask_secrets),
    ("domain_mixing", mix_domains),
    ("piece_encoding", encode_pieces),
]
# Trained networks, set similarity and tokenizers are beyond SQL; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Written(stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
