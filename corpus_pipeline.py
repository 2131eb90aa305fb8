"""The corpus pipeline: documents in, token ids of the clean ones out.

Each stage calls one operator of ``refinery.llm`` on everything the stage before
it kept, and is written as Parquet and read again before the next one starts.
Stages read only the columns of ``documents``; further ones are dropped at the
first stage.  Null or empty texts pass every filter (they are not toxic, match no
item and hold no secret; all of them are near duplicates of one another, so the
one of smallest id stays) and have no tokens.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from refinery.llm import bpe, decontam, secret_scan, simhash, toxicity
from refinery.llm.common import table, written
from refinery.session import ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(f):
    """A stage whose tasks find this package on every executor."""
    @wraps(f)
    def shipped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, docs, sf_dir)

    return shipped


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network, trained on the labels that are not held out, scores below 0.5."""
    docs = docs.select(*COLUMNS)
    sample = toxicity.training_sample(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, toxicity.train(*sample))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each component of fingerprints within 2 bits (3-word shingles)."""
    return simhash.keep_one(docs.select(*COLUMNS), "doc_id", "text", 3, 2, "pipeline-simhash")


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage within the edit budget of a benchmark item."""
    return decontam.keep_clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


@stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark and ``n_chars`` counted again where any was found."""
    found = secret_scan.scan(docs.select(*COLUMNS), "text")
    text = secret_scan.redact(F.col("text"), F.col("found"))
    return found.withColumn("text", text).withColumn(
        "n_chars", F.when(F.size("found") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


@stage
def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and the digest of the bytes that they decode to."""
    vocab = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe.round_trip(docs, "doc_id", "text", vocab, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("byte_bpe", encode_texts),
]

#: SQL can't train the network of the first stage; tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = written(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
