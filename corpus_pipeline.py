"""From raw documents to tokens: language, exact copies, near copies, mixture, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchday.llm import byte_bpe, byte_cnn, cqf, lsh_forest, pivotal
from matchday.llm.common import held_out
from matchday.llm.queries import PATTERN, RANKS
from matchday.workspace import materialise

#: The least mean probability of a language; a text that is spread over more than two languages stays below.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without letters, null or empty, go, and those below LEAST_SCORE."""
    model = byte_cnn.train(docs, ~held_out(F.col("doc_id")))
    pred, score = "_pipeline_lang", "_pipeline_score"
    found = byte_cnn.identify(docs, model, names=(pred, score))
    return found.where((F.col(pred) != byte_cnn.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).drop(pred, score)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest document."""
    return cqf.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.8 over five-word shingles, the document with the smallest id."""
    return lsh_forest.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return pivotal.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and a digest of the bytes they decode to."""
    decoded = byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN, keep=("doc_id", "lang", "source")), RANKS, PATTERN)
    return decoded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: A network, random draws and merges have no SQL; tests/llm compares every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each stage's result is written once and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
