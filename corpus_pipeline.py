"""From documents to training tokens: quality rules, near-duplicates, secrets, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import mixing, quality, secrets, sentencepieces, simhash
from tidemart.llm.queries import tokenizer
from tidemart.session import shared_folder


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules, judged against what the languages of these documents look like."""
    return quality.judge(docs, quality.references(docs), row=True)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints differ in few bits, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and ``n_chars`` counted anew."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a row per copy, in the order of training."""
    return mixing.training_order(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row."""
    out = sentencepieces.encode(docs, tokenizer("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))
    return out.select("doc_id", "lang", "source", "ids", "n_tokens")


STAGES = [
    ("quality rules", good_texts),
    ("SimHash near-dedup", one_of_each_group),
    ("secret scans", without_secrets),
    ("mixing sources", mixed),
    ("SentencePiece encoding", encoded),
]

#: The encoding cannot be said in SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
