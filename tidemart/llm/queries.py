"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import codes, embeddings, katz, mixing, pages, quality, search, secrets, sentencepieces, simhash, token_counts, warc, whitening


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids, and whether they decode to the text again (they don't where it holds U+2581)."""
    out = sentencepieces.encode(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"), back=("same_text",))
    return out.select("doc_id", "n_tokens", "ids", "same_text")


def op2_quality_divergence(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, quality.references(docs))


def op3_transducer_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    times = [F.get("positions", F.lit(i)).alias(f"{name}_position") for i, name in enumerate(("first", "second"))]
    return mixed.select("doc_id", "size", "source_size", "target", "taken", *times)


def op5_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return katz.score(docs, held=F.crc32(name.cast("binary")) % 5 == 1)


def op6_simhash_bitsliced(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op8_dom_marginals(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op9_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read(warc.write(table(spark, folder, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        rank = secrets.KINDS.index(kind)
        return F.size(F.filter("secret_spans", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")

    base = F.filter("secret_spans", lambda s: s["rank"] < 3)
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("secret_spans")).alias("spans"),
    )


def op11_feast_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_histogram_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return search.top_k(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def op13_cell_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compress(table(spark, folder, "embeddings"))


ALL = (
    op1_sentencepiece, op2_quality_divergence, op3_transducer_counts, op4_curriculum_mix, op5_katz_backoff, op6_simhash_bitsliced,
    op7_cross_polytope, op8_dom_marginals, op9_warc_bundles, op10_secret_scan, op11_feast_whitening, op12_histogram_top_k, op13_cell_codes,
)
QUERIES = {f.__name__: f for f in ALL}
