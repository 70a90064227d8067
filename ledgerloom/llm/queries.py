"""The registered query of each operator, with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, importance, license_scan, mixing, ngram_join, packing, secret_scan, sentencepiece_spans, spelling, spotsigs, suffix_dedup, topk, url_filter
from ledgerloom.llm.common import stored, table


URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_filter.judge(pages, table(spark, sf_dir, "labels"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.against_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("signatures", " ").alias("fingerprint"),
        F.array_join("edited_signatures", " ").alias("edited_fingerprint"), "near_edited", "near_next")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0).withColumnRenamed("id", "vec_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    places = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(stored(places, "pieces"))  # tokenized once, though pack counts its rows first


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_groups(table(spark, sf_dir, "documents"), t=0.9, n=3)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "labels")).select("doc_id", "log_weight", "kept")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs, license_scan.known_licenses(spark)).select("doc_id", "canonical_sha256", "license")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.find_secrets(docs, secret_scan.train(docs, table(spark, sf_dir, "labels")))
    counts = [secret_scan.count_of(k).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.spelled(F.col("base")), 256).alias("base_sha256"),
        secret_scan.spelled(F.col("spans")).alias("spans"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = sentencepiece_spans.encode(docs, model, decoded=True)
    return pieces.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_bytes"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_topk": op4_topk,
    "op5_packing": op5_packing,
    "op6_ngram_join": op6_ngram_join,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_secrets": op9_secrets,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_spelling": op11_spelling,
    "op12_mixing": op12_mixing,
    "op13_collocations": op13_collocations,
}

OP4_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_sum(list_transform(list_zip(q.v, e.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM e q JOIN e ON e.vec_id <> q.vec_id AND len(e.v) = len(q.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op4_topk": OP4_SQL,
    "op3_fingerprints": spotsigs.sql(),
    "op8_licenses": license_scan.sql(),
    "op12_mixing": mixing.sql(),
    "op13_collocations": collocations.sql(),
}
