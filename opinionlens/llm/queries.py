"""The operators over the given tables, one query each, and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.llm import (
    bpe_automaton,
    embeddings,
    extraction,
    lexical,
    merkle,
    mixing,
    paragraph_dedup,
    quality,
    secrets,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    token_counts,
)
from opinionlens.llm.common import read, store
from opinionlens.llm.oracles import ORACLES  # noqa: F401

MODEL, BYTE_BPE = "piece_bpe_32k.model", "byte_bpe_50k.json"


def model_path(name: str = MODEL) -> str:
    """The tokenizer's file: in ``$TOKENIZER_DIR`` if that is set, else in its package."""
    folder = os.environ.get("TOKENIZER_DIR")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece_codec.encode(docs, model_path())
    decoded = sentencepiece_codec.decode(encoded, model_path())
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), "▁", " ")).alias("round_trip"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op3_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.remove_paragraphs(read(spark, sf_dir, "documents"), whole=True)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, model_path())


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(store(quality.add_statistics(docs).drop("text")))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"), spans="found")
    base = secrets.of_kinds(F.col("found"), [r.kind for r in secrets.BASE_RULES])
    counts = [F.size(secrets.of_kinds(F.col("found"), [r.kind])).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE_RULES]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("found")).alias("spans"),
    )


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extraction.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents").select("doc_id", "text"), model_path(BYTE_BPE)
    encoded = bpe_automaton.encode(docs, path, digest="ids_sha256").drop("text")
    decoded = bpe_automaton.decode(encoded, path)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    kept = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaf = merkle.digest_of([*kept, F.col("text")])
    shown = F.when(tampered, merkle.digest_of([*kept, low]))
    leaves = docs.select("doc_id", "source", leaf.alias("leaf"), shown.alias("tampered")).withColumn("tampered", F.coalesce("tampered", "leaf"))
    return merkle.prove(leaves, presented="tampered").select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_paragraph_dedup": op3_paragraph_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_secrets": op7_secrets,
    "op8_extraction": op8_extraction,
    "op9_simhash": op9_simhash,
    "op10_embeddings": op10_embeddings,
    "op11_bpe": op11_bpe,
    "op12_merkle": op12_merkle,
    "op13_lexical": op13_lexical,
}
