"""The corpus operators as named queries ``f(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlark.llm import (
    bm25,
    bpe,
    collocations,
    compression_classifier,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    quality_rules,
    suffix_dedup,
    token_alignment,
    token_counts,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LABELS = "doc_id BIGINT, quality INT, toxic INT"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LABELS).parquet(f"{sf_dir}/labels.parquet")


def quality_rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(documents(spark, sf_dir))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(documents(spark, sf_dir))


def compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_classifier.verdicts(documents(spark, sf_dir), labels(spark, sf_dir))


def byte_bpe() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), byte_bpe())


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(documents(spark, sf_dir))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.verdicts(documents(spark, sf_dir), labels(spark, sf_dir))


def unigram_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No unigram vocabulary is at hand, so the pieces and scores of another model serve as one."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.counts(
        documents(spark, sf_dir), token_counts.sentencepiece_vocabulary(path)
    )


def long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, sf_dir))


def top_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents nearest to each one whose id is divisible by 50, itself included."""
    docs = documents(spark, sf_dir)
    return bm25.top_documents(docs, bm25.every_nth(docs))


def aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.digest(
        documents(spark, sf_dir),
        token_alignment.ByteLevel(public_tokenizers.path("byte_bpe_50k.json")),
        token_alignment.SentencePieces(public_tokenizers.path("piece_bpe_32k.model")),
    )


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": quality_rule_verdicts,
    "op2_source_mixing": source_mixing,
    "op3_toxicity": toxic_documents,
    "op4_suffix_dedup": long_repeats,
    "op5_line_dedup": repeated_lines,
    "op6_token_counts": unigram_token_counts,
    "op7_ngram_jaccard": near_duplicates,
    "op8_compression_classifier": compression_quality,
    "op9_bm25_top_k": top_documents,
    "op10_byte_bpe": byte_bpe_round_trip,
    "op11_token_alignment": aligned_tokens,
    "op12_phrase_collocations": phrase_collocations,
    "op13_pii": personal_data,
}
