"""Queries of the training-data operators, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balls, chat, codes, decontaminate, html, language, lines, lm, mixing, neardup, secrets, suffix, vectors
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.digest(html.extract(table(spark, sf_dir, "pages")))


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.repeats(table(spark, sf_dir, "documents")))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.format_chats(chat.with_extra(table(spark, sf_dir, "conversations"))))


def op10_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents"))


def op5_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link(table(spark, sf_dir, "embeddings"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7_lm_score that SQL can tell, from the same operator."""
    return lm.base_digest(op7_lm_score(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.identify(docs, language.fit(docs))
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.deduplicate(table(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balls.cluster(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_html_text": op1_html_text,
        "op2_secret_ownership": op2_secret_ownership,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_mix_sources": op4_mix_sources,
        "op5_embedding_neardup": op5_embedding_neardup,
        "op6_decontaminate": op6_decontaminate,
        "op7_lm_score": op7_lm_score,
        "lm_base_scores": lm_base_scores,
        "op8_language_id": op8_language_id,
        "op9_chat_format": op9_chat_format,
        "op10_minhash_neardup": op10_minhash_neardup,
        "op11_line_dedup": op11_line_dedup,
        "op12_vector_codes": op12_vector_codes,
        "op13_ball_kmeans": op13_ball_kmeans,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_secret_ownership": secrets.SCAN_SQL,
        "op3_suffix_dedup": suffix.DIGEST_SQL,
        "op4_mix_sources": mixing.MIX_SQL,
        "op5_embedding_neardup": vectors.LINK_SQL,
        "op6_decontaminate": decontaminate.DIGEST_SQL,
        "lm_base_scores": lm.BASE_SQL,
        "op9_chat_format": chat.DIGEST_SQL,
        "op10_minhash_neardup": neardup.LINK_SQL,
        "op11_line_dedup": lines.DIGEST_SQL,
        "op12_vector_codes": codes.COMPRESS_SQL,
        "op13_ball_kmeans": balls.CLUSTER_SQL,
    }
