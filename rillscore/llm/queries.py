"""The queries opN_<name> over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "piece_bpe_32k.model"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _crc(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.toxicity import fit_toxicity, score_toxicity

    docs = _read(spark, sf_dir, "documents")
    held_out = _crc() % 4 == 2
    model = fit_toxicity(docs, _read(spark, sf_dir, "labels"), ~held_out)
    out = score_toxicity(docs, model, threshold=0.3)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.mixing import mix_sources

    return mix_sources(_read(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.decontaminate import find_benchmark

    return find_benchmark(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=5, least=0.8)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.search import search

    return search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.chat import digests, format_chats

    text = "</s>[INST] ok [/INST]"
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql(f"SELECT -7L AS conv_id, t.* FROM VALUES (0L, 'user', '{text}'), (1L, 'assistant', '{text}') AS t(turn, role, text)")
    return digests(format_chats(turns.unionByName(more)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.langid import fit_language_id, identify_language

    docs = _read(spark, sf_dir, "documents")
    held_out = _crc() % 5 == 0
    out = identify_language(docs, fit_language_id(docs, ~held_out))
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from rillscore.llm.tokencount import count_tokens

    return count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.warc import round_trip

    return round_trip(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.neardup import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rillscore.llm.urls import filter_urls

    return filter_urls(_read(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if (k.startswith("op") or k == "pipeline") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from rillscore.llm import chat, mixing, urls, warc

    return {"op2_mix_sources": mixing.ORACLE, "op5_chat_format": chat.oracle(), "op8_warc": warc.ORACLE, "op10_url_filters": urls.oracle()}
