"""The registered queries of the llm operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import bpe_codec, chat_format, exact, language, line_dedup, minhash, packing, passages, quality, token_files
from quillstone.llm.oracles import ORACLES
from quillstone.llm.session import own_path


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").cast(conversations.schema["turn"].dataType).alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat_format.digest(chat_format.format_conversations(conversations.unionByName(more)))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), size=4, percent=80)


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passages.dedup_passages(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_sentences").alias("n_sentences"), F.col("__n_removed").alias("n_removed"), F.col("__removed_words").alias("removed_words"), "text")


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_codec.digest(_read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"), runs=True)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text")


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_read(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = own_path(spark, "token-files")  # the result is read from there, so the files stay as long as the driver
    token_files.write(_read(spark, sf_dir, "documents"), path, _vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, path)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return language.predict(documents, language.fit(documents, language.remainder(F.col("doc_id")) != 2))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return quality.judge(documents, quality.fit(documents, _read(spark, sf_dir, "labels")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), end_id=2, capacity=1024)


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_minhash, op3_passages, op4_bpe_codec, op5_line_dedup, op6_exact, op7_token_files, op8_language, op9_quality, op10_packing)}

__all__ = ["ORACLES", "QUERIES"]
