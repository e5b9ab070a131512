"""The registered queries of the corpus operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.oracles import ORACLES

__all__ = ["QUERIES", "ORACLES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join(F.col("votes").cast("array<string>"), ",").alias("votes"),
        F.round("good_probability", 6).alias("good_probability"),
    )


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.warc import new_folder, read_warc, write_warc

    records = read_warc(write_warc(table(spark, sf_dir, "pages"), new_folder(spark)), keep_payload=False)
    key = lambda c: F.col(c).cast("long")
    return records.select(
        F.nullif(F.col("record_key"), F.lit("")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        key("refers_to").alias("refers_to"),
        "target_uri",
    )


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.mixing import mix

    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", F.col("copies.shard").alias("shards"), F.col("copies.order").alias("orders"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=100, keep_bytes=False).drop("kept")


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.near_dedup import NearSpec, near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), NearSpec(n=3, percent=85))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.line_dedup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.ann import search

    return search(table(spark, sf_dir, "embeddings"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality_classifier import classify

    return classify(table(spark, sf_dir, "documents"))


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.chat_format import format_chat, turns_as_calls

    return format_chat(turns_as_calls(table(spark, sf_dir, "conversations")))
