"""A corpus pipeline of five stages, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.line_dedup import dedup_lines
from tessera.llm.mixing import in_shards, materialise, mix
from tessera.llm.near_dedup import near_duplicates
from tessera.llm.packing import pack
from tessera.llm.quality_rules import quality_rules
from tessera.sources.scratch import stored


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that has lost all its lines goes.

    n_chars follows the text.
    """
    out = dedup_lines(docs).where("n_lines > n_removed or n_lines = 0")
    if "n_chars" in docs.columns:
        out = out.selectExpr(*[f"case when n_removed > 0 then length(text) else n_chars end as {c}" if c == "n_chars" else f"`{c}`" for c in docs.columns])
    return out.select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, 0.8): that of the smallest doc_id.

    Every row is a document of its own, so neither a text under an id that others have nor one
    without an id is taken for another: rows of one id are compared like any others, and of
    those linked one stays.  Null ids come last: a row with a null id goes if its group has an
    id, and of a group without ids one row stays.  Ties are broken by a hash of the row.
    Texts without words are linked with nothing and all stay.
    """
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = near_duplicates(rows, key="__row").select(F.col("doc_id").alias("__row"), "component_id")
    found = stored(found.join(rows.select("__row", "doc_id", F.xxhash64(*docs.columns).alias("__hash")), "__row"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "__hash", "__row")
    stay = found.groupBy("component_id").agg(F.min(rank).alias("least")).select("least.__row")
    # the rows that go: fewer than those that stay, and no text is shuffled twice
    gone = stored(found.select("__row").join(stay, "__row", "left_anti"))
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per copy of a document, by shard and in the shard's shuffled order."""
    return in_shards(materialise(mix(docs))).select(*docs.columns)


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each row in the length buckets' batches."""
    return pack(docs)


STAGES = [("quality_rules", rules), ("line_dedup", lines), ("near_dedup", near), ("mixing", mixture), ("packing", batches)]

#: Estimated rules, bottom-k sketches and hypergeometric draws have no SQL; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
