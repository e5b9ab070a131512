"""Exact matches of names across countries, and coverage of partial labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedup import with_lat


def shared_keys(df: DataFrame, name: str, country: str) -> DataFrame:
    """(lat, countries): keys with records in two countries or more; null names and empty keys are left out."""
    keyed = with_lat(df.where(F.col(name).isNotNull()).select(name, country), name)
    return keyed.where(F.length("lat") > 0).groupBy("lat").agg(F.count_distinct(country).alias("countries")).where("countries > 1")


def distribution(shared: DataFrame) -> DataFrame:
    """(countries, keys)."""
    return shared.groupBy("countries").agg(F.count("*").alias("keys"))


def against_expected(shared: DataFrame, expected: int) -> DataFrame:
    """One row (found, expected, delta)."""
    return shared.agg(F.count("*").alias("found")).select("found", F.lit(expected).cast("long").alias("expected"), (F.col("found") - expected).alias("delta"))


def gold_coverage(df: DataFrame, gold: str, country: str) -> DataFrame:
    """One row (entities, multi_country)."""
    per = df.where(F.col(gold).isNotNull()).groupBy(gold).agg(F.count_distinct(country).alias("c"))
    return per.agg(F.count("*").alias("entities"), F.count(F.when(F.col("c") > 1, 1)).alias("multi_country"))
