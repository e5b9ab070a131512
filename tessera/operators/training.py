"""Labelled pairs: corrupted names, namesakes and random pairs, split by entity."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.corrupt import corrupted
from tessera.functions.similarity import token_sort_score
from tessera.functions.text import n_tokens, on_distinct, prep, tokens
from tessera.sources.io import sample_exact
from tessera.sources.scratch import stored

POSITIVE, NAMESAKE, RANDOM = "синтетический дубль", "однофамильцы", "случайные"
#: Cumulative shares of pairs with 1, 2 and 3 corruptions (5 : 3 : 2).
_OPS = (0.5, 0.8)
#: Samples are drawn by other hashes than the split, or a sample would be of one split.
_SAMPLE = 1_000
PAIR_COLUMNS = ("left", "right", "label", "n_ops", "kind")


def _unit(seed: int, *keys: str) -> Column:
    """A number in [0, 1) from a hash of the keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 53)) / float(1 << 53)


def positive_pairs(names: DataFrame, n: int = 60_000, seed: int = 42, name: str = "name") -> DataFrame:
    """Names and their corruptions that differ from them, both as comparison keys."""
    some = sample_exact(names.select(F.col(name).alias("name")), n, seed + _SAMPLE, ["name"])
    u = _unit(seed + 1, "name")
    some = some.withColumn("n_ops", F.when(u < _OPS[0], 1).when(u < _OPS[1], 2).otherwise(3))
    # stored, since a Python function does not take a higher-order expression for its argument
    made = corrupted(F.col("name"), F.col("n_ops"), F.xxhash64(F.lit(seed), "name"))
    some = stored(some.select("name", "n_ops", made.getField("out").alias("other"))).where("other <> name")
    pairs = some.select(prep("name").alias("left"), prep("other").alias("right"), "n_ops")
    return pairs.select("left", "right", F.lit(1).alias("label"), "n_ops", F.lit(POSITIVE).alias("kind"))


def namesake_groups(lat_names: DataFrame, group_cap: int = 8, by_hash: bool = False, seed: int = 42) -> DataFrame:
    """(surname, lat): the first group_cap names of each first token, of names with two tokens or more.

    by_hash takes random ones instead of the first in order, which favours no letter.
    """
    df = lat_names.select("lat").distinct().where(n_tokens("lat") >= 2).withColumn("surname", F.get(tokens("lat"), F.lit(0)))
    order = [F.xxhash64(F.lit(seed), "lat"), F.col("lat")] if by_hash else [F.col("lat")]
    ranked = df.withColumn("_n", F.row_number().over(W.partitionBy("surname").orderBy(*order)))
    return ranked.where(F.col("_n") <= group_cap).drop("_n")


def hard_negatives(lat_names: DataFrame, n: int = 30_000, group_cap: int = 8, min_score: float = 0.6, by_hash: bool = False, seed: int = 42, score: Column | None = None) -> DataFrame:
    """For each name its most similar namesake, if similar enough; n pairs at most.

    Groups are cut to group_cap before the self-join.  score is an expression over left and
    right (token_sort by default).
    """
    groups = namesake_groups(lat_names, group_cap, by_hash, seed)
    pairs = groups.select("surname", F.col("lat").alias("left")).join(groups.select("surname", F.col("lat").alias("right")), "surname").where("left <> right")
    pairs = pairs.withColumn("_s", score if score is not None else token_sort_score("left", "right")).where(F.col("_s") >= min_score)
    best = pairs.withColumn("_n", F.row_number().over(W.partitionBy("left").orderBy(F.desc("_s"), "right"))).where("_n = 1")
    order = [F.xxhash64(F.lit(seed), "left")] if by_hash else [F.col("surname")]
    best = best.orderBy(*order, "left").limit(n)
    return best.select("left", "right", F.lit(0).alias("label"), F.lit(0).alias("n_ops"), F.lit(NAMESAKE).alias("kind"))


def easy_negatives(lat_names: DataFrame, n: int = 15_000, seed: int = 42) -> DataFrame:
    """n random pairs of names; a pair may be of one name."""
    spark = lat_names.sparkSession
    some = sample_exact(lat_names.select("lat").distinct(), max(n, 1), seed + _SAMPLE + 1, ["lat"])
    numbered = some.withColumn("i", F.row_number().over(W.orderBy(F.xxhash64(F.lit(seed), "lat"), "lat")) - 1)  # n rows
    total = numbered.agg(F.count("*").alias("total"))
    draws = spark.range(n).join(F.broadcast(total)).where("total > 0")
    pick = lambda k: F.pmod(F.xxhash64(F.lit(seed + k), "id"), F.col("total"))
    draws = draws.select(pick(2).alias("a"), pick(3).alias("b"))
    left, right = numbered.select(F.col("i").alias("a"), F.col("lat").alias("left")), numbered.select(F.col("i").alias("b"), F.col("lat").alias("right"))
    return draws.join(left, "a").join(right, "b").select("left", "right", F.lit(0).alias("label"), F.lit(0).alias("n_ops"), F.lit(RANDOM).alias("kind"))


def training_pairs(names: DataFrame, n_pos: int = 60_000, n_hard: int = 30_000, n_easy: int = 15_000, seed: int = 42, name: str = "name") -> DataFrame:
    """All three kinds together."""
    lat = on_distinct(names.select(F.col(name).alias("name")), "name", lambda c: {"lat": prep(c)}).select("lat")
    return positive_pairs(names, n_pos, seed, name).unionByName(hard_negatives(lat, n_hard, seed=seed)).unionByName(easy_negatives(lat, n_easy, seed))


def split_by_entity(pairs: DataFrame, train: float = 0.7, valid: float = 0.15, seed: int = 42, key: str = "left") -> DataFrame:
    """pairs with split train, valid or test; all pairs of one left name are in one split.

    The distinct names are ranked by a hash that SQL engines share, so shares are exact: they
    are taken as decimals, since 90000 * 0.7 is less than 63000 as a double.  The ranks come
    from counts per hash prefix, not from one sorted partition.
    """
    names = pairs.select(F.col(key).alias("_k")).distinct().withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), "_k")))
    names = names.withColumn("_p", F.substring("_h", 1, 3))
    before = names.groupBy("_p").agg(F.count("*").alias("c"))  # 4096 rows at most
    before = before.withColumn("_before", F.sum("c").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)))
    before = before.withColumn("_all", F.sum("c").over(W.partitionBy())).select("_p", F.coalesce("_before", F.lit(0)).alias("_before"), "_all")
    ranked = names.join(F.broadcast(before), "_p").withColumn("_r", F.col("_before") + F.row_number().over(W.partitionBy("_p").orderBy("_h", "_k")))
    upto = lambda share: F.col("_r") <= F.floor(F.col("_all") * F.lit(share))
    train, valid = Decimal(str(train)), Decimal(str(valid))
    split = F.when(upto(train), "train").when(upto(train + valid), "valid").otherwise("test")
    return pairs.drop("split").join(ranked.select("_k", split.alias("split")), F.col(key) == F.col("_k")).drop("_k")


def leakage(pairs: DataFrame, side: str = "left") -> DataFrame:
    """One row (n): names of this side in both the train and the test split."""
    part = lambda s: pairs.where(F.col("split") == s).select(side)
    return part("train").intersect(part("test")).agg(F.count("*").alias("n"))
