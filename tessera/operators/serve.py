"""Answers to requests: pair check, search and batch deduplication, over DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.config import MAX_BATCH, MAX_BLOCK_BATCH, MAX_TOP_K, REQUEST_THRESHOLD, TOP_K
from tessera.functions.phonetic import with_phonetic_key
from tessera.functions.similarity import pair_features
from tessera.functions.text import on_distinct, prep
from tessera.operators.blocking import blocking_keys, candidate_pairs
from tessera.operators.graph import connected_components
from tessera.operators.model import Matcher, featured
from tessera.sources.scratch import stored


class NotReady(RuntimeError):
    """No model, or no index, is loaded."""


class BadRequest(ValueError):
    """A request outside its limits."""


def _prepared(df: DataFrame, name: str) -> DataFrame:
    return with_phonetic_key(on_distinct(df, name, lambda c: {"lat": prep(c)}))


def _keys(names: DataFrame, spoken: bool) -> DataFrame:
    return blocking_keys(names, phon="phon" if spoken else None, soundex=spoken)


@dataclass
class NameIndex:
    """names (name_id, name, lat, phon) and their keys, held by the executors in partitions of
    key, so that a request shuffles its own few keys only.  Keys are not capped.

    spoken: whether names also meet at phonetic and Soundex keys.
    """

    names: DataFrame
    keys: DataFrame
    spoken: bool = True

    @classmethod
    def build(cls, names: DataFrame, spoken: bool = True) -> NameIndex:
        """From (name); equal raw names are one entry."""
        named = stored(_prepared(names.select("name").where("name is not null").distinct(), "name").withColumn("name_id", F.xxhash64("name")))
        keys = stored(_keys(named, spoken))
        return cls(named, keys.repartition("key_type", "key").persist(StorageLevel.MEMORY_AND_DISK), spoken)


@dataclass
class Service:
    matcher: Matcher | None = None
    index: NameIndex | None = None

    def health(self) -> dict:
        return {"status": "ok", "model_loaded": self.matcher is not None, "index_size": self.index.names.count() if self.index else 0}

    def _model(self) -> Matcher:
        if self.matcher is None:
            raise NotReady("no model is loaded")
        return self.matcher

    def check_duplicates(self, pairs: DataFrame, threshold: float = REQUEST_THRESHOLD) -> DataFrame:
        """pairs (left, right) with left_normalized, right_normalized, probability, is_duplicate, threshold."""
        model = self._model()
        raw = pairs.select("left", "right").distinct()
        both = on_distinct(on_distinct(raw, "left", lambda c: {"left_normalized": prep(c)}), "right", lambda c: {"right_normalized": prep(c)})
        scored = model.predict(featured(both.select(F.col("left").alias("_l"), F.col("right").alias("_r"), F.col("left_normalized").alias("left"), F.col("right_normalized").alias("right"))), "probability")
        found = scored.select("_l", "_r", F.col("left").alias("left_normalized"), F.col("right").alias("right_normalized"), "probability")
        out = pairs.join(found, pairs["left"].eqNullSafe(found["_l"]) & pairs["right"].eqNullSafe(found["_r"])).drop("_l", "_r")
        return out.withColumns({"is_duplicate": F.col("probability") >= threshold, "threshold": F.lit(float(threshold))})

    def check_duplicate(self, spark: SparkSession, left: str, right: str, threshold: float = REQUEST_THRESHOLD) -> dict:
        return self.check_duplicates(spark.createDataFrame([(left, right)], "left string, right string"), threshold).drop("left", "right").first().asDict()

    def search(self, queries: DataFrame, top_k: int = TOP_K, min_score: float = 0.0) -> DataFrame:
        """(query, normalized, rank, name, score, candidates): the best entries of the index for
        each query; the best top_k first, of those the ones of min_score or more.
        """
        model = self._model()
        if self.index is None:
            raise NotReady("the index is empty")
        if not 1 <= top_k <= MAX_TOP_K or not 0 <= min_score <= 1:
            raise BadRequest("top_k or min_score out of range")
        asked = stored(_prepared(queries.select(F.col("query")).distinct(), "query").withColumn("name_id", F.xxhash64("query")))
        probes = _keys(asked, self.index.spoken).withColumnRenamed("name_id", "query_id")
        found = probes.join(self.index.keys, ["key_type", "key"]).select("query_id", "name_id").distinct()
        left = asked.select(F.col("name_id").alias("query_id"), "query", F.col("lat").alias("left"), F.col("phon").alias("left_phon"))
        right = self.index.names.select("name_id", "name", F.col("lat").alias("right"), F.col("phon").alias("right_phon"))
        scored = model.predict(pair_features(found.join(left, "query_id").join(right, "name_id")), "score")
        per = W.partitionBy("query_id")
        ranked = scored.withColumns({"rank": F.row_number().over(per.orderBy(F.desc("score"), "name")), "candidates": F.count("*").over(per)})
        best = ranked.where((F.col("rank") <= top_k) & (F.col("score") >= min_score))
        return best.select("query", F.col("left").alias("normalized"), "rank", "name", "score", "candidates")

    def deduplicate_batch(self, names: DataFrame, threshold: float = REQUEST_THRESHOLD, limit: int | None = MAX_BATCH, spoken: bool = True) -> DataFrame:
        """names (position, name) with cluster_id, numbered from 0 by first position.

        Keys of 2 to 200 names, the phonetic ones and Soundex too if spoken, no stop-list.
        limit None lifts the request's size.
        """
        model = self._model()
        if not 0 <= threshold <= 1:
            raise BadRequest("threshold out of range")
        if limit and names.limit(limit + 1).count() > limit:
            raise BadRequest(f"more than {limit} names")
        keyed = stored(_prepared(names, "name"))
        ids = stored(keyed.select(F.col("position").alias("name_id"), "lat", "phon"))
        pairs = candidate_pairs(_keys(ids, spoken), MAX_BLOCK_BATCH)
        edges = model.score_pairs(pairs, ids).where(F.col("score") >= threshold)
        found = connected_components(edges)
        first = keyed.select("position", "name").join(found, F.col("position") == found["node"], "left").select("position", "name", F.coalesce("component", "position").alias("first"))
        # components are named by their first position; numbers count the names of components
        heads = first.select("first").distinct().withColumn("cluster_id", (F.row_number().over(W.orderBy("first")) - 1).cast("int"))  # a request
        return first.join(heads, "first").select("position", "name", "cluster_id")
