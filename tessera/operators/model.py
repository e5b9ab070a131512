"""Gradient-boosted trees over the pair features."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.phonetic import with_phonetic_key
from tessera.functions.similarity import FEATURES, pair_features
from tessera.sources.scratch import stored

DESCRIPTIONS = {
    "ratio": "matching characters in order",
    "token_sort": "the same after sorting the words",
    "token_set": "the same over sets of words",
    "partial": "best match of the shorter name inside the longer",
    "jaro_winkler": "matching characters near each other, start weighted",
    "levenshtein": "edit distance",
    "len_diff": "difference of lengths",
    "tok_diff": "difference of word counts",
    "same_phon": "equal phonetic keys",
    "same_init": "equal initials",
    "min_tokens": "words of the shorter name",
}


@dataclass
class Matcher:
    """A trained classifier and the order of its features."""

    model: GBTClassificationModel
    features: tuple[str, ...] = FEATURES

    def predict(self, featured: DataFrame, out: str = "proba") -> DataFrame:
        """featured with the probability that a pair is one entity; no rows give no rows."""
        vector = VectorAssembler(inputCols=list(self.features), outputCol="_vector").transform(featured)
        scored = self.model.transform(vector)
        scored = scored.withColumn("_proba", vector_to_array("probability")[1])
        return scored.drop("_vector", "rawPrediction", "probability", "prediction").withColumnRenamed("_proba", out)

    def score_pairs(self, pairs: DataFrame, names: DataFrame) -> DataFrame:
        """(src, dst, score) of pairs of ids, by names (name_id, lat, phon)."""
        side = lambda k, n: names.select(F.col("name_id").alias(k), F.col("lat").alias(n), F.col("phon").alias(f"{n}_phon"))
        joined = pairs.join(side("src", "left"), "src").join(side("dst", "right"), "dst")
        return self.predict(pair_features(joined), "score").select("src", "dst", "score")

    def importances(self) -> list[tuple[str, float, str]]:
        """(feature, gain, description), largest first."""
        gains = zip(self.features, self.model.featureImportances.toArray().tolist(), strict=True)
        return sorted(((f, g, DESCRIPTIONS[f]) for f, g in gains), key=lambda x: (-x[1], x[0]))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(self.features),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/features")

    @classmethod
    def load(cls, path: str) -> Matcher:
        """A saved matcher; an error if its features are not those of this version."""
        spark = SparkSession.getActiveSession()
        features = tuple(json.loads(spark.read.text(f"{path}/features").first()[0]))
        if features != FEATURES:
            raise ValueError(f"the model was trained on other features: {features}")
        return cls(GBTClassificationModel.load(f"{path}/model"), features)


@dataclass
class RuleMatcher(Matcher):
    """A fixed score in the place of a trained model: one feature."""

    model: None = None
    feature: str = "levenshtein"

    def predict(self, featured: DataFrame, out: str = "proba") -> DataFrame:
        return featured.withColumn(out, F.col(self.feature))


def featured(pairs: DataFrame) -> DataFrame:
    """pairs (left, right, ...) with phonetic keys and features."""
    left = with_phonetic_key(pairs, "left", "left_phon")
    return pair_features(with_phonetic_key(left, "right", "right_phon"))


def train(pairs: DataFrame, rounds: int = 500, depth: int = 5, rate: float = 0.05, tolerance: float = 1e-4, seed: int = 42) -> Matcher:
    """Fit on split train, stop early by split valid once a round gains less than the tolerance.

    pairs: (features, label, split).
    """
    rows = stored(pairs.where(F.col("split").isin("train", "valid")).select(*FEATURES, F.col("label").cast("double").alias("label"), (F.col("split") == "valid").alias("_valid")))
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector").transform(rows)
    learner = GBTClassifier(
        featuresCol="_vector", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=rate, validationIndicatorCol="_valid", validationTol=tolerance, seed=seed
    )
    return Matcher(learner.fit(data))
