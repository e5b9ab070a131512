"""Quality of scored, labelled pairs: (label, score, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.config import EVAL_THRESHOLDS
from tessera.sources.scratch import stored


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def confusion(df: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """One row (tn, fp, fn, tp)."""
    hit, true = F.col(score) >= threshold, F.col(label) == 1
    return df.agg(_count(~hit & ~true).alias("tn"), _count(hit & ~true).alias("fp"), _count(~hit & true).alias("fn"), _count(hit & true).alias("tp"))


def _quality(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """precision, recall, f1; 0 where undefined."""
    part = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return {"precision": part(tp, tp + fp), "recall": part(tp, tp + fn), "f1": part(2 * tp, 2 * tp + fp + fn)}


def at_thresholds(df: DataFrame, thresholds: tuple[float, ...] | list[float] = EVAL_THRESHOLDS, by: list[str] | None = None, label: str = "label", score: str = "score") -> DataFrame:
    """(by..., threshold, precision, recall, f1), all thresholds in one pass over the rows."""
    hits = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), (F.col(score) >= t).alias("hit")) for t in thresholds])
    long = df.select(*(by or []), (F.col(label) == 1).alias("true"), F.explode(hits).alias("h"))
    counts = long.groupBy(*(by or []), "h.threshold").agg(
        _count(F.col("h.hit") & F.col("true")).alias("tp"), _count(F.col("h.hit") & ~F.col("true")).alias("fp"), _count(~F.col("h.hit") & F.col("true")).alias("fn")
    )
    return counts.select(*(by or []), "threshold", *[F.round(c, 6).alias(k) for k, c in _quality(F.col("tp"), F.col("fp"), F.col("fn")).items()])


def best_f1_threshold(df: DataFrame, low: int = 50, high: int = 98, label: str = "label", score: str = "score") -> DataFrame:
    """One row (threshold, f1): the best of low/100 .. high/100; ties take the lowest."""
    grid = [i / 100 for i in range(low, high + 1)]
    swept = at_thresholds(df, grid, None, label, score)
    return swept.orderBy(F.desc("f1"), "threshold").limit(1).select("threshold", "f1")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row (auc), exact: the rank sum of the positives, ties at their average rank.

    Equal scores are counted first.  The running total over the distinct scores is taken
    per range of scores and then over the ranges, so no task sees them all.
    """
    per = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(F.count("*").alias("n"), _count(F.col(label) == 1).alias("pos"))
    per = per.repartitionByRange("s").withColumn("part", F.spark_partition_id())
    per = stored(per)
    parts = per.groupBy("part").agg(F.sum("n").alias("pn"))  # a row per partition
    parts = parts.withColumn("before", F.coalesce(F.sum("pn").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    inside = F.coalesce(F.sum("n").over(W.partitionBy("part").orderBy("s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = per.withColumn("inside", inside).join(F.broadcast(parts), "part")
    rank = F.col("before") + F.col("inside") + (F.col("n") + 1) / 2
    sums = ranked.agg(F.sum(rank * F.col("pos")).alias("r"), F.sum("pos").cast("double").alias("p"), F.sum(F.col("n") - F.col("pos")).cast("double").alias("q"))
    return sums.select(F.round((F.col("r") - F.col("p") * (F.col("p") + 1) / 2) / F.nullif(F.col("p") * F.col("q"), F.lit(0.0)), 6).alias("auc"))


def slice_accuracy(df: DataFrame, by: str, threshold: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """(by, n, accuracy)."""
    right = (F.col(score) >= threshold) == (F.col(label) == 1)
    return df.groupBy(by).agg(F.count("*").alias("n"), F.round(F.avg(right.cast("double")), 6).alias("accuracy"))


def by_group(df: DataFrame, by: str, threshold: float = 0.5, min_positives: int = 50, label: str = "label", score: str = "score") -> DataFrame:
    """(by, n, positives, precision, recall, f1) of groups with enough positives."""
    hit, true = F.col(score) >= threshold, F.col(label) == 1
    counts = df.groupBy(by).agg(
        F.count("*").alias("n"), _count(true).alias("positives"), _count(hit & true).alias("tp"), _count(hit & ~true).alias("fp"), _count(~hit & true).alias("fn")
    )
    quality = [F.round(c, 6).alias(k) for k, c in _quality(F.col("tp"), F.col("fp"), F.col("fn")).items()]
    return counts.where(F.col("positives") >= min_positives).select(by, "n", "positives", *quality)


def group_counts(df: DataFrame, *by: str, label: str = "label") -> DataFrame:
    """(by..., n, positives)."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("positives"))
