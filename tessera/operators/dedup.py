"""Full deduplication: stop-list, candidate pairs, scores, threshold, clusters, export."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import CALIBRATION_GRID, CALIBRATION_TARGET, MAX_BLOCK, MIN_NAME, STOP_FREQ, UNRESOLVED, Columns
from tessera.functions.phonetic import with_phonetic_key
from tessera.functions.text import on_distinct, prep
from tessera.operators.blocking import blocking_keys, candidate_pairs
from tessera.operators.graph import connected_components
from tessera.sources.scratch import stored


def with_lat(df: DataFrame, name: str) -> DataFrame:
    """df with lat, the comparison key of its names, derived once per distinct name."""
    return on_distinct(df, name, lambda c: {"lat": prep(c)})


def stop_list(df: DataFrame, company: str, stop_freq: int = STOP_FREQ, min_name: int = MIN_NAME, lat: str = "lat") -> DataFrame:
    """(lat): keys of at least stop_freq distinct companies, and keys that are too short."""
    often = df.groupBy(F.col(lat).alias("lat")).agg(F.count_distinct(company).alias("n"))
    return often.where((F.col("n") >= stop_freq) | (F.length("lat") < min_name)).select("lat")


def stop_share(df: DataFrame, stops: DataFrame) -> DataFrame:
    """One row (n_rows, n_stopped, share, n_names)."""
    marked = df.select("lat").join(stops.withColumn("_s", F.lit(1)), "lat", "left")
    n, hit = F.count("*"), F.count("_s")
    return marked.agg(n.alias("n_rows"), hit.alias("n_stopped"), F.round(hit / F.nullif(n, F.lit(0)), 6).alias("share"), F.count_distinct(F.when(F.col("_s") == 1, F.col("lat"))).alias("n_names"))


def name_nodes(df: DataFrame, stops: DataFrame) -> DataFrame:
    """(name_id, lat): names to resolve.  The id is a hash of the name, the same in every run."""
    names = df.select("lat").distinct().join(stops, "lat", "left_anti")
    return names.withColumn("name_id", F.xxhash64("lat"))


def components_of(names: DataFrame, edges: DataFrame) -> DataFrame:
    """(name_id, component) for all names; a name without edges is its own component."""
    found = connected_components(edges)
    joined = names.select("name_id").join(found, F.col("name_id") == found["node"], "left")
    return joined.select("name_id", F.coalesce("component", "name_id").alias("component"))


def cross_country(rows: DataFrame, cluster: str = "cluster_id", country: str = "country", include_unresolved: bool = False) -> DataFrame:
    """One row (n): clusters with records of two countries or more."""
    seen = rows if include_unresolved else rows.where(F.col(cluster) != UNRESOLVED)
    return seen.groupBy(cluster).agg(F.count_distinct(country).alias("c")).where("c > 1").agg(F.count("*").alias("n"))


def assign_clusters(df: DataFrame, names: DataFrame, components: DataFrame) -> DataFrame:
    """df with cluster_id: the component of its name, UNRESOLVED for stopped names."""
    labels = names.join(components, "name_id").select("lat", F.col("component").alias("cluster_id"))
    return df.drop("cluster_id").join(labels, "lat", "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(UNRESOLVED).cast("long")))


def calibration_sweep(
    df: DataFrame, names: DataFrame, scored: DataFrame, grid: tuple[float, ...] = CALIBRATION_GRID, country: str = "country", include_unresolved: bool = False
) -> DataFrame:
    """A row per threshold: edges, clusters, dup_share over all rows, max_cluster, cross_country.

    The edge sets are nested, so each threshold starts from the components of the next higher
    one: only edges between different components of it remain.
    """
    spark = df.sparkSession
    base = df.select("lat", country).groupBy("lat", country).agg(F.count("*").alias("w"))
    names = stored(names)
    known = names.select("name_id", F.col("name_id").alias("component"))
    rows = []
    for t in sorted(grid, reverse=True):
        edges = scored.where(F.col("score") >= t)
        left = known.select(F.col("name_id").alias("src"), F.col("component").alias("cs"))
        right = known.select(F.col("name_id").alias("dst"), F.col("component").alias("cd"))
        between = edges.select("src", "dst").join(left, "src").join(right, "dst").where("cs <> cd").select(F.col("cs").alias("src"), F.col("cd").alias("dst"))
        merged = connected_components(between)
        known = known.join(merged, known["component"] == merged["node"], "left").select("name_id", F.coalesce(merged["component"], known["component"]).alias("component"))
        known = stored(known)
        clustered = assign_clusters(base, names, known)
        per = clustered.groupBy("cluster_id").agg(F.sum("w").alias("n"), F.count_distinct(country).alias("c"))
        real = F.col("cluster_id") != UNRESOLVED
        counted = F.lit(True) if include_unresolved else real
        found = per.agg(
            F.count(F.when(real, 1)).alias("clusters"),
            F.coalesce(F.sum(F.when(real & (F.col("n") > 1), F.col("n"))) / F.sum("n"), F.lit(0.0)).alias("dup"),
            F.max(F.when(real, F.col("n"))).alias("largest"),
            F.count(F.when(counted & (F.col("c") > 1), 1)).alias("cross"),
        ).first()
        rows.append((float(t), edges.count(), found["clusters"], round(found["dup"], 6), found["largest"], found["cross"]))
    return spark.createDataFrame(rows[::-1], "threshold double, edges long, clusters long, dup_share double, max_cluster long, cross_country long")


def choose_threshold(sweep: DataFrame, target: int = CALIBRATION_TARGET) -> float:
    """The threshold nearest to the target number of cross-country clusters; ties take the lowest."""
    best = sweep.orderBy(F.abs(F.col("cross_country") - target), "threshold").first()
    return best["threshold"]


def cluster_sizes(rows: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return rows.where(F.col(cluster) != UNRESOLVED).groupBy(cluster).agg(F.count("*").alias("n"))


def cluster_report(rows: DataFrame, country: str = "country") -> DataFrame:
    """One row: clusters, records, dup_share of resolved rows, quantiles (truncated), multi_country.

    Where nothing is resolved the counts are 0, and the share, the quantiles and the largest are null.
    """
    per = rows.where(F.col("cluster_id") != UNRESOLVED).groupBy("cluster_id").agg(F.count("*").alias("n"), F.count_distinct(country).alias("c"))
    many = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    return per.agg(
        F.count("*").alias("clusters"),
        F.coalesce(many, F.lit(0)).alias("records_in_groups"),
        F.round(many / F.sum("n"), 6).alias("dup_share"),
        *[F.percentile("n", F.lit(q)).cast("long").alias(k) for q, k in ((0.5, "p50"), (0.9, "p90"), (0.99, "p99"), (0.999, "p999"))],
        F.max("n").alias("max_cluster"),
        F.count(F.when(F.col("c") > 1, 1)).alias("multi_country"),
    )


def gold_recall(rows: DataFrame, gold: str) -> DataFrame:
    """One row (entities, whole, whole_resolved, share, share_resolved): gold entities whose records are in one cluster.

    An entity of which nothing is resolved counts as whole in share, not in share_resolved.
    """
    per = rows.where(F.col(gold).isNotNull()).groupBy(gold).agg(F.count_distinct("cluster_id").alias("c"), F.min("cluster_id").alias("lo"))
    whole = F.col("c") == 1
    solved = whole & (F.col("lo") != UNRESOLVED)
    n = F.nullif(F.count("*"), F.lit(0))
    return per.agg(
        F.count("*").alias("entities"),
        F.count(F.when(whole, 1)).alias("whole"),
        F.count(F.when(solved, 1)).alias("whole_resolved"),
        F.round(F.count(F.when(whole, 1)) / n, 6).alias("share"),
        F.round(F.count(F.when(solved, 1)) / n, 6).alias("share_resolved"),
    )


@dataclass
class DedupResult:
    rows: DataFrame
    names: DataFrame
    scored: DataFrame
    sweep: DataFrame | None
    threshold: float


def deduplicate(
    df: DataFrame,
    score: Callable[[DataFrame, DataFrame], DataFrame],
    columns: Columns = Columns(),
    threshold: float | None = None,
    max_block: int = MAX_BLOCK,
    soundex: bool = False,
    stop_freq: int = STOP_FREQ,
) -> DedupResult:
    """The whole pipeline over a relations table.

    score(pairs (src, dst), names (name_id, lat, phon)) gives (src, dst, score).  Pairs are
    scored once; threshold None is chosen by the sweep.
    """
    keyed = stored(with_lat(df, columns.name))
    names = stored(with_phonetic_key(name_nodes(keyed, stop_list(keyed, columns.company_id, stop_freq))))
    pairs = stored(candidate_pairs(blocking_keys(names, soundex=soundex), max_block))
    scored = stored(score(pairs, names))
    sweep = None
    if not threshold:
        sweep = calibration_sweep(keyed, names, scored, country=columns.country)
        threshold = choose_threshold(sweep)
    rows = assign_clusters(keyed, names, components_of(names, scored.where(F.col("score") >= threshold)))
    return DedupResult(rows, names, scored, sweep, threshold)


def export(rows: DataFrame, path: str, columns: Columns = Columns()) -> None:
    """record_id, country, party_type and cluster_id as Parquet."""
    rows.select(columns.record_id, columns.country, columns.party_type, "cluster_id").write.mode("overwrite").parquet(path)
