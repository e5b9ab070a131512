"""Profiling of any table: columns, categories, texts, partial labels, skew and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import has_more_cyrillic, n_tokens, normalize_light, script_label
from tessera.sources.io import sample_exact
from tessera.sources.scratch import stored

NAME_COLUMNS = ("party_name", "name", "full_name")
COUNTRY_COLUMNS = ("country", "country_code", "iso")


def profile_columns(df: DataFrame) -> DataFrame:
    """(column, dtype, n, null_share, n_distinct), all columns in one pass; nulls are no value.

    Columns without an order or equality (maps) have n_distinct -1.
    """
    plain = {f.name: not isinstance(f.dataType, T.MapType) for f in df.schema}
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(F.col(c)).alias(f"f{i}"))
        aggs.append(F.count_distinct(c).alias(f"d{i}") if plain[c] else F.lit(-1).cast("long").alias(f"d{i}"))
    one = df.agg(*aggs)
    kinds = dict(df.dtypes)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.col(f"f{i}").alias("f"), F.col(f"d{i}").alias("d")) for i, c in enumerate(df.columns)]
    long = one.select("_n", F.explode(F.array(*rows)).alias("r"))
    return long.select("r.column", "r.dtype", F.col("_n").alias("n"), F.round(1 - F.col("r.f") / F.nullif("_n", F.lit(0)), 6).alias("null_share"), F.col("r.d").alias("n_distinct"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n, share), null as a value; the most frequent first, ties by value."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy()) if top is None else None
    if top is None:
        return counts.withColumn("share", F.round(F.col("n") / total, 6))
    return counts.withColumn("share", F.round(F.col("n") / F.lit(df.count()), 6)).orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(top)


def _rows(df: DataFrame, profile: DataFrame | None) -> list[Row]:
    """The rows of profile_columns(), a row per column, from a profile at hand if there is one."""
    return (profile_columns(df) if profile is None else profile).collect()


def low_cardinality(df: DataFrame, limit: int = 50, profile: DataFrame | None = None) -> list[str]:
    """Columns with 1 to limit distinct values."""
    return [r["column"] for r in _rows(df, profile) if 0 < r["n_distinct"] <= limit]


def low_cardinality_values(df: DataFrame, columns: list[str], top: int = 50) -> DataFrame:
    """(column, value, n, share) of the columns' most frequent values, in one pass over the table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))
    order = W.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    share = F.col("n") / F.sum("n").over(W.partitionBy("column"))
    return counts.withColumns({"share": F.round(share, 6), "_r": F.row_number().over(order)}).where(F.col("_r") <= top).drop("_r")


def id_shares(df: DataFrame, column: str, probe: int | None = 5_000, keys: list[str] | None = None) -> DataFrame:
    """One row (no_space, code_like): shares of non-null values of a probe (of all, if None)."""
    values = df.select(F.col(column).cast("string").alias("v"), *[F.col(k).alias(f"_{k}") for k in keys or []]).where("v is not null")
    if probe:
        values = sample_exact(values, probe, 0, ["v", *[f"_{k}" for k in keys or []]])
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    return values.agg(share(~F.col("v").contains(" ")).alias("no_space"), share(F.col("v").rlike("^[A-Za-z0-9_\\-.:]+$")).alias("code_like"))


def looks_like_id(df: DataFrame, column: str, probe: int | None = 5_000) -> bool:
    """More than 95 % without spaces and of code characters; a column without values does."""
    r = id_shares(df, column, probe).first()
    return r["no_space"] is None or (r["no_space"] > 0.95 and r["code_like"] > 0.95)


def pick_text_columns(df: DataFrame, least: float = 0.01, probe: int | None = 5_000, profile: DataFrame | None = None) -> list[str]:
    """String columns with many different values that do not look like identifiers."""
    known = {r["column"]: r for r in _rows(df, profile)}
    many = [c for c, kind in df.dtypes if kind == "string" and known[c]["n"] and known[c]["n_distinct"] / known[c]["n"] >= least]
    return [c for c in many if not looks_like_id(df, c, probe)]


def _quantiles(c: Column, name: str, points: dict[str, float]) -> list[Column]:
    return [F.percentile(c, F.lit(q)).cast("long").alias(f"{name}_{k}") for k, q in points.items()]


def text_stats(df: DataFrame, column: str, sample: int | None = 200_000) -> DataFrame:
    """One row: lengths, words, single-word share, more-Cyrillic share, exact duplicate share."""
    values = df.select(F.col(column).cast("string").alias("v")).where("v is not null")
    if sample:
        values = sample_exact(values, sample, 0, ["v"])
    length, count = F.length("v"), n_tokens("v")
    return values.agg(
        F.count("*").alias("n"),
        F.min(length).alias("len_min"),
        *_quantiles(length, "len", {"p50": 0.5, "p95": 0.95}),
        F.max(length).alias("len_max"),
        *_quantiles(count, "tok", {"p50": 0.5, "p95": 0.95}),
        F.max(count).alias("tok_max"),
        F.round(F.avg((count == 1).cast("double")), 6).alias("single_token"),
        F.round(F.avg(has_more_cyrillic("v").cast("double")), 6).alias("more_cyrillic"),
        F.round(1 - F.count_distinct("v") / F.nullif(F.count("*"), F.lit(0)), 6).alias("dup_share"),
    )


def script_distribution(df: DataFrame, column: str) -> DataFrame:
    """(script, n, share)."""
    values = df.where(F.col(column).isNotNull()).select(script_label(column, profile=True).alias("script"))
    return value_counts(values, "script").withColumnRenamed("value", "script")


def length_histogram(df: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """(bin, low, n): lengths clipped at their 99th percentile in equal bins."""
    lengths = df.where(F.col(column).isNotNull()).select(F.length(column).cast("double").alias("x"))
    edge = lengths.agg(F.percentile("x", F.lit(0.99)).alias("hi"), F.min("x").alias("lo"))
    clipped = lengths.join(F.broadcast(edge)).select(F.least("x", "hi").alias("x"), "lo", "hi")
    width = F.nullif((F.col("hi") - F.col("lo")) / bins, F.lit(0.0))
    place = F.least(F.coalesce(F.floor((F.col("x") - F.col("lo")) / width), F.lit(0)), F.lit(bins - 1)).cast("int")
    return clipped.groupBy(place.alias("bin"), F.round(F.col("lo") + place * F.coalesce(width, F.lit(0.0)), 6).alias("low")).agg(F.count("*").alias("n"))


def bar_chart(df: DataFrame, column: str, top: int = 15) -> DataFrame:
    """(value, n) of the largest categories: the data of a bar chart."""
    return value_counts(df, column, top).select("value", "n")


def gold_scores(df: DataFrame, columns: list[str] | None = None, profile: DataFrame | None = None) -> DataFrame:
    """(column, filled, repeat, score) of columns that may label entities in part.

    filled in (0.001, 0.5), repeat = 1 - distinct / filled over 0.05; score is repeat times
    the smaller of 20 * filled and 1, twice that if the name has "id" in it.
    """
    rows = profile_columns(df.select(*columns) if columns else df) if profile is None else profile
    rows = rows.where("n_distinct >= 0")
    filled = 1 - F.col("null_share")
    rows = rows.select("column", filled.alias("filled"), (1 - F.col("n_distinct") / F.nullif(F.round(filled * F.col("n")), F.lit(0.0))).alias("repeat"))
    score = F.col("repeat") * F.least(20 * F.col("filled"), F.lit(1.0)) * F.when(F.lower("column").contains("id"), 2).otherwise(1)
    rows = rows.where((F.col("filled") > 0.001) & (F.col("filled") < 0.5) & (F.col("repeat") > 0.05))
    return rows.select("column", F.round("filled", 6).alias("filled"), F.round("repeat", 6).alias("repeat"), F.round(score, 6).alias("score"))


def find_gold(df: DataFrame, profile: DataFrame | None = None) -> str | None:
    """The column with the best score, the first of equal ones."""
    rows = {r["column"]: r["score"] for r in gold_scores(df, profile=profile).collect()}
    return max((c for c in df.columns if c in rows), key=lambda c: rows[c], default=None)


def entity_sizes(df: DataFrame, gold: str) -> DataFrame:
    return df.where(F.col(gold).isNotNull()).groupBy(F.col(gold).alias("gold")).agg(F.count("*").alias("n"))


def entity_stats(df: DataFrame, gold: str, pair_cap: int = 100) -> DataFrame:
    """One row: entities, records, groups, size quantiles, pairs, capped pairs, largest entity's share of pairs."""
    n = F.col("n")
    pairs = F.expr("n * (n - 1) div 2")
    return entity_sizes(df, gold).agg(
        F.count("*").alias("entities"),
        F.sum("n").alias("records"),
        F.count(F.when(n > 1, 1)).alias("groups"),
        *_quantiles(n, "size", {"p50": 0.5, "p90": 0.9, "p99": 0.99}),
        F.max("n").alias("size_max"),
        F.sum(pairs).alias("pairs"),
        F.sum(F.least(pairs, F.lit(pair_cap))).alias("pairs_capped"),
        F.round(F.max(pairs) / F.greatest(F.sum(pairs), F.lit(1)), 6).alias("largest_share"),
    )


def size_histogram(df: DataFrame, gold: str, top: int | None = 20) -> DataFrame:
    """(n, entities): how many entities have each size, smallest sizes first."""
    counts = entity_sizes(df, gold).groupBy("n").agg(F.count("*").alias("entities"))
    return counts.orderBy("n").limit(top) if top else counts


def members_of_groups(df: DataFrame, gold: str) -> DataFrame:
    """Rows of entities with two records or more."""
    return df.where(F.col(gold).isNotNull()).withColumn("_n", F.count("*").over(W.partitionBy(gold))).where("_n > 1").drop("_n")


def entity_difficulty(df: DataFrame, gold: str, name: str, country: str | None = None) -> DataFrame:
    """One row: among entities with several records the shares with one spelling, with several
    countries, with several scripts, and the mean of spellings / records.
    """
    rows = df.where(F.col(gold).isNotNull()).select(F.col(gold).alias("gold"), normalize_light(name).alias("name"), script_label(name, True).alias("script"), *([F.col(country).alias("country")] if country else []))
    per = rows.groupBy("gold").agg(
        F.count("*").alias("n"), F.count_distinct("name").alias("names"), F.count_distinct("script").alias("scripts"), *([F.count_distinct("country").alias("countries")] if country else [])
    ).where("n > 1")
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    out = [F.count("*").alias("groups"), share(F.col("names") == 1).alias("one_spelling"), share(F.col("scripts") > 1).alias("multi_script"), F.round(F.avg(F.col("names") / F.col("n")), 6).alias("variety")]
    return per.agg(*out, *([share(F.col("countries") > 1).alias("multi_country")] if country else []))


def category_skew(df: DataFrame, limit: int = 50, columns: int = 4, top: int = 3, profile: DataFrame | None = None) -> DataFrame:
    """(column, n_values, top_share): concentration of the first few categorical columns."""
    kept = [r["column"] for r in _rows(df, profile) if 1 < r["n_distinct"] <= limit]
    kept = [c for c in df.columns if c in kept][:columns]
    return skew_of(df, kept, top)


def skew_of(df: DataFrame, columns: list[str], top: int = 3) -> DataFrame:
    values = low_cardinality_values(df, columns, 1 << 30).withColumn("_r", F.row_number().over(W.partitionBy("column").orderBy(F.desc("n"), "value")))
    total = F.sum("n")
    return values.groupBy("column").agg(F.count("value").alias("n_values"), F.round(F.sum(F.when(F.col("_r") <= top, F.col("n"))) / total, 6).alias("top_share"))


def roles(df: DataFrame) -> dict[str, str | None]:
    """Which columns hold names and countries, by their names."""
    first = lambda known: next((c for c in known if c in df.columns), None)
    return {"name": first(NAME_COLUMNS), "country": first(COUNTRY_COLUMNS)}


def explore(df: DataFrame, gold: str | None = None, values: bool = True, sample: int | None = 200_000, texts: int = 6) -> dict[str, DataFrame]:
    """All profiling tables by name: the whole exploration of a table.

    gold None is looked for; values False leaves the categories' values out.
    """
    # the one full pass over all columns: a row per column
    columns = stored(profile_columns(df), small=True)
    out = {"columns": columns}
    low = low_cardinality(df, profile=columns)
    if values and low:
        out["low_cardinality"] = low_cardinality_values(df, low)
    for c in pick_text_columns(df, profile=columns)[:texts]:
        out[f"text:{c}"] = text_stats(df, c, sample)
        out[f"scripts:{c}"] = script_distribution(df, c)
        out[f"lengths:{c}"] = length_histogram(df, c)
    gold = gold or find_gold(df, columns)
    if gold:
        role = roles(df)
        out["entities"] = entity_stats(df, gold)
        out["sizes"] = size_histogram(df, gold)
        if role["name"]:
            out["difficulty"] = entity_difficulty(df, gold, role["name"], role["country"])
    out["skew"] = category_skew(df, profile=columns)
    return out
