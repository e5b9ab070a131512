"""Whole runs over a relations table: exploration, cross-country check, quality, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import MAX_BLOCK, STOP_FREQ, Settings
from tessera.functions.text import on_distinct, prep
from tessera.operators import crosscountry, dedup, evaluate, profile, training
from tessera.operators.model import Matcher, featured, train
from tessera.operators.report import report_lines
from tessera.sources.io import file_megabytes, read_table, sample_exact, write_csv, write_report
from tessera.sources.scratch import stored

PERSON, COMPANY = "individual", "legal_entity"
#: Cross-country matches that the published counts lead to expect.
EXPECTED = {PERSON: 3693, COMPANY: 182}


def explore(spark: SparkSession, path: str, out: str, gold: str | None = None, values: bool = True, rows: int | None = None) -> dict[str, DataFrame]:
    """Profile a Parquet or CSV table of any schema; writes out/eda_report."""
    df = read_table(spark, path, rows=rows)
    tables = profile.explore(df, gold, values)
    size = spark.createDataFrame([(df.count(), len(df.columns), file_megabytes(spark, path))], "rows long, columns int, megabytes double")
    write_report(spark, report_lines({"table": size} | tables), f"{out}/eda_report")
    return tables


def cross_country(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """Exact matches of persons and companies across countries, and coverage of the labels."""
    c = settings.columns
    df = read_table(spark, settings.data, [c.country, c.party_type, c.name, c.company_name, c.gold])
    people = crosscountry.shared_keys(df.where(F.col(c.party_type) == PERSON), c.name, c.country)
    firms = crosscountry.shared_keys(df.where(F.col(c.party_type) == COMPANY), c.name, c.country)
    names = crosscountry.shared_keys(df, c.company_name, c.country)
    tables = {"gold": crosscountry.gold_coverage(df, c.gold, c.country)}
    for title, shared, expected in (("persons", people, EXPECTED[PERSON]), ("companies", firms, EXPECTED[COMPANY]), ("company names", names, 0)):
        tables[title] = crosscountry.against_expected(shared, expected)
        tables[f"{title}: countries"] = crosscountry.distribution(shared)
    write_report(spark, report_lines(tables), f"{settings.work}/crosscountry_report")
    return tables


def person_names(spark: SparkSession, settings: Settings, n: int = 300_000, strict: bool = True) -> DataFrame:
    """(name, country) of n persons, the same in every run."""
    c = settings.columns
    df = read_table(spark, settings.data, [c.record_id, c.name, c.party_type, c.country]).where(F.col(c.party_type) == PERSON)
    some = sample_exact(df, n, settings.seed, [c.record_id, c.name, c.country], strict)
    return some.select(F.col(c.name).alias("name"), F.col(c.country).alias("country"))


def quality(spark: SparkSession, settings: Settings, n: int = 300_000, strict: bool = True, sizes: tuple[int, int, int] = (60_000, 30_000, 15_000), rounds: int = 500) -> dict[str, DataFrame]:
    """Train on synthetic pairs and evaluate; writes the model, the labelled test set and the report."""
    names = stored(person_names(spark, settings, n, strict))
    pairs = stored(featured(training.split_by_entity(training.training_pairs(names, *sizes, seed=settings.seed))))
    matcher = train(pairs, rounds=rounds, seed=settings.seed)
    matcher.save(f"{settings.work}/matcher")
    test = stored(matcher.predict(pairs.where("split = 'test'"), "score"))
    # the baseline's threshold comes from the training split alone
    base = evaluate.best_f1_threshold(pairs.where("split = 'train'"), score="token_set")
    edge = base.first()["threshold"]
    per_name = on_distinct(names, "name", lambda c: {"lat": prep(c)}).groupBy("lat").agg(F.min("country").alias("country"))
    by_country = test.join(per_name, test["left"] == per_name["lat"], "left")
    tables = {
        "pairs": evaluate.group_counts(pairs, "label", "kind"),
        "splits": evaluate.group_counts(pairs, "split"),
        "names in train and test, left": training.leakage(pairs),
        "names in train and test, right": training.leakage(pairs, "right"),
        "baseline threshold": base,
        "baseline": evaluate.at_thresholds(test, [edge], score="token_set"),
        "baseline AUC": evaluate.roc_auc(test, score="token_set"),
        "model": evaluate.at_thresholds(test, [0.5]),
        "model AUC": evaluate.roc_auc(test),
        "confusion": evaluate.confusion(test),
        "by corruptions": evaluate.slice_accuracy(test.where("label = 1"), "n_ops"),
        "by kind": evaluate.slice_accuracy(test, "kind"),
        "by country": evaluate.by_group(by_country, "country"),
        "thresholds": evaluate.at_thresholds(test),
        "importance": spark.createDataFrame(matcher.importances(), "feature string, gain double, description string"),
    }
    labelled = test.select("left", "right", "label", "kind", "n_ops", F.col("score").alias("proba"), (F.col("score") >= 0.5).cast("int").alias("pred"))
    write_csv(labelled, f"{settings.work}/test_set_labeled")
    write_report(spark, report_lines(tables), f"{settings.work}/quality_report")
    return tables


def deduplicate(
    spark: SparkSession, settings: Settings, threshold: float | None = None, sample: int | None = None, max_block: int = MAX_BLOCK, soundex: bool = False, stop_freq: int = STOP_FREQ
) -> dict[str, DataFrame]:
    """Resolve the table with the saved model (trained if there is none); writes the clusters and the report."""
    c = settings.columns
    df = read_table(spark, settings.data, [c.record_id, c.country, c.party_type, c.company_id, c.gold, c.name])
    if sample:
        df = sample_exact(df, sample, settings.seed, [c.record_id, c.name, c.country])
    try:
        matcher = Matcher.load(f"{settings.work}/matcher")
    except Exception as e:  # Spark has no one error for a missing path
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        quality(spark, settings, strict=False)
        matcher = Matcher.load(f"{settings.work}/matcher")
    done = dedup.deduplicate(df, matcher.score_pairs, c, threshold, max_block, soundex, stop_freq)
    rows = stored(done.rows)
    dedup.export(rows, f"{settings.work}/deduplicated.parquet", c)
    tables = {
        "stop-list": dedup.stop_share(rows, rows.where("cluster_id = -1").select("lat").distinct()),
        "threshold": spark.createDataFrame([(float(done.threshold),)], "threshold double"),
        "clusters": dedup.cluster_report(rows, c.country),
        "gold": dedup.gold_recall(rows, c.gold),
    } | ({"sweep": done.sweep} if done.sweep is not None else {})
    write_report(spark, report_lines(tables), f"{settings.work}/dedup_report")
    return tables
