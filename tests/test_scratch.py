"""Scratch tables in the shared folder."""

from pathlib import Path

from tessera.sources.scratch import clear_scratch, discard, scratch_dir, stored, stored_by


def test_stored_and_cleared(spark):
    df = stored(spark.range(10))
    assert df.count() == 10 and "Scan parquet" in df._jdf.queryExecution().executedPlan().toString().replace("FileScan", "Scan")
    assert scratch_dir(spark) != scratch_dir(spark)
    assert clear_scratch(spark) >= 1 and clear_scratch(spark) == 0


def test_discarded(spark):
    kept, gone = stored(spark.range(10)), stored(spark.range(5).repartition(3), small=True)
    assert gone.count() == 5
    discard(gone)
    assert kept.count() == 10 and not Path(gone._scratch).exists()


def test_buckets_are_not_shuffled(spark):
    key, limit = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    rows = stored_by(spark.range(100).selectExpr("id % 10 as a", "id % 3 as b", "id"), "a", "b")
    assert spark.conf.get(key) == before and not spark.catalog.listTables()
    spark.conf.set(limit, "-1")
    try:
        joined = rows.join(spark.range(10).selectExpr("id as a", "id % 3 as b"), ["a", "b"], "left")
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.unset(limit)
    assert joined.count() == 100
