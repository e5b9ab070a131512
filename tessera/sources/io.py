"""Tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """Parquet for .parquet and .pq (any case), else CSV with header and inferred types.

    columns are pruned in the scan; rows is a limit in file order.
    """
    if path.lower().endswith((".parquet", ".pq")):
        df = spark.read.parquet(path)
    else:
        df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    if columns:
        df = df.select(*columns)
    return df.limit(rows) if rows else df


def sample_exact(df: DataFrame, n: int, seed: int, keys: list[str], strict: bool = False) -> DataFrame:
    """n rows, the same for any partitioning: those with the smallest hashes of the keys.

    The hash of the last one is found first, over hashes alone, and the rows then only
    filtered by it: they stay where they are.  Fewer rows than n give all, or an error if strict.
    """
    rows = df.withColumn("__h", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])))
    least = rows.select("__h").orderBy("__h").limit(n)
    edge, count = least.agg(F.max("__h"), F.count("*")).first()
    if count < n:
        if strict:
            raise ValueError(f"fewer than {n} rows")
        return df
    if edge is None:
        return df.limit(0)
    # rows with the last hash are alike in their keys, and may be more than are wanted
    over = rows.where(F.col("__h") <= edge).count() - n
    sure = rows.where(F.col("__h") < edge) if over else rows.where(F.col("__h") <= edge)
    if over:
        ties = rows.where(F.col("__h") == edge)
        sure = sure.union(ties.orderBy(*keys).limit(n - sure.count()))
    return sure.drop("__h")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 with a header, without an index."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_report(spark: SparkSession, lines: list[str], path: str) -> None:
    """The lines as one text file in the folder path."""
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.mode("overwrite").text(path)


def file_megabytes(spark: SparkSession, path: str) -> float:
    """Size on disk of the files that a scan of the path reads."""
    files = spark.read.format("binaryFile").load(path).select("path", "length") if not path.lower().endswith((".parquet", ".pq")) else None
    if files is None:
        files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length")).distinct()
    return (files.agg(F.sum("length")).first()[0] or 0) / 1e6


def read_names(spark: SparkSession, path: str, column: str = "party_name") -> DataFrame:
    """(name): distinct names of a search index source, from the column or else the first one."""
    df = spark.read.parquet(path)
    return df.select(F.col(column if column in df.columns else df.columns[0]).alias("name")).distinct()
