"""Readers for the Parquet tables the jobs are checked on (one file or folder per table)."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it. Splits are Spark's own
    (``spark.sql.files.*``), so the plan is the same at every size."""
    return spark.read.parquet(table_path(sf_dir, name))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [str(f.getPath()) for f in (found or [])]


def versions(spark: SparkSession, root: str, complete: bool = True) -> list[int]:
    """Versions of a versioned table (folders ``v=<n>``); complete ones hold the writer's success mark."""
    mark = "/_SUCCESS" if complete else ""
    return sorted(int(re.search(r"/v=(\d+)", p)[1]) for p in glob_paths(spark, f"{root}/v=*{mark}"))


def read_version(spark: SparkSession, root: str, empty_schema: str) -> DataFrame:
    """Newest complete version; a table without any reads as empty."""
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], empty_schema)
    return spark.read.parquet(f"{root}/v={known[-1]}")


def write_version(df: DataFrame, root: str) -> str:
    """Write the next version. Its number comes from the folders themselves, so writers of any kind
    (batch runs, streams, retries) follow each other; two at once fail loudly instead of losing one."""
    spark = df.sparkSession
    path = f"{root}/v={max(versions(spark, root, complete=False), default=0) + 1}"
    df.write.parquet(path)
    return path


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that does not exist yet reads as empty (ledger L-16)."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def row_count_or_zero(spark: SparkSession, path: str) -> int:
    """Count of a stored table, 0 when absent (a single aggregate action)."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0


def read_evolving(spark: SparkSession, path: str, base_schema: str) -> DataFrame:
    """A table whose columns grow over time (M4): files are read with ``mergeSchema``; an absent
    table reads as empty with the base columns."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], base_schema)
