"""Sinks (K1-K8): appends, replacements, exports, clustered layout, snapshots, ledgers.

Every write goes to a table folder on shared storage. Appends add files (one
commit per run); replacements write a fresh folder and never overwrite a folder
that the same job reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def append_rows(new_rows: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """K1: append the rows chosen by M1/M2/M3."""
    w = new_rows.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """K2: rebuild a summary table into its own folder."""
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """K3: CSV (or TSV with ``sep='\\t'``) with a header line."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def publish_view(df: DataFrame, name: str = "unified_qc_view") -> DataFrame:
    """K4: drop and create the view."""
    df.createOrReplaceTempView(name)
    return df


def publish_lasting_view(spark, name: str, tables: Sequence[str], cols: Sequence[str] = ("Application", "Investigator_Folder")) -> None:
    """K4: a catalog view over the Parquet folders themselves, distinct over ``cols`` with the folder's name as ``Source``.
    It is text in the catalog, not a copy: every session of the catalog reads the rows that are stored when it asks.
    Tables that do not exist yet are left out until the view is published again."""
    from ..sources.tables import glob_paths
    parts = [f"SELECT {', '.join(cols)}, '{path.rstrip('/').rsplit('/', 1)[1]}' AS Source FROM parquet.`{path}`"
             for path in tables if glob_paths(spark, path)]
    empty = f"SELECT {', '.join(f'CAST(NULL AS STRING) AS {c}' for c in cols)}, CAST(NULL AS STRING) AS Source WHERE false"
    spark.sql(f"DROP VIEW IF EXISTS {name}")              # a temporary view of an older session may hide it
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT DISTINCT * FROM ({' UNION ALL '.join(parts or [empty])})")


def write_clustered(df: DataFrame, path: str, partition_col: str = "Application",
                    sort_cols: Sequence[str] = ("Release_Date", "Investigator_Folder", "Project_ID",
                                                "Project_run_type"), mode: str = "append",
                    parts: int | None = None, mark=lambda df: df) -> None:
    """K5: rows laid out so that dashboard filters skip files -- one folder per application
    (partition pruning) and rows sorted inside files (Parquet min/max skipping). Rows are dealt by
    ranges of the sort key that end in a hash of the whole row, so neither a large application nor
    a project that holds half of all rows lands in a single task. ``mark`` may observe the rows as they are written."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    out = df.withColumn("_row", row).repartitionByRange(n, partition_col, *sort_cols, "_row")
    out = out.sortWithinPartitions(partition_col, *sort_cols, "_row").drop("_row")
    mark(out).write.mode(mode).partitionBy(partition_col).parquet(path)


def snapshot(df: DataFrame, root: str, run_date: str) -> str:
    """K6: keep the published state under ``snapshot_date=YYYYMMDD/`` (one per day)."""
    day = run_date.replace("-", "")
    path = f"{root}/snapshot_date={day}"
    df.write.mode("overwrite").parquet(path)
    return path


def append_ledger(ledger: DataFrame, paths: DataFrame, path: str, key: Sequence[str] = ("project_dir",)) -> int:
    """K7: record paths not yet recorded (anti-join on the key); returns the number of rows written."""
    new = cut_lineage(paths.select(*ledger.columns).dropDuplicates(list(key)).join(
        ledger.select(*key), list(key), "left_anti"))
    new.write.mode("append").parquet(path)
    return new.count()


def registry_export(registry_long: DataFrame, path: str | None = None) -> DataFrame:
    """K8: ``group -> 'user1, user2'`` listing built from the long registry (export only)."""
    from .registry import export_registry
    out = export_registry(registry_long).select("grp", "users", "users_text")
    if path:
        out.write.mode("overwrite").json(path)
    return out


def content_hash(spark, path: str) -> DataFrame:
    """M7 helper: ``(path, sha256)`` of text files. Each line is hashed, equal lines are counted, and the
    counted hashes are added up, so a file is read by many tasks and is never held as one value. Files with
    the same lines in another order count as unchanged: an import is a set of rows."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path"), F.sha2("value", 256).alias("h"))
    part = lambda i: F.sum(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)"))
    return lines.groupBy("path").agg(F.sha2(F.concat_ws("|", F.count("*").cast("string"), *[
        part(i).cast("string") for i in range(4)]), 256).alias("sha256"))
