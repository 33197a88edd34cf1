"""Incremental scope, ledgers and gates (S1-S3 selection, J1, J2, T4-T8, F11, F12).

State lives in tables (ledger, tracker) rather than in text files; every
decision is a join or a CASE over those tables, evaluated for all
applications and projects at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, fixed


def normalize_dir(col) -> Column:
    """Project folder key: no trailing slash, no doubled slashes (exact match, ledger L-2)."""
    c = F.regexp_replace(clean._c(col), "/+", "/")
    return F.regexp_replace(c, "/$", "")


def new_projects(found: DataFrame, ledger: DataFrame, key: Sequence[str] = ("project_dir",)) -> DataFrame:
    """Found folders not yet recorded (exact key equality, not substring)."""
    return found.join(ledger.select(*key).distinct(), list(key), "left_anti")


def requeue(ledger: DataFrame, failed: DataFrame, key: Sequence[str] = ("project_dir",)) -> DataFrame:
    """Recorded list with failed projects taken out (they are tried again next run)."""
    return ledger.join(failed.select(*key).distinct(), list(key), "left_anti")


def append_ledger(ledger: DataFrame, paths: DataFrame, key: Sequence[str] = ("project_dir",)) -> DataFrame:
    """Paths not yet recorded are added; duplicates collapse."""
    return ledger.unionByName(paths.select(*ledger.columns).dropDuplicates(list(key))
                              .join(ledger.select(*key), list(key), "left_anti"))


def scan_scope(apps: DataFrame, tracker: DataFrame, present: DataFrame, has_list: DataFrame,
               run_date: Column, rescan_days: int = fixed.ARCHIVE_RESCAN_DAYS) -> DataFrame:
    """T4: per application: >= ``rescan_days`` since the archive scan -> 'archive' (undelivered
    allowed); else known to the warehouse and an earlier list exists -> 'active'; else 'all'.

    apps(application), tracker(application, last_archive_scan DATE), present(application)
    and has_list(application) are small per-application tables.
    """
    j = (apps.join(tracker, "application", "left")
             .join(present.select("application").distinct().withColumn("_present", F.lit(True)), "application", "left")
             .join(has_list.select("application").distinct().withColumn("_list", F.lit(True)), "application", "left"))
    days = F.datediff(run_date, F.col("last_archive_scan"))
    scope = (F.when(days >= rescan_days, F.lit("archive"))
              .when(F.coalesce("_present", F.lit(False)) & F.coalesce("_list", F.lit(False)), F.lit("active"))
              .otherwise(F.lit("all")))
    return j.select("application", days.cast("bigint").alias("days_since_archive_scan"), scope.alias("scope"),
                    (scope == "archive").alias("allow_undelivered"))


def reset_due(tracker: DataFrame, run_date: Column, reset_days: int = fixed.LEDGER_RESET_DAYS) -> DataFrame:
    """T5: applications whose processed list is to be forgotten this run."""
    return tracker.withColumn("reset", F.coalesce(F.datediff(run_date, F.col("last_reset")) >= reset_days, F.lit(True)))


def first_run_scope(ledger: DataFrame) -> str:
    """No processed path yet -> active + archive roots, else active only (one tiny action)."""
    return "all" if ledger.isEmpty() else "active"


def retention(snapshots: DataFrame, date_col: str, days: int = fixed.BACKUP_RETENTION_DAYS,
              today: str | None = None) -> DataFrame:
    """Snapshot partitions older than ``days`` (deletion is the caller's)."""
    return snapshots.withColumn("expired", clean.older_than(F.col(date_col), days, today))


def delivery_gate(projects: DataFrame, allow_undelivered: Column | bool = False,
                  folder_col: str = "Investigator_Folder", date_col: str = "Release_Date") -> DataFrame:
    """``ready`` is true when the delivery folder and release date are present, or when
    undelivered projects are allowed (archive scope). Not-ready projects are retried later."""
    allow = allow_undelivered if isinstance(allow_undelivered, Column) else F.lit(bool(allow_undelivered))
    ok = ~clean.is_missing(F.col(folder_col)) & ~clean.is_missing(F.col(date_col))
    return projects.withColumn("ready", ok | allow)


def validate_project(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """``reason`` = the first failed check in order (NULL when all pass)."""
    reason = None
    for name, failed in checks:
        cond = F.coalesce(failed, F.lit(False))
        reason = F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name))
    return df.withColumn("reason", reason)


def width_check(df: DataFrame, cells_col: str, min_width: int = 14) -> DataFrame:
    """``rejected`` when the first row has fewer than ``min_width`` fields."""
    return df.withColumn("rejected", F.size(F.col(cells_col)) < min_width)
