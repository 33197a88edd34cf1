"""Rollups, set operations and publish counters.

Distinct counts are planned by Spark as a two-level aggregation (partial
aggregate on (group, value), shuffle on (group, value), then count per group),
so one very large group is spread over many tasks before its final count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def app_index_part(df: DataFrame, sample_col: str, app_col: str = "Application",
                   folder_col: str = "Investigator_Folder") -> DataFrame:
    """One source of A1: distinct samples per (Application, Investigator_Folder), both present."""
    return (df.filter(F.col(app_col).isNotNull() & F.col(folder_col).isNotNull())
              .groupBy(F.col(app_col).alias("Application"), F.col(folder_col).alias("Investigator_Folder"))
              .agg(F.count_distinct(F.col(sample_col)).alias("Sample_Count")))


def app_index(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """A1 + O1: UNION ALL of the per-source rollups. An absent table is an empty one (L-16):
    pass only the sources that exist."""
    parts = [app_index_part(df, sample_col) for df, sample_col in sources]
    return reduce(lambda a, b: a.unionByName(b), parts)


def unified_view(sources: Sequence[tuple[DataFrame, str]], name: str | None = None) -> DataFrame:
    """O2 + K4: distinct (Application, Investigator_Folder, Source) over the sources."""
    parts = [df.select("Application", "Investigator_Folder").withColumn("Source", F.lit(label))
             for df, label in sources]
    view = reduce(lambda a, b: a.unionByName(b), parts).distinct()
    if name:
        view.createOrReplaceTempView(name)
    return view


def union_distinct(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """O3: UNION (distinct) of a run-time list of tables on the given columns."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(*cols) for f in frames]).distinct()


def app_present(frames: Sequence[DataFrame], candidates: DataFrame, app_col: str = "Application") -> DataFrame:
    """Which candidate applications occur in any existing table; the match ignores case and
    also reports whether the exact spelling occurs."""
    known = union_distinct(frames, [app_col])
    low = known.select(F.lower(F.col(app_col)).alias("_low")).distinct().withColumn("_ci", F.lit(True))
    exact = known.select(F.col(app_col).alias("_exact")).withColumn("_ex", F.lit(True))
    c = candidates.withColumn("_clow", F.lower(F.col(app_col)))
    joined = (c.join(low, c["_clow"] == low["_low"], "left")
               .join(exact, c[app_col] == exact["_exact"], "left"))
    return joined.select(*[c[x] for x in candidates.columns],
                         F.coalesce(F.col("_ci"), F.lit(False)).alias("present_ignore_case"),
                         F.coalesce(F.col("_ex"), F.lit(False)).alias("present_exact"))


def table_totals(df: DataFrame, sample_col: str, prefix: str = "") -> DataFrame:
    """A2: row count and distinct samples in one pass (one-row DataFrame)."""
    return df.agg(F.count(F.lit(1)).alias(f"{prefix}rows"), F.count_distinct(F.col(sample_col)).alias(f"{prefix}samples"))


def _tagged(df: DataFrame | None, tag: str, sample_col: str | None) -> DataFrame | None:
    if df is None:
        return None
    sample = F.col(sample_col).cast("string") if sample_col else F.lit(None).cast("string")
    return df.select(F.lit(tag).alias("_tag"), sample.alias("_sample"))


def publish_delta(before: DataFrame | None, after: DataFrame, sample_col: str,
                  seq_before: DataFrame | None = None, seq_after: DataFrame | None = None,
                  snapshot_exists: bool | None = None) -> DataFrame:
    """A3: after, before and delta of rows, distinct samples and sequencing rows; an absent
    snapshot counts 0. ``publish`` is false only when a snapshot exists and both row deltas are 0.
    The tagged union of the inputs is grouped by tag and sample first, so that counting distinct
    samples needs no expansion of the rows; all six counters come from that small table."""
    parts = [p for p in (_tagged(after, "a", sample_col), _tagged(before, "b", sample_col),
                         _tagged(seq_after, "sa", None), _tagged(seq_before, "sb", None)) if p is not None]
    u = reduce(lambda x, y: x.unionByName(y), parts)
    u = u.groupBy("_tag", "_sample").agg(F.count(F.lit(1)).alias("_n"))

    def rows(tag):
        return F.coalesce(F.sum(F.when(F.col("_tag") == tag, F.col("_n"))), F.lit(0)).cast("bigint")

    def samples(tag):
        return F.count_if((F.col("_tag") == tag) & F.col("_sample").isNotNull())

    agg = u.agg(rows("a").alias("after_rows"), rows("b").alias("before_rows"), samples("a").alias("after_samples"),
                samples("b").alias("before_samples"), rows("sa").alias("after_seq_rows"), rows("sb").alias("before_seq_rows"))
    exists = F.lit(before is not None if snapshot_exists is None else snapshot_exists)
    return agg.select(
        "after_rows", "before_rows", (F.col("after_rows") - F.col("before_rows")).alias("delta_rows"),
        "after_samples", "before_samples", (F.col("after_samples") - F.col("before_samples")).alias("delta_samples"),
        "after_seq_rows", "before_seq_rows", (F.col("after_seq_rows") - F.col("before_seq_rows")).alias("delta_seq_rows"),
    ).withColumn("publish", ~(exists & (F.col("delta_rows") == 0) & (F.col("delta_seq_rows") == 0)))


def import_stats(before: DataFrame, new_rows: DataFrame, sample_col: str) -> DataFrame:
    """A4: before, after, new = max(after-before, 0), and the batch's distinct sample count.
    ``new_rows`` is the anti-join result, so no second scan of the target is made."""
    u = _tagged(before, "b", None).unionByName(_tagged(new_rows, "n", sample_col))
    tag = F.col("_tag")
    agg = u.agg(F.count_if(tag == "b").alias("before"), F.count_if(tag == "n").alias("added"),
                F.count_distinct(F.when(tag == "n", F.col("_sample"))).alias("sample_size"))
    return agg.select("before", (F.col("before") + F.col("added")).alias("after"),
                      F.greatest(F.col("added"), F.lit(0)).cast("bigint").alias("new"), "sample_size")


def candidate_counts(candidates: DataFrame, applications: DataFrame, app_col: str = "application",
                     eligible_col: str | None = None) -> DataFrame:
    """Folders found (and eligible) per application, zero for applications without any;
    ``skip`` marks an application with nothing to do."""
    aggs = [F.count(F.lit(1)).alias("found")]
    if eligible_col:
        aggs.append(F.count_if(F.col(eligible_col)).alias("eligible"))
    counts = candidates.groupBy(app_col).agg(*aggs)
    out = applications.select(app_col).distinct().join(counts, app_col, "left").fillna(0)
    last = "eligible" if eligible_col else "found"
    return out.withColumn("skip", F.col(last) == 0)


def failure_summary(failures: DataFrame, reason_col: str = "reason") -> DataFrame:
    """Failed projects de-duplicated, counted per reason."""
    return failures.dropDuplicates().groupBy(reason_col).agg(F.count(F.lit(1)).alias("projects"))
