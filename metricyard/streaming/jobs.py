"""Structured Streaming jobs.

* ``watch_groups``  -- new group names from landed ``*.metrics.txt`` files are
  registered in the group registry (A7 -> U3) in ``foreachBatch``.
* ``watch_reports`` -- newly landed report files are appended to a long table
  with append-if-absent (M1); the stream checkpoint replaces the processed-path
  ledger.
* ``dedupe_stream`` -- any stream appended to a table keyed on a column list;
  the state lives in the table (bounded), not in the stream.

Every sink write is a plain Parquet append of one micro-batch; a retried batch
is held against the index of stored keys, so a repeated epoch adds nothing.
The registry is rewritten as a whole into its next version (no in-place overwrite of
a folder that is being read). Version numbers come from the registry's own folders, so
streams, restarted streams and batch runs can follow each other in any order.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import registry
from ..operators.keyindex import KeyIndex
from ..sources.delimited import column_values_sniffed
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources.tables import glob_paths, read_version, write_version


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (``ensure_checkpoint_dir``)."""
    base = ensure_checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    path = os.path.join(base, "metricyard", f"{name}-{uuid.uuid4().hex}")
    return path


def dedupe_stream(stream: DataFrame, table_path: str, key: Sequence[str], checkpoint: str,
                  trigger_available_now: bool = True):
    """Append each micro-batch's rows whose key is not stored yet (M1, null-safe).

    The keys of the table are kept as digests by hash bucket (``KeyIndex``): a micro-batch reads the buckets that its
    own keys fall into, and the table is neither read nor shuffled. A query starts (and restarts) by making the index
    agree with the table, so a batch that died after its rows were written adds nothing when it is tried again."""
    index = []

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if not index:
            index.append(KeyIndex(batch.sparkSession, table_path, key).ensure())
        added = index[0].append(cut_lineage(batch))
        if not added and not glob_paths(batch.sparkSession, table_path):
            batch.limit(0).write.mode("append").parquet(table_path)          # an empty stream still makes the table

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start()


def watch_groups(stream_lines: DataFrame, registry_root: str, checkpoint: str,
                 group_col: str = "Investigator_Folder", trigger_available_now: bool = True,
                 parse=None):
    """Each micro-batch of metrics-file lines ``(path, line)`` gives its distinct group
    names (S11 + A7), which are registered (U3). The registry (one row per group and user,
    small) is written as its next version when a group is new; a retried batch finds its
    groups registered and writes nothing."""
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        reg = current_registry(spark, registry_root)
        numbered = batch.withColumn("line_no", F.monotonically_increasing_id())
        groups = parse(batch) if parse is not None else \
            column_values_sniffed(numbered, group_col).withColumnRenamed("value", group_col)
        found = registry.distinct_groups(groups, group_col)
        if not found.join(reg, "grp", "left_anti").isEmpty():
            write_version(registry.register_groups(reg, found), registry_root)

    writer = stream_lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start()


def current_registry(spark: SparkSession, registry_root: str) -> DataFrame:
    """Rows of the newest version (empty registry when none exists yet)."""
    return read_version(spark, registry_root, registry.REGISTRY_SCHEMA).select("grp", "user", "pos")


def metrics_file_stream(spark: SparkSession, input_dir: str) -> DataFrame:
    """Lines of landed ``*.metrics.txt`` files with their path (header rows are dropped later)."""
    return (spark.readStream.format("text").option("pathGlobFilter", "*.metrics.txt")
                 .option("recursiveFileLookup", "true").load(input_dir)
                 .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")))


def watch_reports(spark: SparkSession, root: str, application: str, warehouse: str, checkpoint: str,
                  trigger_available_now: bool = True, settle: float | None = None):
    """The collector as a stream of changed report files (``ChangedFiles``). Only the folders of a micro-batch are
    listed again, by tasks. Their projects are collected and appended (M1/M2), also those collected before: an edited
    report is read again (ledger L-21), and rows that are stored already are not stored twice. ``settle`` allows for
    file servers whose clock is behind: none in a run over what there is now, else two seconds."""
    from ..functions import clean
    from ..plans import runs
    from ..sources import files, listing

    pattern = f"*_QCreport.{application}.csv" if application not in ("PacBio", "ONT") else "*QC*eport*.csv"
    settle = (0.0 if trigger_available_now else 2.0) if settle is None else settle
    stream = listing.changed_files(spark, [root], pattern, settle).select("path")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        folder = clean.parent_dir(F.col("path"))
        folder = F.when(clean.base_name(folder) == "package", clean.parent_dir(folder)).otherwise(folder)
        projects = cut_lineage(batch.select(folder.alias("project_dir")).distinct())
        if not projects.isEmpty():
            found = cut_lineage(files.only_files(listing.list_below(projects)))
            runs.run_projects(batch.sparkSession, found, projects, application, warehouse, reset=True)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start()
