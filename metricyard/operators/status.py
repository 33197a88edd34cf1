"""Delivery status as events beside a table (U1, U2, A5), merged when it is read.

An update writes one event for each row that it changes: the row's file, its place in that file and the new status. The
table's own files are left alone, so an update costs as much as it changes. ``read`` shows the table with the newest
event of every row, and ``fold`` writes what the events say into the partitions that they touch.

Events lie in ``<table>.status/v=<n>``, one folder for each update, which counts once its success mark is there: an update that
died has not happened, and repeating it is safe. Rows are named by place, not by key, so two rows that are equal in every
column keep their own status, and rows appended later never inherit one. Events of files that are gone (folded ones)
name no row. One writer at a time; a table may be moved together with its events if its folder keeps its name.

A null status matches no update, null run types and samples are in no scope, and a table without events is read as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.tables import glob_paths, versions
from .joins import fits_broadcast, null_safe_on
from .merge import status_scope

EVENTS = "`_file` string, `_row` bigint, `_status` string, `v` bigint"
PLACE = ["_file", "_row"]
INSIDE = r"(?:^|/)((?:[^/][^/=]*+=[^/]*+/)*+[^/]++)$"      # partition folders and file, found without going back: it is taken of every row


class StatusOverlay:
    """The table at ``path`` and its status events. ``schema`` or, without one, the union of all files' schemas is read."""

    def __init__(self, spark: SparkSession, path: str, status_col: str = "ProjStatus", schema: str | None = None):
        self.spark, self.path, self.status_col, self.schema = spark, path.rstrip("/"), status_col, schema
        self.root = f"{self.path}.status"

    def pending(self) -> list[int]:
        """Updates that no fold has taken up yet."""
        folded = max((int(p.split("folded=")[1].split("/")[0]) for p in glob_paths(self.spark, f"{self.root}/folded=*/_SUCCESS")), default=0)
        return [v for v in versions(self.spark, self.root) if v > folded]

    def events(self) -> DataFrame:
        """(_file, _row, _status): the newest status of every row that an update has changed."""
        paths = [f"{self.root}/v={v}" for v in self.pending()]
        if not paths:
            return self.spark.createDataFrame([], EVENTS).drop("v")
        stored = self.spark.read.schema(EVENTS).option("basePath", self.root).parquet(*paths)
        return stored.groupBy(*PLACE).agg(F.max_by("_status", "v").alias("_status"))

    def _placed(self) -> DataFrame:
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read.option("mergeSchema", True)
        table = reader.parquet(self.path)
        inside = F.regexp_extract(F.col("_metadata.file_path"), INSIDE, 1)
        return table.select("*", inside.alias("_file"), F.col("_metadata.row_index").alias("_row"))

    def rows(self, broadcast_bytes: int | None = None) -> DataFrame:
        """The table's rows with their place and their status of now.

        Events whose measured bytes fit the broadcast threshold go to the table, which is scanned where it lies. Beyond it
        only rows of files that have events are shuffled, as long as those files' names fit; beyond that all rows are."""
        placed = self._placed()
        if not self.pending():
            return placed
        events = self.events()
        if fits_broadcast(events, broadcast_bytes):
            return self._merged(placed, F.broadcast(events))
        names = events.select("_file").distinct()
        if not fits_broadcast(names, broadcast_bytes):
            return self._merged(placed, events)
        names = F.broadcast(names)
        return self._merged(placed.join(names, "_file", "left_semi").select(*placed.columns), events).unionByName(
            placed.join(names, "_file", "left_anti"))

    def _merged(self, placed: DataFrame, events: DataFrame) -> DataFrame:
        now = F.coalesce(F.col("_status"), F.col(f"`{self.status_col}`")).alias(self.status_col)
        cols = [now if c == self.status_col else F.col(f"`{c}`") for c in placed.columns]
        return placed.join(events, PLACE, "left").select(*cols)

    def read(self) -> DataFrame:
        """The table as every reader should see it: its own columns, the status of now."""
        return self.rows().drop(*PLACE)

    def update(self, run_type: str, samples: DataFrame | None = None, from_status: str = "Delivered", to_status: str = "Undelivered",
               run_type_col: str = "Project_run_type", sample_col: str = "Sample_Name") -> int:
        """U1 + A5: rows in scope that have ``from_status`` get ``to_status``; returns their number. Without any, nothing is written."""
        scoped = status_scope(self.rows(), run_type_col, run_type, samples, sample_col)
        hit = cut_lineage(scoped.filter(F.col(f"`{self.status_col}`") == from_status).select(*PLACE, F.lit(to_status).alias("_status")))
        n = hit.count()
        if n:
            hit.write.parquet(f"{self.root}/v={max(versions(self.spark, self.root, complete=False), default=0) + 1}")
        return n

    def fold(self, partition_cols: Sequence[str] = ("Application",)) -> None:
        """Writes the events into the table: partitions that they touch (the whole table, if it has none of these columns as
        folders) go to a staging folder and from there replace the table's own. The fold is noted last; one that died
        before is repeated, and finds no row for the events whose files it had already replaced."""
        pending = self.pending()
        if not pending:
            return
        rows, names = self.rows(), self.events().select("_file").distinct()
        parts = [c for c in partition_cols if c in rows.columns and glob_paths(self.spark, f"{self.path}/{c}=*")]
        keys = cut_lineage(rows.join(names, "_file", "left_semi").select(*[F.col(f"`{c}`").alias(f"_k_{c}") for c in parts]).distinct()
                           if parts else rows.join(names, "_file", "left_semi").select("_row").limit(1))
        if not keys.isEmpty():
            touched = rows.join(F.broadcast(keys) if fits_broadcast(keys) else keys,
                                null_safe_on(rows, keys, parts, [f"_k_{c}" for c in parts]), "left_semi") if parts else rows
            staged = f"{self.path}.staged-{uuid.uuid4().hex}"
            touched.drop(*PLACE).write.parquet(staged)
            writer = self.spark.read.schema(touched.drop(*PLACE).schema).parquet(staged).write.mode("overwrite")
            if parts:
                writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
            writer.parquet(self.path)
            self.spark.catalog.refreshByPath(self.path)
        self.spark.range(1).write.parquet(f"{self.root}/folded={max(pending)}")
