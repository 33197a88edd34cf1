"""File-system sources: project folders, hidden settings files, whole-text reports.

Listing and reading are Spark jobs over path DataFrames:

* folders are listed by the ``folder_tree`` data source (``listing.py``), by tasks, with literal names;
* bodies of chosen files, hidden ones among them (the settings file and the ONT instrument
  file), are read by executors from a DataFrame of paths with ``mapInPandas``, so that no path
  list passes through the driver. It needs the paths to be reachable as files from the executors
  (a shared file system, as the project folders are).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean, fixed
from .listing import list_tree


READ_BATCH = 64          # bodies that a task hands on at a time
RANGE = 64 << 20         # bytes of a file that a task reads at a time, for lines
LINES_BATCH = 4 << 20    # bytes of lines that a task hands on at a time


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def list_files(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """All files under the roots, hidden ones among them: ``(root, path, length, modificationTime)``."""
    return only_files(list_tree(spark, roots))


def only_files(tree: DataFrame) -> DataFrame:
    return tree.filter(~F.col("is_dir")).drop("is_dir")


def list_projects(listing: DataFrame, application: str) -> DataFrame:
    """Every folder below a root that is named exactly like the application, at any depth, also inside
    another one. Names are compared as they are, not as a pattern, and the root's own path does not count. A tree
    has the folders themselves; a listing of files shows those that hold files, at every matching level."""
    if "is_dir" in listing.columns:
        dirs = listing.filter(F.col("is_dir") & (clean.base_name(F.col("path")) == application)).select(F.col("path").alias("project_dir"))
    else:
        parts = F.split("path", "/")
        above = F.size(F.split("root", "/"))
        levels = F.filter(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: (i > above) & (F.get(parts, i - 1) == application))
        dirs = listing.select(parts.alias("parts"), F.explode(levels).alias("at")).select(
            F.array_join(F.slice("parts", F.lit(1), F.col("at")), "/").alias("project_dir"))
    return dirs.distinct().withColumn("application", F.lit(application))


def find_reports(listing: DataFrame, suffix: str) -> DataFrame:
    """S3: parent folders of listed files whose name ends with ``suffix``."""
    hit = listing.filter(clean.base_name(F.col("path")).endswith(suffix))
    return hit.select(clean.parent_dir(F.col("path")).alias("project_dir")).distinct()


def read_hidden_files(paths: DataFrame, path_col: str = "path", body_col: str = "body") -> DataFrame:
    """S4 helper: bodies of the given (possibly hidden) files, NULL when a file is absent or
    unreadable. Reads happen on executors: the paths are dealt to as many tasks as the session
    shuffles to (a fixed count, which AQE does not merge), and a task holds one body at a time
    beside those of the small batch it is filling."""
    def read_batch(batches):
        import pandas as pd
        for whole in batches:
            for at in range(0, len(whole), READ_BATCH):
                pdf = whole.iloc[at: at + READ_BATCH]
                bodies = []
                for p in pdf[path_col]:
                    try:
                        with open(_local(p), encoding="utf-8", errors="replace") as fh:
                            bodies.append(fh.read())
                    except (OSError, TypeError, AttributeError):      # AttributeError: a NULL path
                        bodies.append(None)
                out = pdf.copy()
                out[body_col] = pd.Series(bodies, dtype=object, index=out.index)
                yield out
    schema = T.StructType(list(paths.schema.fields) + [T.StructField(body_col, T.StringType())])
    spread = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.repartition(spread, path_col).mapInPandas(read_batch, schema)


def read_settings(projects: DataFrame, dir_col: str = "project_dir", name: str = fixed.SETTINGS_FILE) -> DataFrame:
    """``(project_dir, json)`` -- one settings document per project (NULL when missing)."""
    p = projects.select(dir_col).distinct().withColumn("path", F.concat(F.col(dir_col), F.lit("/" + name)))
    return read_hidden_files(p).select(dir_col, F.col("body").alias("json"))


def settings_by_application(settings: DataFrame, application: str, dir_col: str = "project_dir") -> DataFrame:
    """Long-read folders found by the settings ``application`` value (case ignored)."""
    app = F.lower(clean.json_value("json", "application"))
    return (settings.filter(app == F.lit(application.lower()))
                    .withColumn("project_dir", F.concat(F.col(dir_col), F.lit("/" + application))))


def resolve_candidate(files: DataFrame, project_col: str, rank: Column, path_col: str = "path") -> DataFrame:
    """Per project the first existing file of an ordered candidate list. ``rank`` gives each
    listed file its place in the list (NULL = not a candidate); ties inside one glob go to the
    smallest path. Returns ``(project, path, rank)``."""
    cand = files.withColumn("_rank", rank).filter(F.col("_rank").isNotNull())
    return cand.groupBy(project_col).agg(
        F.min_by(F.struct(F.col("_rank").alias("rank"), F.col(path_col).alias("path")),
                 F.struct(F.col("_rank"), F.col(path_col))).alias("_c")).select(project_col, "_c.path", "_c.rank")


def read_lines(listed: DataFrame) -> DataFrame:
    """``(path, line_no, line)`` of listed files, read by tasks. ``line_no`` is the byte at which the line starts, so it
    grows with the place in the file. Files are dealt to as many tasks as the session shuffles to, a file of more than
    ``RANGE`` bytes by ranges; a line belongs to the range that it starts in. Lines end as in Spark's text source. A file
    that cannot be read fails the job."""
    def read(batches):
        import pyarrow as pa
        paths, starts, lines, held = [], [], [], 0

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(starts, pa.int64()), pa.array(lines, pa.string())],
                                              ["path", "line_no", "line"])

        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for start, line in _lines_from(_local(path), at, at + RANGE):
                    paths.append(path)
                    starts.append(start)
                    lines.append(line.decode("utf-8", "replace"))
                    held += len(path) + len(line)
                    if held > LINES_BATCH:
                        yield rows()
                        paths, starts, lines, held = [], [], [], 0
        if paths:
            yield rows()

    last = F.greatest(F.col("length") - 1, F.lit(0).cast("bigint"))
    ranges = listed.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(RANGE).cast("bigint"))).alias("at"))
    spread = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(spread, "path", "at").mapInArrow(read, "path string, line_no bigint, line string")


def _lines_from(path: str, at: int, end: int):
    """(place, bytes) of the lines that start in a range of the file; they end with LF, CR LF or CR."""
    with open(path, "rb") as fh:
        if at:
            fh.seek(at - 1)
            at += len(fh.readline()) - 1
        while at < end and (raw := fh.readline()):
            start, at = at, at + len(raw)
            if start == 0 and raw.startswith(b"\xef\xbb\xbf"):
                start, raw = 3, raw[3:]
            parts = raw.removesuffix(b"\n").removesuffix(b"\r").split(b"\r") if raw.endswith(b"\n") else raw.removesuffix(b"\r").split(b"\r")
            for part in parts if raw else []:
                yield start, part
                start += len(part) + 1


def read_logs(spark: SparkSession, root: str) -> DataFrame:
    """``(path, project, pipeline, stage, line, line_no)`` from ``<project>_QCreport.<pipeline>[.<stage>].log``, at
    any depth; hidden files and folders (a leading dot or underscore) are left out. Listed and read by tasks, so many
    small logs cost neither a listing on the driver nor a task for a few of them. The triage rules need no order
    (first *rule* wins); blocks of lines are found by ``path`` and ``line_no``."""
    from ..operators.triage import parse_log_path
    if not os.path.isdir(_local(root)):
        raise FileNotFoundError(root)
    below = F.split(F.expr("substring(path, length(root) + 1)"), "/")
    seen = ~F.exists(below, lambda n: n.startswith(".") | (n.startswith("_") & ~n.contains("=")))
    logs = list_files(spark, [_local(root).rstrip("/")]).filter(seen & clean.base_name(F.col("path")).rlike(r"_QCreport\..*\.log$"))
    lines = read_lines(logs).withColumn("path", F.concat(F.lit("file:"), "path"))
    parts = parse_log_path(F.col("path"))
    return lines.select("path", parts["project"].alias("project"), parts["pipeline"].alias("pipeline"),
                        parts["stage"].alias("stage"), "line", "line_no")
