"""End-to-end runs: one job per run over all projects of an application.

``run_collector`` = scope and reset (T4-T6) -> listing (S1/S2) -> ``run_projects`` = new
projects (J1) -> routing and counts (F13/A8) -> collector (with the J4 report) ->
append (M1 for short read, M4+M2 for long read) -> ledgers (K7/J2/A9).
``build_marts`` = rollups (A1/K2) -> view (K4) -> publish delta (A3) -> snapshots (K6, T8).
Table folders live under ``warehouse``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, fixed
from ..operators import enrich, incremental, marts, merge, sinks
from ..operators.appindex import AppIndex
from ..operators.joins import null_safe_on
from ..operators.numbering import numbered
from ..operators.quarantine import observed_write, quarantine
from ..operators.status import StatusOverlay
from ..session import cut_lineage
from ..sources import files
from ..sources.listing import list_tree
from ..sources.tables import (glob_paths, read_evolving, read_version, row_count_or_zero, table_or_empty,
                              versions, write_version)
from . import collectors

SHORT_SCHEMA = ", ".join(f"`{c}` string" for c in fixed.SHORT_READ_COLUMNS)
LONG_SCHEMA = ", ".join(f"`{c}` string" for c in fixed.LONG_READ_BASE) + ", `name` string, `value` string"
LEDGER_SCHEMA = "project_dir string, application string, run_date string"
FAILED_SCHEMA = "project_dir string, reason string, application string, run_date string"
TRACKER_SCHEMA = "application string, last_archive_scan date, last_reset date"


def table_path(warehouse: str, name: str) -> str:
    return f"{warehouse}/{name}"


def scan_plan(spark: SparkSession, application: str, warehouse: str, run_date: str) -> dict:
    """T4 + T5 + T6 for one application: which roots to scan, and whether its ledger starts anew.

    ``scan_tracker`` keeps the days of the last archive scan and the last reset. Without any
    processed path (first run) both kinds of roots are scanned."""
    tracker = read_version(spark, table_path(warehouse, "scan_tracker"), TRACKER_SCHEMA)
    mine = tracker.filter(F.col("application") == application)
    ledger = current_ledger(spark, warehouse).filter(F.col("application") == application)
    app = spark.createDataFrame([(application,)], "application string")
    known = ledger.select("application").limit(1)
    today = F.to_date(F.lit(run_date))
    scope = incremental.scan_scope(app, mine.select("application", "last_archive_scan"), known, known, today).first()
    due = incremental.reset_due(mine, today).filter("reset").first() is not None and mine.first()["last_reset"] is not None
    first = incremental.first_run_scope(ledger) == "all"
    return {"scope": "all" if first else scope["scope"], "allow_undelivered": bool(scope["allow_undelivered"]), "reset": due}


def note_scan(spark: SparkSession, application: str, warehouse: str, run_date: str, plan: dict) -> None:
    """Record the scan: archive day when archives were read, reset day when the ledger was (re)started."""
    root = table_path(warehouse, "scan_tracker")
    tracker = read_version(spark, root, TRACKER_SCHEMA)
    old = tracker.filter(F.col("application") == application).first()
    day = F.to_date(F.lit(run_date))
    archive = day if plan["scope"] in ("archive", "all") or old is None else F.lit(old["last_archive_scan"])
    reset = day if plan["reset"] or old is None else F.lit(old["last_reset"])
    mine = spark.createDataFrame([(application,)], "application string").withColumn("last_archive_scan", archive).withColumn(
        "last_reset", reset)
    write_version(tracker.filter(F.col("application") != application).unionByName(mine), root)


def current_ledger(spark: SparkSession, warehouse: str) -> DataFrame:
    return table_or_empty(spark, table_path(warehouse, "processed_ledger"), LEDGER_SCHEMA)


def run_collector(spark: SparkSession, roots: Sequence[str], application: str, warehouse: str,
                  run_date: str | None = None, allow_undelivered: bool = False,
                  archive_roots: Sequence[str] = ()) -> dict:
    """Collect one application from the project roots into the warehouse. Returns counters.

    ``roots`` are the active ones. With ``archive_roots`` the tracker decides (T4): an archive scan
    also reads those and admits undelivered projects; the first run reads both. A due reset (T5)
    forgets the processed list, so every project is collected again (M1/M2 add nothing twice)."""
    run_date = run_date or dt.date.today().isoformat()
    plan = scan_plan(spark, application, warehouse, run_date)
    where = list(roots) + (list(archive_roots) if plan["scope"] in ("archive", "all") else [])
    undelivered = allow_undelivered or bool(archive_roots) and plan["allow_undelivered"]
    tree = cut_lineage(list_tree(spark, where))
    listing, projects = files.only_files(tree), files.list_projects(tree, application)
    if application in fixed.SETTINGS_APPLICATIONS:       # S2: also found by what their settings say
        parents = listing.select(clean.parent_dir(F.col("path")).alias("d"))
        parents = parents.select(F.explode(F.array("d", clean.parent_dir(F.col("d")), clean.parent_dir(
            clean.parent_dir(F.col("d"))))).alias("project_dir")).filter(F.col("project_dir") != "").distinct()
        named = files.settings_by_application(files.read_settings(parents), application).select("project_dir")
        projects = projects.select("project_dir").unionByName(named).distinct().withColumn("application", F.lit(application))
    out = run_projects(spark, listing, projects, application, warehouse, run_date, undelivered, plan["reset"])
    note_scan(spark, application, warehouse, run_date, plan)
    return {**out, "scope": plan["scope"], "reset": plan["reset"]}


def run_projects(spark: SparkSession, listing: DataFrame, projects: DataFrame, application: str, warehouse: str,
                 run_date: str | None = None, allow_undelivered: bool = False, reset: bool = False) -> dict:
    """Collect the given project folders (those not yet in the ledger) and append their rows.

    Folders whose settings name an application that the pipeline does not take are left out (F13;
    folders without settings go on, so that their failure is reported). The failed ones, with
    reasons, are this run's retry table (J2, A9)."""
    run_date = run_date or dt.date.today().isoformat()
    ledger_path = table_path(warehouse, "processed_ledger")
    ledger = current_ledger(spark, warehouse).filter(F.col("application") == application)
    rejected = 0
    found = projects.select("project_dir").distinct()
    seen = ledger.limit(0) if reset else ledger
    todo = incremental.new_projects(found, seen, ["project_dir"])
    settings = cut_lineage(files.read_settings(todo))
    asked = settings.select("project_dir", clean.json_value(F.col("json"), "application").alias("application"))
    if application not in fixed.SETTINGS_APPLICATIONS:       # those were found by their settings already
        routed = enrich.route_application(asked.filter(F.col("application").isNotNull()), pipelines=[application])
        unsaid = asked.filter(F.col("application").isNull()).select("project_dir")
        todo = routed.select("project_dir").unionByName(unsaid).distinct()
        misrouted = asked.filter(F.col("application").isNotNull()).join(routed.select("project_dir"), "project_dir", "left_anti")
        quarantine(misrouted.select(F.col("project_dir").alias("source"), F.lit("application of another pipeline").alias("reason"),
                                    F.col("application").alias("line")), table_path(warehouse, "rejected_rows"), application, run_date)
    todo = cut_lineage(todo)
    counts = {"found": found.count(), "new": asked.count(), "eligible": todo.count()}      # A8

    if application in ("PacBio", "ONT"):
        rows, failed = collectors.long_read_rows(spark, listing, todo, application, allow_undelivered)
        failed = cut_lineage(failed)
        rows = cut_lineage(rows)
        target_path = table_path(warehouse, f"qc_{application.lower()}_metrics")
        ids = sorted(r["k"] for r in rows.select(F.explode(F.map_keys("ids")).alias("k")).distinct().collect())
        batch = collectors.long_read_table_rows(rows, ids)   # id names only reach the driver (M4)
        target = with_status(spark, target_path, read_evolving(spark, target_path, LONG_SCHEMA))      # M2 compares the status too
        widened, batch = merge.evolve_schema(target, batch, fixed_cols=fixed.LONG_READ_BASE + ("name", "value"))
        new = cut_lineage(merge.new_rows_except(widened, batch, partition_cols=("Application",), batch_stored=True))
        before = row_count_or_zero(spark, target_path)
        added = observed_write(new, lambda df, mark: sinks.write_clustered(df, target_path, mark=mark))["rows"]     # K5, counted on the way
    else:
        rows, failed, unmatched, rejects = collectors.short_read_rows(spark, listing, todo, application, allow_undelivered)
        failed = cut_lineage(failed)
        rejected = quarantine(rejects, table_path(warehouse, "rejected_rows"), application, run_date)        # F10, F6
        # Samples without a species row, with the day of the run
        unmatched.withColumn("run_date", F.lit(run_date)).write.mode("append").parquet(
            table_path(warehouse, "species_unmatched"))
        rows = cut_lineage(rows)
        target_path = table_path(warehouse, "qc_illumina_metrics")
        target = table_or_empty(spark, target_path, SHORT_SCHEMA)
        before = row_count_or_zero(spark, target_path)
        # of rows with one key, which then differ in their status alone, always the same one is stored
        new = cut_lineage(merge.new_rows_if_absent(target, rows, fixed.SHORT_READ_KEY, partition_cols=("Application",),
                                                   order_col="ProjStatus", batch_stored=True))
        added = observed_write(new, lambda df, mark: sinks.write_clustered(df, target_path, mark=mark))["rows"]     # K5, counted on the way

    sample = "Sample_ID" if application == "ONT" else "Sample_Name"
    state, source = AppIndex(spark, table_path(warehouse, "qc_app_index_state")), target_path.rsplit("/", 1)[1]
    if state.noted(source) == before or before == 0:          # A1: this run's groups alone; else build_marts catches up
        state.add(source, _with_column(new, sample), sample)
        state.note(source, before + added)

    # Record the projects that produced rows; failed ones stay unrecorded (retried)
    done = (todo.join(failed.select("project_dir"), "project_dir", "left_anti")
                .withColumn("application", F.lit(application)).withColumn("run_date", F.lit(run_date)))
    recorded = sinks.append_ledger(ledger, done, ledger_path)
    retry = failed.select("project_dir", "reason", F.lit(application).alias("application"), F.lit(run_date).alias("run_date"))
    retry.distinct().write.mode("append").parquet(table_path(warehouse, "retry_projects"))
    reasons = {r["reason"]: r["projects"] for r in marts.failure_summary(failed.select("project_dir", "reason")).collect()}   # A9
    return {"application": application, "before": before, "added": added, "rejected": rejected, **counts, "failed": reasons,
            "projects_recorded": recorded, "projects_failed": failed.select("project_dir").distinct().count()}


def build_marts(spark: SparkSession, warehouse: str, run_date: str | None = None) -> dict:
    """A1 (K2), O2 (K4), A3 and K6 over whatever tables exist (absent = empty, L-16)."""
    run_date = run_date or dt.date.today().isoformat()
    short = table_or_empty(spark, table_path(warehouse, "qc_illumina_metrics"), SHORT_SCHEMA)
    pacbio = _with_column(read_evolving(spark, table_path(warehouse, "qc_pacbio_metrics"), LONG_SCHEMA), "Sample_Name")
    ont = _with_column(read_evolving(spark, table_path(warehouse, "qc_ont_metrics"), LONG_SCHEMA), "Sample_ID")
    state = AppIndex(spark, table_path(warehouse, "qc_app_index_state"))
    for name, table, sample in (("qc_illumina_metrics", short, "Sample_Name"), ("qc_pacbio_metrics", pacbio, "Sample_Name"),
                                ("qc_ont_metrics", ont, "Sample_ID")):
        state.catch_up(name, table, sample)
    sinks.replace_table(state.index(), table_path(warehouse, f"qc_app_index/run_date={run_date}"))
    view = marts.unified_view([(short, "qc_illumina_metrics"), (pacbio, "qc_pacbio_metrics"), (ont, "qc_ont_metrics")])
    sinks.replace_table(view, table_path(warehouse, "unified_qc_view"))       # a copy for readers without the catalog
    sinks.publish_lasting_view(spark, "unified_qc_view", [table_path(warehouse, name) for name in (
        "qc_illumina_metrics", "qc_pacbio_metrics", "qc_ont_metrics")])       # K4
    view = spark.table("unified_qc_view")
    sequencing = table_or_empty(spark, table_path(warehouse, "sequencing_metrics"), SEQUENCING_DDL)
    snap_root = table_path(warehouse, "snapshots")
    now = with_status(spark, table_path(warehouse, "qc_illumina_metrics"), short, SHORT_SCHEMA)
    kept = {"qc_illumina_metrics": now, "sequencing_metrics": sequencing}
    before = {name: _last_snapshot(spark, f"{snap_root}/{name}") for name in kept}
    delta = marts.publish_delta(before["qc_illumina_metrics"], short, "Sample_Name",
                                seq_before=before["sequencing_metrics"], seq_after=sequencing).first().asDict()
    if delta["publish"]:
        for name, df in kept.items():
            sinks.snapshot(df, f"{snap_root}/{name}", run_date)
    # K6: one run-log row per run -- the marker for days without a new snapshot
    log = spark.createDataFrame([(run_date, bool(delta["publish"]), int(delta["after_rows"]), int(delta["delta_rows"]),
                                  int(delta["delta_seq_rows"]))],
                                "run_date string, published boolean, rows bigint, delta_rows bigint, delta_seq_rows bigint")
    log.write.mode("append").parquet(table_path(warehouse, "run_log"))
    totals = marts.table_totals(short, "Sample_Name").first().asDict()                                       # A2
    return {"delta": delta, "totals": totals, "view_rows": view.count(), "expired": expired_snapshots(spark, warehouse, run_date)}


def _last_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    days = sorted(p.rsplit("=", 1)[1] for p in (q.removesuffix("/_SUCCESS") for q in glob_paths(
        spark, f"{root}/snapshot_date=*/_SUCCESS")))
    return spark.read.parquet(f"{root}/snapshot_date={days[-1]}") if days else None


def expired_snapshots(spark: SparkSession, warehouse: str, run_date: str) -> list[str]:
    """Snapshot folders past the retention; the newest of a table never expires. They are
    named, not deleted: removing data is the operator's act."""
    out: list[str] = []
    for name in ("qc_illumina_metrics", "sequencing_metrics"):
        paths = sorted(glob_paths(spark, f"{table_path(warehouse, 'snapshots')}/{name}/snapshot_date=*"))[:-1]
        if paths:
            day = F.to_date(F.regexp_extract("path", r"snapshot_date=(\d+)", 1), "yyyyMMdd")
            days = spark.createDataFrame([(p,) for p in paths], "path string").withColumn("day", day)
            out += [r["path"] for r in incremental.retention(days, "day", today=run_date).filter("expired").collect()]
    return out


def _with_column(df: DataFrame, name: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast("string"))


def run_status_update(spark: SparkSession, table_path_: str, run_type: str, export_path: str,
                      samples_inline: str | None = None, samples_file: str | None = None,
                      status_col: str = "ProjStatus", run_type_col: str = "Project_run_type",
                      sample_col: str = "Sample_Name", partition_cols: Sequence[str] = ("Application",), fold: bool = True) -> int:
    """U1 + U2 + A5 + K3: count the rows to change; with none, nothing is written. Otherwise their new status is
    noted as events beside the table. With ``fold`` (the default) all events noted so far are then written into the partitions that they
    touch, so that plain Parquet readers see them; without it the update writes its events alone, runs and
    ``StatusOverlay.read`` see them, and ``fold_status`` writes them into the table when it suits.
    The run type's rows (all statuses) are exported as TSV. Returns the number changed."""
    from ..sources.delimited import read_value_list
    samples = None
    if samples_inline is not None or samples_file is not None:
        samples = read_value_list(spark, samples_inline, samples_file)
    overlay = StatusOverlay(spark, table_path_, status_col)
    n = overlay.update(run_type, samples, run_type_col=run_type_col, sample_col=sample_col)
    if n == 0:
        return 0
    if fold:
        overlay.fold(partition_cols)
    sinks.export_csv(merge.status_scope(overlay.read(), run_type_col, run_type, samples, sample_col), export_path, sep="\t")
    return n


def fold_status(spark: SparkSession, warehouse: str, tables: Sequence[str] = (
        "qc_illumina_metrics", "qc_pacbio_metrics", "qc_ont_metrics")) -> list[str]:
    """Writes the status events of the metric tables into them; returns the tables that had any."""
    found = [(name, StatusOverlay(spark, table_path(warehouse, name))) for name in tables]
    found = [(name, overlay) for name, overlay in found if overlay.pending()]
    for _, overlay in found:
        overlay.fold()
    return [name for name, _ in found]


def with_status(spark: SparkSession, path: str, stored: DataFrame, schema: str | None = None) -> DataFrame:
    """``stored``, the table at ``path``, with the status of now when there are events that no fold has taken up."""
    overlay = StatusOverlay(spark, path, schema=schema)
    return overlay.read() if overlay.pending() else stored


def run_speciesid(spark: SparkSession, roots: Sequence[str], warehouse: str, run_date: str | None = None) -> dict:
    """Species-id collector run: S3 -> J1 (+T6) -> F12 -> F1 -> M3 -> K3/K6/K7.

    The stored table is all text; new rows join the stored ones by name and full duplicates are dropped. What is
    stored is known by the digests of its rows (``KeyIndex``, M3), so a run appends files and reads no history.
    A dated backup is written only when the row count grew; failed projects go to the failed ledger and are
    retried next run."""
    from ..operators.keyindex import KeyIndex
    run_date = run_date or dt.date.today().isoformat()
    listing = cut_lineage(files.list_files(spark, roots))
    found = files.find_reports(listing, "_QCreport.speciesid.csv")   # S3
    ledger_path = table_path(warehouse, "speciesid_processed")
    ledger = table_or_empty(spark, ledger_path, LEDGER_SCHEMA)
    todo = incremental.new_projects(found, ledger, ["project_dir"])
    rows, failed = collectors.speciesid_rows(spark, listing, todo)
    # column names only, taken once per file layout
    names = [r["n"] for r in rows.select("header").distinct().select(F.explode("header").alias("n")).distinct().collect()]
    from ..sources.reports import cell
    wide = rows.select("Investigator_Folder", "Project_run_type", "FlowcellID",
                       *[cell(F.col("header"), F.col("cells"), n).alias(n) for n in sorted(names)])
    current = table_path(warehouse, "speciesid_metrics/current")
    table = f"{current}/v={max(versions(spark, current), default=1)}"
    index = KeyIndex(spark, table).ensure()
    before = index.digests().count()
    after = before + index.append(cut_lineage(wide))
    if after > before:
        merged = read_evolving(spark, table, "Investigator_Folder string")
        sinks.snapshot(merged, table_path(warehouse, "speciesid_metrics/backups"), run_date)
        sinks.export_csv(merged, table_path(warehouse, "speciesid_metrics/csv"))
    done = (todo.select("project_dir").join(failed.select("project_dir"), "project_dir", "left_anti")
                .withColumn("application", F.lit("speciesid")).withColumn("run_date", F.lit(run_date)))
    sinks.append_ledger(ledger, done, ledger_path)
    # The report carries the place of each failure in the order of folders
    failed = numbered(failed, ["project_dir", "reason"], col="place")
    failed.withColumn("run_date", F.lit(run_date)).write.mode("append").parquet(table_path(warehouse, "speciesid_failed"))
    return {"before": before, "after": after, "grew": after > before, "columns": len(names),
            "failed": {r["reason"]: r["n"] for r in failed.groupBy("reason").agg(F.count("*").alias("n")).collect()}}


SEQUENCING_DDL = ", ".join(f"`{n}` {t}" for n, t in fixed.SEQUENCING_SCHEMA)


def run_sequencing_import(spark: SparkSession, csv_path: str, warehouse: str, run_date: str | None = None) -> dict:
    """S12 + M7 + M1 + A4: import ``SequencingMetrics.csv`` into ``sequencing_metrics``.

    The file is skipped when its lines hash to the last imported value (M7; the hash of all lines
    with their number is summed up by tasks, so the file is never one value). Otherwise it
    is read all-text, short rows are padded, bad rows go to the reject table (S12), and rows whose 16
    columns (null-safe) are not stored yet are appended (M1, ledger L-3). The counters (A4) are
    taken from footers and from the write itself."""
    from ..sources.delimited import typed_csv_rows
    run_date = run_date or dt.date.today().isoformat()
    hashes_path = table_path(warehouse, "sequencing_imports")
    current = sinks.content_hash(spark, csv_path).withColumn("path", F.lit("sequencing"))
    last = table_or_empty(spark, hashes_path, "path string, sha256 string, run_date string")
    newest = last.orderBy(F.col("run_date").desc()).limit(1).select("path", "sha256")
    if merge.changed_since(current, newest).isEmpty():
        return {"skipped": True, "before": None, "new": 0}
    target_path = table_path(warehouse, "sequencing_metrics")
    target = table_or_empty(spark, target_path, SEQUENCING_DDL)
    parsed = cut_lineage(typed_csv_rows(spark, csv_path, fixed.SEQUENCING_SCHEMA))
    bad = parsed.filter("_reason IS NOT NULL").select(F.lit(csv_path).alias("source"), F.col("_reason").alias("reason"),
                                                      F.col("_line").alias("line"))
    rejected = quarantine(bad, table_path(warehouse, "rejected_rows"), "sequencing", run_date)
    batch = parsed.filter("_reason IS NULL").drop("_reason", "_line")
    new = cut_lineage(merge.new_rows_if_absent(target, batch, [n for n, _ in fixed.SEQUENCING_SCHEMA], batch_stored=True))
    before = row_count_or_zero(spark, target_path)
    samples = new.agg(F.count_distinct("Project")).first()[0]
    added = observed_write(new, lambda df, mark: sinks.append_rows(mark(df), target_path))["rows"]
    stats = {"before": before, "after": before + added, "new": added, "sample_size": samples}
    current.withColumn("run_date", F.lit(run_date)).write.mode("append").parquet(hashes_path)
    return {"skipped": False, **stats, "rejected": rejected}


def run_groups(spark: SparkSession, input_dir: str, registry_root: str,
               export_path: str | None = None) -> DataFrame:
    """Batch form of the group watcher (S11 -> A7 -> U3 -> K8): every ``*.metrics.txt`` under
    ``input_dir`` is rescanned and unseen groups are registered; the new registry state is
    written as the registry's next version."""
    from ..operators import registry
    from ..sources import delimited
    from ..streaming.jobs import current_registry
    lines = delimited.read_metric_files(spark, input_dir)
    vals = delimited.column_values_sniffed(lines, fixed.GROUP_HEADER_WORD).withColumnRenamed(
        "value", fixed.GROUP_HEADER_WORD)
    updated = registry.register_groups(current_registry(spark, registry_root), registry.distinct_groups(vals))
    out = spark.read.parquet(write_version(updated, registry_root))
    if export_path:
        sinks.registry_export(out, export_path)
    return out


def run_registry_update(spark: SparkSession, registry_root: str, group: str,
                        add: str | None = None, add_file: str | None = None,
                        remove: str | None = None, remove_file: str | None = None) -> DataFrame:
    """U4/U5 with S15 lists: users given inline (comma list) or in a file (one per line) are
    trimmed, blanks dropped (ledger L-22), then added in order or removed."""
    from ..operators import registry
    from ..sources.delimited import read_value_list
    from ..streaming.jobs import current_registry
    reg = current_registry(spark, registry_root)
    if add is not None or add_file is not None:
        names = read_value_list(spark, add, add_file, keep_order=True)
        reg = registry.add_users(reg, names.select(F.lit(group).alias("grp"), F.col("name").alias("user"),
                                                   F.col("pos")))
    if remove is not None or remove_file is not None:
        names = read_value_list(spark, remove, remove_file)
        reg = registry.remove_users(reg, names.select(F.lit(group).alias("grp"), F.col("name").alias("user")))
    return spark.read.parquet(write_version(reg, registry_root))
