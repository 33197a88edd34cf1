"""The collectors: project folders -> long metric rows, all projects in one job.

``short_read_rows``  settings + run summary + report + species report -> 15-column long rows
``long_read_rows``   settings + QC report (+ attribute reports for PacBio) -> long rows
``speciesid_rows``   settings + species report + flowcell -> wide rows with 3 columns in front

Each returns ``(rows, failed)`` (short read also the samples without a species row, J4, and the rejected rows); ``failed(project_dir, reason)`` lists projects that are
retried on the next run (they are not written to the processed ledger).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, fixed
from ..operators import enrich, shape
from ..operators.quarantine import wide_row
from ..session import cut_lineage
from ..sources import files, reports


# ------------------------------------------------------------------ project metadata
def project_metadata(settings: DataFrame, application: str | Column) -> DataFrame:
    """Settings -> (project_dir, Investigator_Folder, Project_ID, Project_run_type, Release_Date,
    ProjStatus, organism, raw_report_dir). Missing settings give NULL metadata (and status
    Undelivered)."""
    j, v = F.col("json"), F.col("_v")
    parsed = settings.withColumn("_v", clean.parse_json("json"))                # parsed once for all keys
    raw = parsed.select("project_dir", "json", *[clean.variant_value(v, j, key).alias(name) for key, name in (
        ("deliveryFolder", "_folder"), ("releaseDate", "_date"), ("projectId", "Project_ID"), ("projectFinal", "Project_run_type"))],
        clean.variant_first_element(v, "organism").alias("organism"))
    dated = raw.withColumn("Investigator_Folder", clean.delivery_folder(F.col("_folder"), application)).withColumn(
        "Release_Date", clean.release_date_text("_date"))
    return dated.select("project_dir", "Investigator_Folder", "Project_ID", "Project_run_type", "Release_Date",
                        clean.proj_status("Investigator_Folder", "Release_Date").alias("ProjStatus"), "organism",
                        clean.json_first_path(j).alias("raw_report_dir"), j.isNotNull().alias("has_settings"))


def project_files(listing: DataFrame, projects: DataFrame) -> DataFrame:
    """Files of the project folders (directly inside, or one level down such as ``package/``),
    tagged with their project -- an equi-join on the candidate folder, no prefix matching."""
    path = F.regexp_replace("path", "^file:", "")
    parent = clean.parent_dir(path)
    cand = listing.select("path", F.explode(F.array(parent, clean.parent_dir(parent))).alias("project_dir"))
    return cand.join(projects.select("project_dir").distinct(), "project_dir", "inner").select("project_dir", "path")


def _texts(chosen: DataFrame, path_col: str = "path") -> DataFrame:
    """Whole texts of the chosen files, read by executors (no path list on the driver)."""
    return files.read_hidden_files(chosen.select(path_col).distinct()).select(
        path_col, F.col("body").alias("text")).filter(F.col("text").isNotNull())


# ------------------------------------------------------------------ short read
def short_read_rows(spark: SparkSession, listing: DataFrame, projects: DataFrame, application: str,
                    allow_undelivered: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Short-read collector.

    ``projects(project_dir)``: folders holding ``<project>_QCreport.<application>.csv``, the
    optional ``<project>_QCreport.speciesid.csv``, ``Run_Metric_Summary[.draft].csv`` (in the
    folder or in ``package/``) and ``RunInfo.xml``, and the hidden ``.settings.json``.
    """
    settings = files.read_settings(projects)
    meta = cut_lineage(project_metadata(settings, application))   # small, read by several joins
    listing = project_files(listing, projects)
    base = clean.base_name(F.col("path"))

    # Run summary in four places, first existing wins
    pkg = F.col("path").contains("/package/")
    sum_rank = (F.when(~pkg & (base == fixed.SUMMARY_DRAFT), F.lit(1))
                 .when(~pkg & (base == fixed.SUMMARY_FINAL), F.lit(2))
                 .when(pkg & (base == fixed.SUMMARY_DRAFT), F.lit(3))
                 .when(pkg & (base == fixed.SUMMARY_FINAL), F.lit(4)))
    summary = files.resolve_candidate(listing, "project_dir", sum_rank)
    runinfo = files.resolve_candidate(listing, "project_dir", F.when(base == fixed.RUN_INFO, F.lit(1)))
    report = files.resolve_candidate(
        listing, "project_dir", F.when(base.endswith(fixed.REPORT_SUFFIX.format(application=application)), F.lit(1)))
    species = files.resolve_candidate(
        listing, "project_dir", F.when(base.endswith(fixed.SPECIES_SUFFIX), F.lit(1)))

    texts = _texts(report.unionByName(species).unionByName(summary).unionByName(runinfo).select("path"))
    texts = cut_lineage(texts.join(listing, "path", "inner"))   # adds project_dir; read once

    # run identity and lanes (per project)
    sum_texts = texts.join(summary.select("path"), "path", "left_semi")
    # Machine and flowcell from the summary, run id from RunInfo.xml -- all three only
    # when a run summary exists (without one the run fields stay missing)
    ident = reports.run_identity(sum_texts, tbd_missing=False).join(
        summary.select("project_dir", "path"), "path").drop("path")
    ri = texts.join(runinfo.select("path"), "path", "left_semi")
    run_id, _ = reports.run_info(ri)
    ri = ri.select("project_dir", run_id.alias("RunID")).join(summary.select("project_dir"), "project_dir", "left_semi")
    lanes = reports.lane_block(sum_texts).join(summary.select("project_dir", "path"), "path").drop("path")
    lane_metrics = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value"))
                             for n in fixed.LANE_METRIC_NAMES])
    lanes = lanes.select("project_dir", F.trim("Lane").alias("Lane"), lane_metrics.alias("_lane_metrics"))

    # report rows (array form) and R1 anchor on the sanitized header
    rep = reports.report_rows(texts.join(report.select("path"), "path", "left_semi"), [fixed.SHORT_READ_MARKER])
    rep = rep.join(report.select("project_dir", "path"), "path")
    hdr_s = F.transform(F.col("header"), lambda x: clean.sanitize_header(x))
    rep = rep.withColumn("header", hdr_s).withColumn("_start", shape.anchor_position(F.col("header")))
    rejected = rep.filter(F.col("_start") == 0).select("project_dir").distinct().withColumn(
        "reason", F.lit("anchor column missing"))
    rep = rep.filter(F.col("_start") > 0)
    # rows with text beyond the last named column are set aside, like those without ids
    text = F.array_join("cells", ",", "")
    wide = wide_row(F.col("header"), F.col("cells"))
    rejects = rep.filter(wide).select(F.col("path").alias("source"), F.lit("more cells than columns").alias("reason"), text.alias("line"))
    rep = rep.filter(~wide)
    cells = F.transform(clean.pad_array(F.col("cells"), F.size("header")),
                        lambda x: F.nullif(F.trim(clean.strip_inner_commas(x)), F.lit("")))
    rep = rep.withColumn("cells", cells)
    sid = reports.cell(F.col("header"), F.col("cells"), "GT_QC_Sample_ID")
    sname = reports.cell(F.col("header"), F.col("cells"), "Sample_Name")
    any_case = F.array_position(F.transform("header", lambda x: F.lower(x)), "species").cast("int")
    sp = F.when(any_case > 0, F.try_element_at("cells", any_case))
    width = F.size("header")
    metrics = F.slice(F.arrays_zip(F.col("header").alias("name"), F.col("cells").alias("value")),
                      F.col("_start"), width - F.col("_start") + 1)
    samples = rep.select("project_dir", "path", "row_no", sid.alias("GT_QC_Sample_ID"), sname.alias("Sample_Name"),
                         clean.normalize_species(sp).alias("Species"), metrics.alias("_metrics"))
    # F6 (ledger L-1): rows whose sample id or sample name is missing are dropped
    no_id = clean.is_missing("GT_QC_Sample_ID") | clean.is_missing("Sample_Name")
    rejects = rejects.unionByName(samples.filter(no_id).select(
        F.col("path").alias("source"), F.lit("sample id or name missing").alias("reason"),
        F.array_join(F.transform("_metrics", lambda m: m["value"]), ",", "").alias("line")))
    samples = samples.filter(~no_id)

    # Species columns by Sample_Name, else by GT_QC_Sample_ID (last row wins), else NaN
    sp_rows = reports.report_rows(texts.join(species.select("path"), "path", "left_semi"), [fixed.SHORT_READ_MARKER])
    sp_rows = sp_rows.join(species.select("project_dir", "path"), "path")
    sp_names = [f"Domain{i}" for i in range(1, 5)] + [f"Species{i}" for i in range(1, 6)]
    sp_flat = sp_rows.select(
        "project_dir", "row_no",
        reports.cell(F.col("header"), F.col("cells"), "Sample_Name").alias("_k_name"),
        reports.cell(F.col("header"), F.col("cells"), "GT_QC_Sample_ID").alias("_k_id"),
        *[reports.cell(F.col("header"), F.col("cells"), n).alias(n) for n in sp_names])
    samples = _species_join(samples, sp_flat, sp_names)
    unmatched = samples.filter("_unmatched").select("project_dir", "GT_QC_Sample_ID", "Sample_Name",
                                                    F.lit(application).alias("application"))

    # Every sample row once per lane (NULL lane fields without a run summary)
    ident = ident.select("project_dir", F.col("MachineID").alias("InstrumentID"),
                         F.col("FlowCellID").alias("_sum_flowcell"))
    per_project = (meta.join(ident, "project_dir", "left").join(ri, "project_dir", "left")
                       .withColumnRenamed("_sum_flowcell", "FlowcellID"))
    with_lanes = enrich.lanes_x_samples(samples, lanes, ["project_dir"], salt_from=["path", "row_no"])
    rows = with_lanes.join(per_project, "project_dir", "left")
    if not allow_undelivered:
        rows = rows.filter(F.col("ProjStatus") == "Delivered")
    all_metrics = F.concat(F.col("_metrics"), F.col("_species"),
                           F.coalesce(F.col("_lane_metrics"), F.array(*[
                               F.struct(F.lit(n).alias("name"), F.lit(None).cast("string").alias("value"))
                               for n in fixed.LANE_METRIC_NAMES])))
    long = rows.select(*[c for c in fixed.SHORT_READ_META if c != "Lane"], "Lane", "GT_QC_Sample_ID",
                       "Sample_Name", "Species", F.explode(all_metrics).alias("_m"))
    long = long.select(*fixed.SHORT_READ_META, "GT_QC_Sample_ID", "Sample_Name", "Species",
                       clean.sanitize_header(F.col("_m.name")).alias("name"), F.trim(F.col("_m.value")).alias("value"),
                       F.lit(application).alias("Application"))
    long = long.filter(~clean.value_is_dropped("value")).select(*fixed.SHORT_READ_COLUMNS)

    failed = _failed(meta, report, rep, rejected).unionByName(_not_ready(meta, allow_undelivered))
    return long, failed, unmatched, rejects


def _not_ready(meta: DataFrame, allow_undelivered: bool) -> DataFrame:
    """without archive scope, projects lacking delivery folder or release date are skipped
    and stay unrecorded, so that they are tried again."""
    from ..operators.incremental import delivery_gate
    gated = delivery_gate(meta, allow_undelivered)
    return gated.filter(~F.col("ready")).select("project_dir", F.lit("not delivered").alias("reason"))


def _species_join(samples: DataFrame, sp_flat: DataFrame, sp_names: Sequence[str]) -> DataFrame:
    payload = F.struct(*[F.col(n) for n in sp_names])
    by_name = (sp_flat.filter(~clean.is_missing("_k_name"))
                      .groupBy("project_dir", F.col("_k_name").alias("Sample_Name"))
                      .agg(F.max_by(payload, F.col("row_no")).alias("_by_name")))
    by_id = (sp_flat.filter(~clean.is_missing("_k_id"))
                    .groupBy("project_dir", F.col("_k_id").alias("GT_QC_Sample_ID"))
                    .agg(F.max_by(payload, F.col("row_no")).alias("_by_id")))
    j = (samples.join(by_name, ["project_dir", "Sample_Name"], "left")
                .join(by_id, ["project_dir", "GT_QC_Sample_ID"], "left"))
    chosen = F.coalesce("_by_name", "_by_id")
    arr = F.array(*[F.struct(F.lit(n).alias("name"),
                             F.when(chosen.isNull(), F.lit("NaN")).otherwise(chosen[n]).alias("value"))
                    for n in sp_names])
    return j.withColumn("_unmatched", chosen.isNull()).withColumn("_species", arr).drop("_by_name", "_by_id")


def _failed(meta: DataFrame, report: DataFrame, rep: DataFrame, rejected: DataFrame) -> DataFrame:
    no_report = meta.join(report.select("project_dir"), "project_dir", "left_anti").select(
        "project_dir", F.lit("report missing").alias("reason"))
    no_rows = (report.select("project_dir").join(rep.select("project_dir").distinct(), "project_dir", "left_anti")
                     .join(rejected.select("project_dir"), "project_dir", "left_anti")
                     .select("project_dir", F.lit("no header or no rows").alias("reason")))
    return no_report.unionByName(no_rows).unionByName(rejected).distinct()


# ------------------------------------------------------------------ long read
def long_read_rows(spark: SparkSession, listing: DataFrame, projects: DataFrame,
                   application: str, allow_undelivered: bool = False) -> tuple[DataFrame, DataFrame]:
    """PacBio / ONT collector.

    PacBio: ``package/<projectFinal>*_QC_Report.csv``, else ``package/Run_Report_<projectFinal>.csv``
    (fallback: no attribute metrics); attribute reports under the settings ``path``.
    ONT: ``[package/]<projectFinal>*_QC_Report.csv`` else ``*QCreport.csv``; the hidden
    instrument JSON (``fixed.ONT_INSTRUMENT_FILE``).
    Rows: 8 base columns + the report's id columns + ``name``, ``value`` (wide ids are kept in
    ``ids`` as a map, so each file keeps its own layout).
    """
    settings = files.read_settings(projects)
    meta = cut_lineage(project_metadata(settings, application))
    listing = project_files(listing, projects).join(meta.select("project_dir", "Project_run_type"), "project_dir")
    base = clean.base_name(F.col("path"))
    pf = F.coalesce(F.col("Project_run_type"), F.lit("\u0000"))
    in_pkg = clean.parent_dir(F.col("path")) == F.concat(F.col("project_dir"), F.lit("/package"))
    top = clean.parent_dir(F.col("path")) == F.col("project_dir")
    if application == "PacBio":
        rank = (F.when(in_pkg & base.startswith(pf) & base.endswith("_QC_Report.csv"), F.lit(1))
                 .when(in_pkg & (base == F.concat(F.lit("Run_Report_"), pf, F.lit(".csv"))), F.lit(2)))
    else:
        rank = (F.when(in_pkg & base.startswith(pf) & base.endswith("_QC_Report.csv"), F.lit(1))
                 .when(top & base.startswith(pf) & base.endswith("_QC_Report.csv"), F.lit(2))
                 .when(in_pkg & base.startswith(pf) & base.endswith("QCreport.csv"), F.lit(3))
                 .when(top & base.startswith(pf) & base.endswith("QCreport.csv"), F.lit(4)))
    report = files.resolve_candidate(listing, "project_dir", rank)
    texts = cut_lineage(_texts(report).join(report.select("project_dir", "path", "rank"), "path"))
    rep = reports.report_rows(texts, fixed.LONG_READ_MARKERS).join(report.select("path", "project_dir", "rank"), "path")

    if application == "PacBio":
        header = F.transform(F.col("header"), lambda x: clean.pacbio_header(x))
        rep = rep.withColumn("header", header)
    # drop columns by name (PacBio list; ONT drops 'Species', any case -- ledger L-13)
    dropped = fixed.PACBIO_DROPPED_COLUMNS if application == "PacBio" else ("Species",)
    zipped = F.arrays_zip(F.col("header").alias("n"), clean.pad_array(F.col("cells"), F.size("header")).alias("v"))
    if application == "PacBio":
        dl = F.array(*[F.lit(d) for d in dropped])
        kept = F.filter(zipped, lambda e: ~F.array_contains(dl, e["n"]))
    else:
        kept = F.filter(zipped, lambda e: F.lower(e["n"]) != "species")
    others = [c for c in rep.columns if c not in ("header", "cells")]
    rep = rep.select(*others, F.transform(kept, lambda e: e["n"]).alias("header"),
                     F.transform(kept, lambda e: F.nullif(F.trim(clean.strip_inner_commas(e["v"])), F.lit("")))
                     .alias("cells"))

    # per project: instrument name/id, species, attribute metrics (PacBio, not in fallback)
    parent = clean.base_name(clean.parent_dir(F.col("project_dir")))
    if application == "ONT":
        ont = files.read_hidden_files(projects.select("project_dir").distinct().withColumn(
            "path", F.concat(F.col("project_dir"), F.lit("/" + fixed.ONT_INSTRUMENT_FILE)))).select("project_dir", F.col("body").alias("_ont"))
        meta = meta.join(ont, "project_dir", "left")
        name = enrich.instrument_name("ONT", parent, F.col("_ont"))
    else:
        name = enrich.instrument_name("PacBio", parent)
    meta = meta.withColumn("InstrumentID", clean.instrument_id(name, application)).withColumn(
        "Species", F.col("organism"))
    extra_names: list[str] = []
    if application == "PacBio":
        attr = files.read_hidden_files(meta.select("project_dir", F.concat(
            F.col("raw_report_dir"), F.lit("/outputs/raw_data.report.json")).alias("path"))).select(
            "project_dir", F.col("body").alias("_raw"))
        ccs = files.read_hidden_files(meta.select("project_dir", F.concat(
            F.col("raw_report_dir"), F.lit("/outputs/ccs.report.json")).alias("path"))).select(
            "project_dir", F.col("body").alias("_ccs"))
        meta = meta.join(attr, "project_dir", "left").join(ccs, "project_dir", "left")
        cols = (reports.attribute_metrics(F.col("_raw"), fixed.RAW_DATA_ATTRIBUTES)
                + reports.attribute_metrics(F.col("_ccs"), fixed.CCS_ATTRIBUTES, fixed.FRACTION_TO_PERCENT))
        meta = meta.select("*", *cols)
        extra_names = [n for n, _ in fixed.RAW_DATA_ATTRIBUTES] + [n for n, _ in fixed.CCS_ATTRIBUTES]

    # C1 on the header; then per file the first row decides the layout:
    #   PacBio (F4): a column is a value when its first-row cell is an unsigned decimal, else an id;
    #   ONT (R2): metrics start at the first column whose first-row cell is numeric ('%' allowed).
    rep = rep.withColumn("header", F.transform(F.col("header"), lambda x: clean.sanitize_header(x)))
    first = rep.groupBy("path").agg(F.min_by("cells", F.col("row_no")).alias("_first"))
    start = first.select("path", "_first", shape.first_numeric_position(F.col("_first")).alias("_start"))
    rep = rep.join(start, "path")
    if application == "PacBio":
        has_value = F.exists(F.col("_first"), lambda x: clean.is_numeric(x, "decimal"))
        rejected = rep.filter(~has_value & (F.col("rank") == 2)).select("project_dir").distinct()
        rep = rep.filter(has_value | (F.col("rank") == 1))
    else:
        rejected = rep.filter(F.col("_start") == 0).select("project_dir").distinct()
        rep = rep.filter(F.col("_start") > 0)
    rejected = rejected.withColumn("reason", F.lit("no numeric column"))
    rows = rep.join(meta, "project_dir", "left")
    if application == "PacBio":
        attr_arr = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value"))
                             for n in extra_names])
        fallback = F.col("rank") == 2
        extra = F.when(fallback, F.array().cast("array<struct<name:string,value:string>>")).otherwise(attr_arr)
    else:
        extra = F.array().cast("array<struct<name:string,value:string>>")
    ex = F.array(*[F.lit(x) for x in fixed.LONG_READ_ID_EXCEPTIONS])
    z = F.arrays_zip(F.col("header").alias("name"), F.col("cells").alias("value"),
                     clean.pad_array(F.col("_first"), F.size("header")).alias("fv"))
    indexed = F.transform(z, lambda e, i: F.struct(e["name"].alias("name"), e["value"].alias("value"),
                                                  e["fv"].alias("fv"), (i + 1).alias("pos")))
    if application == "PacBio":
        is_metric = lambda e: clean.is_numeric(e["fv"], "decimal") & ~F.array_contains(ex, e["name"])
    else:
        is_metric = lambda e: (e["pos"] >= F.col("_start")) & ~F.array_contains(ex, e["name"])
    metric = F.transform(F.filter(indexed, is_metric),
                         lambda e: F.struct(e["name"].alias("name"), e["value"].alias("value")))
    ids = F.map_from_entries(F.transform(F.filter(indexed, lambda e: ~is_metric(e)),
                                         lambda e: F.struct(e["name"].alias("k"), e["value"].alias("v"))))
    long = rows.select(*fixed.LONG_READ_META, ids.alias("ids"), F.explode(F.concat(extra, metric)).alias("_m"))
    long = long.select(*fixed.LONG_READ_META, "ids", clean.sanitize_header(F.col("_m.name")).alias("name"),
                       clean.nullify_missing(F.col("_m.value")).alias("value"),
                       F.lit(application).alias("Application"))
    if not allow_undelivered:
        long = long.filter(F.col("ProjStatus") == "Delivered")
    failed = _failed(meta, report, rep, rejected).unionByName(_not_ready(meta, allow_undelivered))
    return long, failed


def long_read_table_rows(long: DataFrame, id_names: Sequence[str]) -> DataFrame:
    """Flatten the per-file ``ids`` map into named text columns (cleaned with C2) for the
    evolving long-read table; ``id_names`` is the set of id names to materialise."""
    cols = [F.col("ids")[n].alias(clean.clean_column_name_py(n)) for n in id_names]
    return long.select(*fixed.LONG_READ_META, *cols, "name", "value", "Application")


# ------------------------------------------------------------------ speciesid
def speciesid_rows(spark: SparkSession, listing: DataFrame, projects: DataFrame,
                   application: str = "speciesid") -> tuple[DataFrame, DataFrame]:
    """Species-id collector (F1 3-column form, F12, J6, S9): wide species rows with
    ``Investigator_Folder, Project_run_type, FlowcellID`` in front; failures carry their reason.

    Metadata needs the delivery folder (second part from the end, slashes stripped, missing
    with fewer than two parts -- ledger L-8), ``projectFinal`` and ``releaseDate``. The report
    is ``<projectFinal>_QCreport.<application>.csv`` in the folder; the flowcell comes from
    ``RunInfo.xml``, else from the first data row of ``Run_Metric_Summary.draft.csv`` (S9)."""
    settings = files.read_settings(projects)
    j = F.col("json")
    parts = F.split(clean.trim_slashes(F.coalesce(clean.json_regex(j, "deliveryFolder"), F.lit(""))), "/", -1)
    folder = F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2)))
    meta = settings.select("project_dir", j.isNotNull().alias("has_settings"),
                           F.nullif(folder, F.lit("")).alias("Investigator_Folder"),
                           clean.json_regex(j, "projectFinal").alias("Project_run_type"),
                           clean.json_regex(j, "releaseDate").alias("_release"))
    listing = project_files(listing, projects).join(meta.select("project_dir", "Project_run_type"), "project_dir")
    base = clean.base_name(F.col("path"))
    top = clean.parent_dir(F.col("path")) == F.col("project_dir")
    report = files.resolve_candidate(listing, "project_dir", F.when(
        top & (base == F.concat(F.col("Project_run_type"), F.lit(f"_QCreport.{application}.csv"))), F.lit(1)))
    summary = files.resolve_candidate(listing, "project_dir",
                                      F.when(top & (base == fixed.SUMMARY_DRAFT), F.lit(1)))
    runinfo = files.resolve_candidate(listing, "project_dir", F.when(top & (base == fixed.RUN_INFO), F.lit(1)))
    texts = cut_lineage(_texts(report.unionByName(summary).unionByName(runinfo).select("path")))
    ri = texts.join(runinfo, "path")
    _, ri_flow = reports.run_info(ri)
    ri = ri.select("project_dir", ri_flow.alias("_ri"))
    ident = reports.run_identity(texts.join(summary.select("path"), "path", "left_semi")).join(
        summary.select("project_dir", "path"), "path").select("project_dir", F.col("FlowCellID").alias("_sum"))
    flow = meta.join(ri, "project_dir", "left").join(ident, "project_dir", "left").withColumn(
        "FlowcellID", F.coalesce("_ri", "_sum"))
    rep = reports.report_rows(texts.join(report.select("path"), "path", "left_semi"), [fixed.SHORT_READ_MARKER])
    rep = rep.join(report.select("project_dir", "path"), "path")
    has_rows = rep.select("project_dir").distinct().withColumn("_rows", F.lit(True))
    checked = (flow.join(report.select("project_dir", F.lit(True).alias("_report")), "project_dir", "left")
                   .join(has_rows, "project_dir", "left"))
    from ..operators.incremental import validate_project
    checked = validate_project(checked, [
        ("settings missing", ~F.col("has_settings")),
        ("metadata incomplete", F.col("Investigator_Folder").isNull() | F.col("Project_run_type").isNull()
         | F.col("_release").isNull()),
        ("report missing", F.col("_report").isNull()),
        ("flowcell missing", F.col("FlowcellID").isNull()),
        ("parse failed", F.col("_rows").isNull()),
    ])
    ok = checked.filter(F.col("reason").isNull()).select("project_dir", "Investigator_Folder", "Project_run_type",
                                                         "FlowcellID")
    rows = enrich.add_metadata(rep, ok, ["project_dir"], ["Investigator_Folder", "Project_run_type", "FlowcellID"], how="inner")   # F1
    failed = checked.filter(F.col("reason").isNotNull()).select("project_dir", "reason")
    return rows, failed
