"""Tool-log triage, delivery manifests and name lists.

Rules are fixed, bounded literal lists, so they are compiled into one CASE
expression per line (no join, no cross product): each line gets the rank of
the first rule of its stage that it holds, and a file's class is the rule with
the smallest rank over its lines (a partial aggregation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, fixed
from .ordered import block_lines

LOG_NAME_RE = r"([^/]+)_QCreport\.([^./]+)(?:\.([^./]+))?\.log$"


def parse_log_path(path_col: Column) -> dict[str, Column]:
    """Project, pipeline and stage ('run' when there is no stage part) from a log path."""
    name = F.substring_index(path_col, "/", -1)              # not the whole path: the pattern would be tried from each of its places
    stage = F.regexp_extract(name, LOG_NAME_RE, 3)
    return {
        "project": F.regexp_extract(name, LOG_NAME_RE, 1),
        "pipeline": F.regexp_extract(name, LOG_NAME_RE, 2),
        "stage": F.when(stage == "", F.lit("run")).otherwise(stage),
    }


def rule_rank(stage: Column, line: Column, rules: Sequence[tuple[str, str]] = fixed.LOG_RULES) -> Column:
    """Rank (1-based, rule order) of the first rule of the line's stage held by the line, else NULL."""
    expr = None
    for rank, (rule_stage, pattern) in enumerate(rules, start=1):
        cond = (stage == F.lit(rule_stage)) & (F.instr(line, pattern) > 0)
        expr = F.when(cond, F.lit(rank)) if expr is None else expr.when(cond, F.lit(rank))
    return expr


def rule_pattern(rank: Column, rules: Sequence[tuple[str, str]] = fixed.LOG_RULES) -> Column:
    expr = None
    for i, (_, pattern) in enumerate(rules, start=1):
        expr = F.when(rank == i, F.lit(pattern)) if expr is None else expr.when(rank == i, F.lit(pattern))
    return expr


def classify_logs(lines: DataFrame, rules: Sequence[tuple[str, str]] = fixed.LOG_RULES,
                  file_cols: Sequence[str] = ("project", "pipeline", "stage"),
                  line_col: str = "line") -> DataFrame:
    """L1: one row per log file with ``error_class`` = pattern of the first rule that hits
    (NULL when none does)."""
    ranked = lines.withColumn("_rank", rule_rank(F.col("stage"), F.col(line_col), rules))
    per_file = ranked.groupBy(*file_cols).agg(F.min("_rank").alias("_rank"))
    return per_file.withColumn("error_class", rule_pattern(F.col("_rank"), rules)).drop("_rank")


def stage_order(stage: Column, pipeline: Column, basic: str = "basic", multi: Column | None = None) -> Column:
    """Order in which files are tried (basic run/package/release/gather, pipeline run/gather/
    package/release, multi ...); used to pick ``first_error`` per project."""
    part = F.when(pipeline == F.lit(basic), F.lit(0))
    if multi is not None:
        part = part.when(multi, F.lit(2))
    part = part.otherwise(F.lit(1))
    within_basic = F.when(stage == "run", 0).when(stage == "package", 1).when(stage == "release", 2).otherwise(3)
    within_other = F.when(stage == "run", 0).when(stage == "gather", 1).when(stage == "package", 2).otherwise(3)
    return part * 10 + F.when(part == 0, within_basic).otherwise(within_other)


def first_error(classified: DataFrame, project_col: str = "project", main_pipeline: str | None = None) -> DataFrame:
    """First classified file per project in trying order (only files with an error class). A project
    with several pipelines beside ``basic`` tries the main one first, then the others by name."""
    multi = None if main_pipeline is None else (F.col("pipeline") != F.lit(main_pipeline))
    hit = classified.filter(F.col("error_class").isNotNull()).withColumn(
        "_order", stage_order(F.col("stage"), F.col("pipeline"), multi=multi))
    return hit.groupBy(project_col).agg(
        F.min_by(F.struct("pipeline", "stage", "error_class"), F.struct("_order", "pipeline")).alias("first")).select(
        project_col, "first.*")


def stage_status(lines: DataFrame, group: Sequence[str] = ("project", "pipeline"), line_col: str = "line",
                 markers: Sequence[tuple[str, str]] = fixed.STATUS_MARKERS) -> DataFrame:
    """L2: status per (project, pipeline) from marker lines, markers checked in order."""
    aggs = [F.max(F.when(F.instr(F.col(line_col), m) > 0, F.lit(1)).otherwise(F.lit(0))).alias(f"_{s}")
            for s, m in markers]
    agg = lines.groupBy(*group).agg(*aggs)
    status = None
    for s, _ in markers:
        cond = F.col(f"_{s}") == 1
        status = F.when(cond, F.lit(s)) if status is None else status.when(cond, F.lit(s))
    return agg.select(*group, status.alias("status"))


def report_block(lines: DataFrame, group: Sequence[str], pos_col: str = "line_no", line_col: str = "line",
                 start_marker: str = "Report @", stop_marker: str = fixed.REPORT_BLOCK_STOP,
                 drop_internal: bool = True) -> DataFrame:
    """L3: block lines (one row per line, in ``pos`` order); 'Internal' and blank lines removed."""
    block = block_lines(lines, group, pos_col, line_col, start_marker, stop_marker)
    if drop_internal:
        block = block.filter((F.instr(F.col(line_col), fixed.INTERNAL_LINE) == 0) & (F.trim(F.col(line_col)) != ""))
    return block


def required_inputs_missing(projects: DataFrame, listing: DataFrame, settings: DataFrame,
                            project_col: str = "project_dir", path_col: str = "path") -> DataFrame:
    """L4: per project, every missing required input (settings, fastqs folder, stats file).

    ``listing`` (project, path) holds visible files only, so whether a project has settings comes from
    ``settings`` (S4: project, json), and projects without any visible file come from ``projects``."""
    base = clean.base_name(F.col(path_col))
    seen = listing.groupBy(project_col).agg(
        F.max(F.col(path_col).rlike(r"/fastqs(/|$)").cast("int")).alias("_fastqs"),
        F.max((base == "Stats.json.unprocessed").cast("int")).alias("_stats"))
    has = settings.filter(F.col("json").isNotNull()).select(project_col, F.lit(1).alias("_settings")).distinct()
    agg = (projects.select(project_col).distinct().join(seen, project_col, "left").join(has, project_col, "left")
                   .fillna(0, ["_settings", "_fastqs", "_stats"]))
    missing = F.array_compact(F.array(
        F.when(F.col("_settings") == 0, F.lit(".settings.json")),
        F.when(F.col("_fastqs") == 0, F.lit("fastqs")),
        F.when(F.col("_stats") == 0, F.lit("Stats.json.unprocessed"))))
    return agg.select(project_col, missing.alias("missing"))


def manifest_counts(files: DataFrame, path_col: str = "path", group: Sequence[str] = ()) -> DataFrame:
    """FASTQ totals -- all and Undetermined, per read tag and overall (``tag`` = ``all``), with
    real counts (ledger L-11). The overall row is summed from the tags' rows."""
    name = clean.base_name(F.col(path_col))
    fq = files.filter(name.rlike(r"\.f(ast)?q(\.gz)?$"))
    tag_rx = "(" + "|".join(t for t in fixed.READ_TAGS) + ")"
    tagged = fq.withColumn("tag", F.regexp_extract(name, tag_rx, 1)).withColumn(
        "undetermined", F.instr(name, fixed.UNDETERMINED) > 0)
    per_tag = tagged.groupBy(*group, "tag").agg(
        F.count(F.lit(1)).alias("fastq_total"), F.count_if("undetermined").alias("undetermined_total"))
    overall = per_tag.groupBy(*group).agg(F.sum("fastq_total").alias("fastq_total"), F.sum("undetermined_total").alias(
        "undetermined_total")).withColumn("tag", F.lit("all"))
    return per_tag.unionByName(overall)


def clean_name_list(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """F16 + S15: trim; drop blank and '#' lines; duplicates removed (first position kept)."""
    t = F.trim(F.col(line_col))
    kept = lines.withColumn("name", t).filter((F.col("name") != "") & ~F.col("name").startswith("#"))
    return kept


def known_names(requested: DataFrame, catalog: DataFrame, name_col: str = "name",
                pos_col: str = "pos") -> DataFrame:
    """requested names found in the catalog (whole-word equality), unknown ones flagged,
    and the known name that comes first in catalog order marked as the release one."""
    cat = catalog.groupBy(name_col).agg(F.min(pos_col).alias("_cat_pos"))
    req = requested.select(name_col).distinct()
    joined = req.join(cat, name_col, "left").withColumn("known", F.col("_cat_pos").isNotNull())
    first = (cat.join(req, name_col, "left_semi")
                .agg(F.min_by(name_col, F.col("_cat_pos")).alias(name_col))
                .withColumn("is_release", F.lit(True)))
    return (joined.join(first, name_col, "left")
                  .select(name_col, "known", F.coalesce("is_release", F.lit(False)).alias("is_release")))
