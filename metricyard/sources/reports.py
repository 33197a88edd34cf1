"""Report readers: preamble + CSV reports, run summaries, RunInfo, attribute JSON.

A report arrives as whole text ``(file, text)``. It is split into numbered lines;
the header is the first line holding a marker; every later line is a row of
``cells`` parsed as CSV (quoted fields may hold commas and doubled quotes).
Files keep their own headers -- rows are ``(file, row_no, header[], cells[])``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, fixed
from ..operators import ordered

# one CSV field followed by the separator we append to every line
_CSV_FIELD = r'("(?:[^"]|"")*"|[^,]*),'


def csv_cells(line: Column) -> Column:
    """Fields of one CSV line: quotes removed from quoted fields, doubled quotes undone."""
    raw = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(_CSV_FIELD), 1)
    return F.transform(raw, lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) >= 2),
                                             F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"')))
                       .otherwise(x))


def marker_condition(line: Column, markers: Sequence[str]) -> Column:
    cond = None
    for m in markers:
        c = F.instr(line, m) > 0
        cond = c if cond is None else cond | c
    return cond


def report_rows(texts: DataFrame, markers: Sequence[str], file_col: str = "path", text_col: str = "text") -> DataFrame:
    """``(file, row_no, header, cells)`` -- the preamble up to the first line holding any
    marker is skipped; that line is the header (parsed once per file); blank lines are ignored.
    Files without a marker give no rows."""
    lines = texts.select(file_col, ordered.text_lines(F.col(text_col)).alias("lines"))
    lines = lines.withColumn("at", ordered.first_line(F.col("lines"), lambda x: marker_condition(x, markers))).filter("at > 0")
    header = F.transform(csv_cells(F.get("lines", (F.col("at") - 1).cast("int"))), lambda x: F.trim(x))
    rows = lines.select(file_col, header.alias("header"), F.posexplode(F.slice(
        F.col("lines"), (F.col("at") + 1).cast("int"), F.size("lines"))).alias("row_no", "line")).filter(F.trim("line") != "")
    return rows.select(file_col, (F.col("row_no") + 1).cast("bigint").alias("row_no"), "header", csv_cells(F.col("line")).alias("cells"))


def cell(header: Column, cells: Column, name: str) -> Column:
    """Value of a named column in a row (NULL when the file has no such column)."""
    pos = F.array_position(header, F.lit(name))
    return F.when(pos > 0, F.try_element_at(cells, pos.cast("int")))


def lane_block(texts: DataFrame, file_col: str = "path", text_col: str = "text") -> DataFrame:
    """Lane rows of a run summary: from the line holding 'Cluster PF' to the line holding
    'Read 2 (I)', rows whose 2nd cell is '-'; columns picked by name after removing spaces and
    bound by name (ledger L-12). Returns ``(file, Lane, <7 lane metrics>)``."""
    start = lambda x: F.instr(x, fixed.LANE_BLOCK_START) > 0
    stop = lambda x: F.instr(x, fixed.LANE_BLOCK_STOP) > 0
    block = texts.select(file_col, ordered.lines_between_first(ordered.text_lines(F.col(text_col)), start, stop)["block"].alias("b"))
    header = F.transform(csv_cells(F.get("b", F.lit(0))), lambda x: F.regexp_replace(x, r"\s+", ""))
    rows = block.filter(F.col("b").isNotNull()).select(file_col, header.alias("h"), F.explode(
        F.filter("b", lambda x: ~start(x))).alias("line"))
    cells = F.transform(csv_cells(F.col("line")), lambda x: F.trim(x))
    rows = rows.select(file_col, "h", cells.alias("c")).filter(F.try_element_at("c", F.lit(2)) == "-")
    out = [file_col, cell(F.col("h"), F.col("c"), "Lane").alias("Lane")]
    for src, dst in zip(fixed.LANE_BLOCK_COLUMNS, fixed.LANE_METRIC_NAMES):
        out.append(cell(F.col("h"), F.col("c"), src).alias(dst))
    return rows.select(*out)


def run_identity(summary_texts: DataFrame, file_col: str = "path", text_col: str = "text",
                 tbd_missing: bool = True) -> DataFrame:
    """``MachineID`` and ``FlowCellID`` from the first data row under the first header
    line holding both; with ``tbd_missing`` (S9) a ``!!!TBD!!!`` or empty flowcell is missing,
    otherwise (S8, short-read metadata) the cell is taken as written."""
    lines = summary_texts.select(file_col, ordered.text_lines(F.col(text_col)).alias("lines"))
    at = ordered.first_line(F.col("lines"), lambda x: (F.instr(x, "MachineID") > 0) & (F.instr(x, "FlowCellID") > 0))
    nxt = lines.withColumn("at", at.cast("int")).filter((F.col("at") > 0) & (F.col("at") < F.size("lines")))
    h = F.transform(csv_cells(F.get("lines", F.col("at") - 1)), lambda x: F.trim(x))
    c = F.transform(csv_cells(F.get("lines", F.col("at"))), lambda x: F.trim(x))
    flow = cell(h, c, "FlowCellID")
    flow = F.when(~F.coalesce(flow, F.lit("")).isin("", fixed.TBD_TOKEN), flow) if tbd_missing else \
        F.nullif(flow, F.lit(""))
    return nxt.select(file_col, F.nullif(cell(h, c, "MachineID"), F.lit("")).alias("MachineID"),
                      flow.alias("FlowCellID"))


def run_info(texts: DataFrame, text_col: str = "text") -> tuple[Column, Column]:
    """S8/S9 on RunInfo.xml text: (RunID, Flowcell)."""
    t = F.col(text_col)
    return (F.nullif(F.regexp_extract(t, r'<Run Id="([^"]+)"', 1), F.lit("")),
            F.nullif(F.trim(F.regexp_extract(t, r"<Flowcell>([^<]*)</Flowcell>", 1)), F.lit("")))


ATTRIBUTES_SCHEMA = "struct<attributes:array<struct<id:string,value:string>>>"


def parse_attributes(json_col) -> Column:
    """Parse an attribute report once (``attributes[{id, value}]``)."""
    return F.from_json(clean._c(json_col), ATTRIBUTES_SCHEMA)


def attribute_value(json_col, attribute_id: str, parsed: bool = False) -> Column:
    """``value`` of the entry of ``attributes[]`` whose ``id`` equals ``attribute_id``
    (first one), as text; numeric 0 is kept; absent -> NULL. With ``parsed=True`` the column
    already holds the output of ``parse_attributes``."""
    parsed = clean._c(json_col) if parsed else parse_attributes(json_col)
    ids = parsed["attributes"]["id"]
    vals = parsed["attributes"]["value"]
    pos = F.array_position(ids, F.lit(attribute_id))
    return F.when(pos > 0, F.try_element_at(vals, pos.cast("int")))


def attribute_metrics(json_col, id_map: Sequence[tuple[str, str]], percent: Sequence[str] = ()) -> list[Column]:
    """S10 + N1: named metric columns from an attribute report; ``percent`` ones are x100 (2 decimals)."""
    out = []
    parsed = parse_attributes(json_col)
    for name, attr in id_map:
        v = attribute_value(parsed, attr, parsed=True)
        out.append((clean.fraction_to_percent(v) if name in percent else v).alias(name))
    return out
