"""Delimited-text readers.

Files whose layout differs per file are read as lines and parsed with array
expressions per file (delimiter and column position come from each file's
header line), so one job reads any mix of layouts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean


def sniff_delimiter(sample: F.Column) -> F.Column:
    """Tab when the sample holds a tab, else comma when it holds a comma, else tab."""
    return (F.when(F.instr(sample, "\t") > 0, F.lit("\t"))
             .when(F.instr(sample, ",") > 0, F.lit(",")).otherwise(F.lit("\t")))


def quoted_cells(line: F.Column, delim: F.Column) -> F.Column:
    """Cells of a line; a delimiter between double quotes belongs to its cell, and the quotes go.

    Outside quotes (the even parts of a split at quotes) delimiters become a unit separator. A
    doubled quote inside quotes closes and opens again, so it leaves no mark in the cell."""
    parts = F.transform(F.split(line, '"', -1), lambda x, i: F.when(
        i % 2 == 0, F.replace(x, delim, F.lit("\u001f"))).otherwise(x))
    return F.split(F.array_join(parts, ""), "\u001f", -1)


def column_values_sniffed(lines: DataFrame, column: str, path_col: str = "path", line_col: str = "line") -> DataFrame:
    """Values of ``column`` in every file of ``(path, line)`` rows; the header line of each
    file fixes the delimiter and the position. It is the first line with a cell that is the
    column's name, by ``line_no`` when the rows have it (``read_metric_files`` gives the place in
    the file). Cells may be quoted: a delimiter inside quotes does not split. Files without the
    column contribute nothing. Returns ``(path, value)``; the header word itself is a value
    of its own column and is filtered by the caller (U3 ignores it)."""
    at = F.col("line_no") if "line_no" in lines.columns else F.col(line_col)
    header = (lines.filter(F.instr(F.col(line_col), column) > 0)
                   .withColumn("_delim", sniff_delimiter(F.col(line_col)))
                   .withColumn("_idx", F.array_position(
                       F.transform(quoted_cells(F.col(line_col), F.col("_delim")), lambda x: F.trim(x)), F.lit(column)))
                   .filter(F.col("_idx") > 0)
                   .groupBy(path_col).agg(F.min_by(F.struct("_delim", "_idx"), at).alias("_h")))
    j = lines.join(header, path_col, "inner")   # one row per file; AQE broadcasts it when small
    cells = quoted_cells(F.col(line_col), F.col("_h._delim"))
    return j.select(path_col, F.try_element_at(cells, F.col("_h._idx").cast("int")).alias("value"))


def read_metric_files(spark: SparkSession, root: str, glob: str = "*.metrics.txt") -> DataFrame:
    """Lines of every metrics file under ``root`` with their path and place: ``line_no`` grows with the
    position in the file (start of the split, then the row in it)."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (spark.read.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
                 .load(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"),
                                    F.struct(F.col("_metadata.file_block_start").alias("split"), row.alias("row")).alias("line_no")))


def typed_csv_rows(spark: SparkSession, path: str, schema: Sequence[tuple[str, str]], header: bool = True,
                   drop_header_lines: bool = False) -> DataFrame:
    """Header CSV with '"' quote/escape; every field read as text, short rows padded with NULL, typed with
    ``try_cast`` (ANSI-safe). The typed columns, and of a row that cannot be taken the ``_reason`` (extra fields, or the
    first value that does not fit its type) and its ``_line``."""
    names = [n for n, _ in schema]
    text_schema = ", ".join(f"`{n}` string" for n in names) + ", `_corrupt` string"
    raw = (spark.read.option("header", header).option("quote", '"').option("escape", '"')
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
                .option("enforceSchema", True).schema(text_schema).csv(path))
    # short rows are flagged corrupt but are padded with NULLs; a flagged row with more fields than
    # the schema has is rejected. Quoted parts are emptied before its delimiters are counted.
    bare = F.regexp_replace("_corrupt", '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    if drop_header_lines:   # header lines inside files written by several tasks
        raw = raw.filter(~F.coalesce(F.col(f"`{names[0]}`") == F.lit(names[0]), F.lit(False)))
    reason = F.when(fields > len(names), F.lit("extra fields"))
    for n, t in schema:
        text = F.col(f"`{n}`")
        reason = reason.when((F.trim(text) != "") & text.try_cast(t).isNull(), F.lit(f"{n} is not {t}"))
    line = F.coalesce("_corrupt", F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names]))
    return raw.select(*[F.col(f"`{n}`").try_cast(t).alias(n) for n, t in schema], reason.alias("_reason"), line.alias("_line"))


def read_typed_csv(spark: SparkSession, path: str, schema: Sequence[tuple[str, str]], header: bool = True,
                   drop_header_lines: bool = False) -> DataFrame:
    """The rows of ``typed_csv_rows`` that can be taken."""
    rows = typed_csv_rows(spark, path, schema, header, drop_header_lines)
    return rows.filter("_reason IS NULL").drop("_reason", "_line")


def read_long_csv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Headerless long CSV bound by position, every column text (no inference, ledger L-7)."""
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.option("header", False).schema(schema).csv(path)


def read_value_list(spark: SparkSession, inline: str | None = None, path: str | None = None,
                    keep_order: bool = False) -> DataFrame:
    """Names from a comma list and/or a file (one per line), trimmed, blanks dropped,
    duplicates removed. With ``keep_order`` a ``pos`` column gives each name's first position
    (inline names first, then file lines)."""
    frames = []
    if inline is not None:
        frames.append(spark.createDataFrame([(inline,)], "line string")
                      .select(F.posexplode(clean.split_list("line")).alias("pos", "name"))
                      .select("name", F.col("pos").cast("bigint").alias("pos")))
    if path is not None:
        lines = spark.read.text(path).select(F.trim("value").alias("name"),
                                             F.monotonically_increasing_id().alias("pos"))
        frames.append(lines.filter(F.col("name") != "")
                           .select("name", (F.col("pos") + F.lit(1 << 40)).alias("pos")))
    if not frames:
        return spark.createDataFrame([], "name string, pos bigint")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    out = out.groupBy("name").agg(F.min("pos").alias("pos"))
    return out if keep_order else out.select("name")
