"""Reshape operators: wide reports to long ``(name, value)`` rows.

Two forms are supported:

* **flat** -- an ordinary DataFrame whose columns are the report columns; the
  long form explodes an array of its measures (no shuffle).
* **array** -- rows ``(<ids...>, header ARRAY<STRING>, cells ARRAY<STRING>)``
  where every file may have its own header (heterogeneous schemas, SURVEY H4).
  Per-file decisions (anchor position, first numeric column) are array
  expressions evaluated per row, so nothing is collected and no DataFrame is
  built per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, fixed


# ------------------------------------------------------------------ flat form
def to_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast the given columns to STRING (unpivot needs one common type)."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in df.columns])


def pivot_long_from(df: DataFrame, anchor: str, name_col: str = "name", value_col: str = "value",
                    keep: Sequence[str] = ()) -> DataFrame:
    """R1 on a flat DataFrame: columns left of ``anchor`` are ids, ``anchor`` and right of it are measures.
    The measures are exploded where the rows lie: long rows of a frame that is dealt by ids stay dealt by them, and
    grouping them by these ids and more shuffles nothing.

    ``keep`` lists extra id columns taken from the measure side (they are not pivoted).
    Raises ``ValueError`` when the anchor is absent (the caller quarantines the batch).
    """
    cols = df.columns
    if anchor not in cols:
        raise ValueError(f"anchor column {anchor!r} not found")
    start = cols.index(anchor)
    ids = cols[:start] + [c for c in cols[start:] if c in keep]
    measures = [c for c in cols[start:] if c not in keep]
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias(name_col), F.col(f"`{m}`").cast("string").alias(value_col)) for m in measures]))
    return df.select(*[F.col(f"`{c}`") for c in ids], pairs.alias("_nv")).select(
        *[F.col(f"`{c}`") for c in ids], F.col("_nv")[name_col].alias(name_col), F.col("_nv")[value_col].alias(value_col))


# ----------------------------------------------------------------- array form
def explode_cells(df: DataFrame, header: str = "header", cells: str = "cells",
                  start: Column | None = None, pos_col: str = "col_no") -> DataFrame:
    """One row per (row, column) with ``name`` from the header and ``value`` from the cells.

    ``start`` (1-based, per row) keeps only columns from that position on. Cells are padded
    to the header width first (F5), so short rows give NULL values rather than lost names.
    """
    width = F.size(F.col(header))
    padded = clean.pad_array(F.col(cells), width)
    zipped = F.arrays_zip(F.col(header).alias("name"), padded.alias("value"))
    if start is not None:
        zipped = F.slice(zipped, start, F.greatest(width - start + 1, F.lit(0)))
    keep = [c for c in df.columns if c not in (header, cells)]
    exploded = df.select(*keep, F.posexplode(zipped).alias(pos_col, "nv"))
    if start is not None:
        exploded = exploded.withColumn(pos_col, F.col(pos_col) + start - 1)
    return exploded.select(*keep, pos_col, F.col("nv.name").alias("name"), F.col("nv.value").alias("value"))


def anchor_position(header: str | Column, anchor: str = fixed.PIVOT_ANCHOR) -> Column:
    """1-based position of the anchor column, 0 when absent (R1 reject rule)."""
    h = F.col(header) if isinstance(header, str) else header
    return F.array_position(h, F.lit(anchor)).cast("int")


def first_numeric_position(first_cells: str | Column) -> Column:
    """R2: 1-based position of the first cell that is numeric after removing a trailing '%'; 0 if none."""
    c = F.col(first_cells) if isinstance(first_cells, str) else first_cells
    flags = F.transform(c, lambda x: clean.is_numeric(clean.percent_value(F.regexp_replace(x, '"', "")), "sci"))
    return F.array_position(flags, F.lit(True)).cast("int")


def pivot_long_array(df: DataFrame, start: Column, id_exceptions: Sequence[str] = (),
                     header: str = "header", cells: str = "cells") -> DataFrame:
    """R1/R2 in array form.

    ``start`` is the per-row 1-based first metric position (``anchor_position`` for R1,
    ``first_numeric_position`` of the file's first row for R2). Rows with ``start = 0`` are
    dropped here; callers report those files as rejected. Columns listed in
    ``id_exceptions`` stay ids even when right of ``start``. The output keeps ``header`` and
    the padded ``cells`` so id columns are read by name (``sources.reports.cell``); the explode
    is a plain ``posexplode`` + filter, which stays in generated code.
    """
    keep = [c for c in df.columns if c not in (header, cells)]
    staged = (df.withColumn("_start", start).filter(F.col("_start") > 0)
                .withColumn(cells, clean.pad_array(F.col(cells), F.size(F.col(header)))))
    exploded = staged.select(*keep, header, cells, "_start", F.posexplode(F.col(header)).alias("_pos", "name"))
    is_metric = F.col("_pos") + 1 >= F.col("_start")
    if id_exceptions:
        is_metric = is_metric & ~F.col("name").isin(*id_exceptions)
    return (exploded.filter(is_metric)
                    .select(*keep, header, cells, "name",
                            F.element_at(F.col(cells), F.col("_pos") + 1).alias("value"),
                            (F.col("_pos") + 1).alias("col_no")))


# --------------------------------------------------------------- F2-F4 columns
def select_matching_names(names: Column, pattern: str) -> Column:
    """F2 in array form: names that match a regex, header order kept."""
    return F.filter(names, lambda x: x.rlike(pattern))


def drop_names(names: Column, dropped: Sequence[str], case_insensitive: bool = False) -> Column:
    """F3 in array form (ledger L-13: ONT drops by case-insensitive name)."""
    if case_insensitive:
        low = F.array(*[F.lit(d.lower()) for d in dropped])
        return F.filter(names, lambda x: ~F.array_contains(low, F.lower(x)))
    arr = F.array(*[F.lit(d) for d in dropped])
    return F.filter(names, lambda x: ~F.array_contains(arr, x))


def split_id_and_value_names(header: Column, first_cells: Column, dropped: Sequence[str] = ()) -> Column:
    """struct(ids, values) -- a kept column is a value when its first-row cell is an unsigned
    decimal, else an id; header order kept inside each part."""
    drop = F.array(*[F.lit(d) for d in dropped]) if dropped else F.array().cast("array<string>")
    z = F.arrays_zip(header.alias("n"), clean.pad_array(first_cells, F.size(header)).alias("v"))
    kept = F.filter(z, lambda e: ~F.array_contains(drop, e["n"]))
    ids = F.transform(F.filter(kept, lambda e: ~clean.is_numeric(e["v"], "decimal")), lambda e: e["n"])
    vals = F.transform(F.filter(kept, lambda e: clean.is_numeric(e["v"], "decimal")), lambda e: e["n"])
    return F.struct(ids.alias("ids"), vals.alias("values"))
